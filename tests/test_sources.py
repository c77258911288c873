"""File readers and writers on small landed files."""

import gzip
import io
import json
import tarfile

from pyspark.sql import functions as F

from tidewise.sources import files, sinks


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_threads_skip_broken_files(spark, tmp_path):
    put(tmp_path / "a.json", json.dumps({"n1": {"id": "n1", "author": "u", "scoreHistory": [{"value": 3, "timestamp": "t"}]}, "n2": {"id": "n2", "parentId": "n1"}}))
    put(tmp_path / "b.json", "{broken")
    got = files.thread_nodes(spark, str(tmp_path)).orderBy("file", "position").collect()
    assert [(r.file, r.node_id, r.parentId) for r in got if r.node_id] == [("a.json", "n1", None), ("a.json", "n2", "n1")]
    assert got[0].scoreHistory[0].value == 3


def test_envelopes_and_posts(spark, tmp_path):
    put(tmp_path / "e/cs/1.json", json.dumps({"category": "cs", "fetchedAt": "now", "entries": [{"id": "x", "authors": ["a", "b"]}, {"id": "y"}]}))
    put(tmp_path / "e/cs/state.json", "{}")
    assert sorted(r.id for r in files.envelopes(spark, str(tmp_path / "e")).collect()) == ["x", "y"]
    put(tmp_path / "p/one/1.json", json.dumps({"id": "1", "title": "a"}))
    put(tmp_path / "p/two/2.json", json.dumps([{"id": "2"}, {"id": "3"}]))
    assert sorted((r.source, r.id) for r in files.posts_by_source(spark, str(tmp_path / "p")).collect()) == [("one", "1"), ("two", "2"), ("two", "3")]


def test_snapshots_and_latest(spark, tmp_path):
    for name in ("scrape_20250101_000000", "scrape_20250102_030405"):
        put(tmp_path / f"post/{name}.json", name)
    shots = files.snapshots(spark, str(tmp_path))
    assert [r.x for r in shots.select(F.date_format("taken_at", "yyyy-MM-dd HH:mm:ss").alias("x")).orderBy("x").collect()] == ["2025-01-01 00:00:00", "2025-01-02 03:04:05"]
    assert files.latest_per_folder(shots).first().file == "scrape_20250102_030405.json"


def test_state(spark, tmp_path):
    schema = "struct<last: string>"
    put(tmp_path / "s.json", '{"last": "q"}')
    put(tmp_path / "bad.json", "nonsense")
    assert files.state_or_default(spark, str(tmp_path / "s.json"), schema).first().state.last == "q"
    assert files.state_or_default(spark, str(tmp_path / "bad.json"), schema).first().state.last is None
    assert files.state_or_default(spark, str(tmp_path / "none.json"), schema).first().state.last is None


def test_lists_and_settings(spark, tmp_path):
    put(tmp_path / "list.txt", "# top\nr/News\n\n/r/Tech\nart\n")
    assert [(r.name, r["rank"]) for r in files.priority_list(spark, str(tmp_path / "list.txt")).orderBy("rank").collect()] == [("news", 0), ("tech", 1), ("art", 2)]
    put(tmp_path / "c.txt", "category: cs.AI\nstart_date: 2024-01-01\ncategory: cs.CL\nstart_date: 2023-05-06\n")
    assert [(r.category, str(r.start_date)) for r in files.category_config(spark, str(tmp_path / "c.txt")).orderBy("category").collect()] == [("cs.AI", "2024-01-01"), ("cs.CL", "2023-05-06")]
    put(tmp_path / "env", "# c\nA = 1=2\nB=\nnothing\n")
    assert {(r.key, r.value) for r in files.settings(spark, str(tmp_path / "env")).collect()} == {("A", "1=2"), ("B", "")}
    put(tmp_path / "log", "x RPS=2.5 waste=0.3\nRPS=bad\n")
    assert {(r.metric, r.value) for r in files.log_values(spark, str(tmp_path / "log"), {"rps": r"RPS=([\d.]+)", "waste": r"waste=([\d.]+)"}).collect()} == {("rps", 2.5), ("waste", 0.3)}


def test_feeds(spark, tmp_path):
    put(tmp_path / "a.xml", '<feed><entry><id>i1</id><title>A\n  b</title><published>2024</published><author><name>x</name></author><author><name>y</name></author><category term="cs"/><link href="h" rel="alternate" type="t"/></entry></feed>')
    r = files.atom_entries(spark, str(tmp_path / "a.xml")).first()
    assert (r.id, r.title, r.updated, r.authors, r.categories, r.links[0].href) == ("i1", "A b", "2024", ["x", "y"], ["cs"], "h")
    put(tmp_path / "r.xml", "<rss><channel><item><title>T</title><link>u</link><pubDate>d</pubDate></item></channel></rss>")
    r = files.rss_items(spark, str(tmp_path / "r.xml")).first()
    assert (r.id, r.url, r.title) == ("u", "u", "T")


def test_pages(spark):
    html = '<div><a href="/news/one"><h3>First one</h3></a></div><div><h3>Second</h3><p><a href="/news/two">go</a></p></div><a class="x" href="/blog/long-title"><b>A long title</b></a>'
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = {(r.title, r.url) for r in files.heading_links(pages, "https://example.org/").collect()}
    assert ("First one", "https://example.org/news/one") in got
    assert {(r.href, r.title) for r in files.links_by_pattern(pages, "/blog/").collect()} == {("/blog/long-title", "A long title")}


def test_archives(spark, tmp_path):
    def tar(name, members):
        with tarfile.open(tmp_path / name, "w:gz") as t:
            for member, text in members.items():
                info = tarfile.TarInfo(member)
                info.size = len(text)
                t.addfile(info, io.BytesIO(text.encode()))

    tar("a.tar.gz", {"x.tex": "no", "main.tex": "\\begin{abstract}z\\end{abstract}\\section{Intro}\\subsection{Sub}", "f.png": "p"})
    tar("b.tar.gz", {"01-one.tex": "a", "sec/two.tex": "b"})
    tar("e.tar.gz", {"x.tex": "", "NeurIPS_2023.tex": "\\section{N}"})
    (tmp_path / "c.gz").write_bytes(gzip.compress(b"\\section{Only}"))
    (tmp_path / "d.pdf").write_bytes(b"%PDF-1.5")
    got = {r.name: r for r in files.archive_structure(files.archives(spark, str(tmp_path))).collect()}
    assert got["a.tar.gz"].main_file == "main.tex" and got["a.tar.gz"].headers == ["Intro", "Sub"] and got["a.tar.gz"].has_abstract
    assert {n: r.structure for n, r in got.items()} == {"a.tar.gz": "multi-file", "b.tar.gz": "modular", "e.tar.gz": "multi-file", "c.gz": "unknown", "d.pdf": "unknown"}
    assert got["e.tar.gz"].main_file == "NeurIPS_2023.tex"
    assert got["a.tar.gz"].extensions == {"tex": 2, "png": 1}
    x = spark.range(1).select(files.clean_latex(F.lit("A \\textbf{bold} word\\cite{k}. % note\nEnd")).alias("t"), files.section_class(F.lit(" Related Work")).alias("c")).first()
    assert (x.t, x.c) == ("A bold word. End", "background")


def test_archive_statistics_unpack_each_archive_once(spark):
    unpacked = spark.sparkContext.accumulator(0)
    ddl = "name string, is_pdf boolean, files array<string>, main_file string, headers array<string>, has_abstract boolean"
    rows = [(f"{i}.tar", False, ["main.tex", "a.PNG", "none"][: i % 3 + 1], "main.tex" if i else None, ["Intro ", f"h{i % 35:02}", *(["intro"] if i == 7 else [])], i < 8) for i in range(70)]
    rows += [("p.pdf", True, [], None, [], False), ("q.gz", False, [], None, None, False)]

    def seen(batches):
        for batch in batches:
            unpacked.add(len(batch))
            yield batch

    got = {(r.statistic, r.name): (r.n, r.pct) for r in files.archive_statistics(spark.createDataFrame(rows, ddl).mapInPandas(seen, ddl)).collect()}
    assert unpacked.value == 72
    assert {k[1]: v for k, v in got.items() if k[0] == "kind"} == {"pdf": (1, 1), "source": (71, 99)}
    assert {k[1]: v for k, v in got.items() if k[0] == "structure"} == {"single-file": (70, 99), "unknown": (1, 1)}
    assert {k[1]: v for k, v in got.items() if k[0] == "abstract"} == {"yes": (8, 11), "no": (63, 89)}
    assert {k[1]: v for k, v in got.items() if k[0] == "main_file"} == {"main.tex": (69, None)}
    assert {k[1]: v for k, v in got.items() if k[0] == "extension"} == {"tex": (70, None), "png": (46, None), "": (23, None)}
    # of 36 headers the first 30, equal ones by name
    assert {k[1]: v for k, v in got.items() if k[0] == "header"} == {"intro": (71, 100)} | {f"h{i:02}": (2, 3) for i in range(29)}


def test_archives_plain_and_compressed(spark, tmp_path):
    for mode in ("w", "w:gz", "w:bz2", "w:xz"):
        for form in (tarfile.USTAR_FORMAT, tarfile.GNU_FORMAT, tarfile.PAX_FORMAT):
            with tarfile.open(tmp_path / f"{mode.replace(':', '_')}{form}.tar", mode, format=form) as t:
                for member in ("paper.tex", "long/" * 30 + "é.png"):
                    info = tarfile.TarInfo(member if form != tarfile.USTAR_FORMAT else member[-9:])
                    info.size = 12
                    t.addfile(info, io.BytesIO(b"\\section{One}"[:12]))
    bad = bytearray((tmp_path / "w0.tar").read_bytes())
    bad[0] ^= 1  # the checksum does not hold
    (tmp_path / "bad.tar").write_bytes(bytes(bad))
    got = {r.name: r for r in files.archives(spark, str(tmp_path)).collect()}
    assert len(got) == 13 and got.pop("bad.tar").main_file is None
    assert all(r.main_file == "paper.tex" and len(r.files) == 2 for r in got.values())


def test_sinks(spark, tmp_path):
    items = spark.createDataFrame([(1, "2024-01-01", None), (2, "2024-02-01", "x")], "id int, ts string, t string")
    sinks.json_lines(items, "ts", "id", "Items", str(tmp_path / "out"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out/data")).collect()]
    assert json.loads(lines[0])["id"] == 2 and "2024-01-01 to 2024-02-01" in "\n".join(r.value for r in spark.read.text(str(tmp_path / "out/header")).collect())
    nodes = spark.createDataFrame([("t", 1, None), ("t", 2, 1)], "thread string, node int, parent int")
    sinks.thread_files(nodes, str(tmp_path / "th"))
    assert set(json.loads(spark.read.text(str(tmp_path / "th")).first().value)) == {"1", "2"}
    sinks.edge_lists(nodes, str(tmp_path / "ed"))
    assert spark.read.json(str(tmp_path / "ed")).first().edges == [["1", "2"]]
    for at in ("a", "b"):
        sinks.append_snapshot(spark.createDataFrame([("x  y\n z",)], "t string"), at, str(tmp_path / "sn"))
    assert {(r.t, r.fetched_at) for r in spark.read.json(str(tmp_path / "sn")).collect()} == {("x y z", "a"), ("x y z", "b")}
    assert spark.range(1).select(sinks.bar(F.lit(0.25), 4).alias("b")).first().b == "█░░░"
