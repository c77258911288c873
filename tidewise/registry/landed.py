"""Sources and sinks over landed files: small files are written to the shared folder, read by the engine's readers and compared with the tables
they came from.  What is landed are lists of nations, days and kinds, whose number does not grow with the data, or tables written by Spark."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.registry.base import query, r6, table
from tidewise.sources import files, sinks
from tidewise.streaming.feeds import shared


def put(spark: SparkSession, path: str, text: str) -> None:
    """One small file in whatever store the path names."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(conf).create(target, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _nations(spark, sf_dir) -> list:
    """The 25 nations with their regions, by key."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.select("n_nationkey", "n_name", "r_name").orderBy("n_nationkey").collect()


@query("SELECT r_name || '.json' AS file, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1 AS INT) AS position, 'n' || n_nationkey AS node_id, CASE WHEN n_nationkey > 0 THEN 'n' || (n_nationkey - 1) END AS parent, CAST(n_nationkey * 2 AS BIGINT) AS score FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_scan_threads(spark, sf_dir):
    """Threads as maps of nodes, a file each, in file order; a file that does not parse is passed over."""
    path, threads = shared(spark, "threads"), {}
    for r in _nations(spark, sf_dir):
        node = {"id": f"n{r.n_nationkey}", "author": r.n_name, "scoreHistory": [{"value": r.n_nationkey * 2, "timestamp": "t"}]}
        threads.setdefault(r.r_name, {})[node["id"]] = node | ({"parentId": f"n{r.n_nationkey - 1}"} if r.n_nationkey else {})
    for name, nodes in threads.items():
        put(spark, f"{path}/{name}.json", json.dumps(nodes))
    put(spark, f"{path}/broken.json", '{"n1": {')
    got = files.thread_nodes(spark, path).where("id is not null")
    return got.select("file", "position", "node_id", F.col("parentId").alias("parent"), F.try_element_at("scoreHistory", F.lit(1))["value"].alias("score"))


@query("SELECT r_name AS category, n_name AS title, CAST(2 AS INT) AS authors FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_scan_envelopes(spark, sf_dir):
    """Files of {category, fetchedAt, entries} in folders, and a state file that is none of them."""
    path, found = shared(spark, "envelopes"), {}
    for r in _nations(spark, sf_dir):
        found.setdefault(r.r_name, []).append({"id": str(r.n_nationkey), "title": r.n_name, "authors": ["a", "b"]})
    for name, entries in found.items():
        put(spark, f"{path}/{name}/one.json", json.dumps({"category": name, "fetchedAt": "2024", "entries": entries}))
    put(spark, f"{path}/state.json", '{"last": 1}')
    return files.envelopes(spark, path).select("category", "title", F.size("authors").alias("authors"))


@query("SELECT r_name AS source, n_name AS title FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_scan_posts(spark, sf_dir):
    """Posts in a folder for each source, one object or an array of them a file."""
    path, found = shared(spark, "posts"), {}
    for r in _nations(spark, sf_dir):
        found.setdefault(r.r_name, []).append({"id": str(r.n_nationkey), "title": r.n_name})
    for name, posts in found.items():
        put(spark, f"{path}/{name}/first.json", json.dumps(posts[0]))
        put(spark, f"{path}/{name}/rest.json", json.dumps(posts[1:]))
    return files.posts_by_source(spark, path).select("source", "title")


def _snapshots(spark, sf_dir) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy("event_type", F.date_format("ts", "yyyyMMdd").alias("day")).agg(F.count("*").alias("n"))
    path = shared(spark, "snapshots")
    for r in days.where("day <= '20240105'").collect():  # five kinds on five days
        put(spark, f"{path}/{r.event_type}/scrape_{r.day}_000000.json", json.dumps({"n": r.n}))
    put(spark, f"{path}/error/scrape_20230101_000000.json", "{broken")
    put(spark, f"{path}/error/other.json", '{"n": 1}')
    return files.snapshots(spark, path)


@query("SELECT event_type AS kind, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE strftime(ts, '%Y%m%d') <= '20240105' GROUP BY ALL")
def q_scan_snapshots(spark, sf_dir):
    """Snapshots by the time in their names; those that do not parse go."""
    rows = _snapshots(spark, sf_dir).withColumn("x", F.from_json("value", "n long")).where("x.n is not null")
    return rows.select(F.col("folder").alias("kind"), F.date_format("taken_at", "yyyy-MM-dd").alias("day"), "x.n")


@query("WITH d AS (SELECT event_type AS kind, strftime(ts, '%Y%m%d') AS day, count(*) AS n FROM events WHERE strftime(ts, '%Y%m%d') <= '20240105' GROUP BY ALL) SELECT kind, 'scrape_' || max(day) || '_000000.json' AS file, arg_max(n, day) AS n FROM d GROUP BY kind")
def q_scan_latest_per_folder(spark, sf_dir):
    last = files.latest_per_folder(_snapshots(spark, sf_dir))
    return last.select(F.col("folder").alias("kind"), "file", F.get_json_object("value", "$.n").cast("long").alias("n"))


POST_STATE = "struct<posts: map<string, struct<scrape_count: bigint, lambda_hat: double, last_scrape_ts: string>>>"


@query("SELECT 'there' AS state, n_name AS post, CAST(n_nationkey AS BIGINT) AS scrapes, round(0.15::DOUBLE + n_nationkey / 100.0::DOUBLE, 6) AS lambda_hat FROM nation")
def q_scan_scheduler_state(spark, sf_dir):
    """The scheduler's state by post; a missing and a corrupt file are an empty state."""
    path = shared(spark, "state")
    put(spark, f"{path}/good.json", json.dumps({"posts": {r.n_name: {"scrape_count": r.n_nationkey, "lambda_hat": 0.15 + r.n_nationkey / 100, "last_scrape_ts": "2024-01-01"} for r in _nations(spark, sf_dir)}}))
    put(spark, f"{path}/bad.json", "nonsense")
    states = {"there": "good.json", "corrupt": "bad.json", "missing": "none.json"}
    out = None
    for name, file in states.items():
        posts = files.state_or_default(spark, f"{path}/{file}", POST_STATE).select(F.lit(name).alias("state"), F.explode("state.posts").alias("post", "p"))
        out = posts if out is None else out.unionByName(posts)
    return out.select("state", "post", F.col("p.scrape_count").alias("scrapes"), r6(F.col("p.lambda_hat"), "lambda_hat"))


POLICY = "struct<rules: array<struct<low: int, high: int, method: string, bound: double>>>"


@query(
    """SELECT o_orderkey, CASE WHEN c_nationkey <= 4 THEN 'all' WHEN c_nationkey <= 9 THEN 'hot_only' ELSE 'sample' END AS method FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey <= 4 OR (c_nationkey BETWEEN 5 AND 9 AND o_totalprice >= 250000) OR (c_nationkey BETWEEN 10 AND 19 AND o_orderkey % 10 < 3)"""
)
def q_policy_from_file(spark, sf_dir):
    """Selection by rules from a configuration file; without one all would be sampled."""
    path = shared(spark, "policy")
    rules = [(0, 4, "all", 0.0), (5, 9, "hot_only", 250_000.0), (10, 19, "sample", 3.0)]
    put(spark, f"{path}/policy.json", json.dumps({"rules": [dict(zip(("low", "high", "method", "bound"), r, strict=True)) for r in rules]}))
    default = '{"rules": [{"low": 0, "high": 99, "method": "sample", "bound": 3.0}]}'
    rule = files.state_or_default(spark, f"{path}/policy.json", POLICY, default).select(F.inline("state.rules"))  # a few rows
    ranked = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("rank")), "o_custkey")
    m = F.col("method")
    met = ranked.join(F.broadcast(rule), F.col("rank").between(F.col("low"), F.col("high")))
    return met.where((m == "all") | ((m == "hot_only") & (F.col("o_totalprice") >= F.col("bound"))) | ((m == "sample") & (F.col("o_orderkey") % 10 < F.col("bound")))).select("o_orderkey", "method")


@query("SELECT lower(replace(n_name, ' ', '_')) AS name, CAST(row_number() OVER (ORDER BY n_nationkey DESC) - 1 AS INT) AS rank FROM nation")
def q_scan_priority_list(spark, sf_dir):
    path = f"{shared(spark, 'list')}/list.txt"
    put(spark, path, "# most wanted first\n\n" + "\n".join(("r/" if r.n_nationkey % 2 else "/r/") + r.n_name.replace(" ", "_") for r in reversed(_nations(spark, sf_dir))) + "\n")
    return files.priority_list(spark, path).select("name", F.col("rank").cast("int").alias("rank"))


@query("SELECT 'c.' || n_nationkey AS category, '2024-01-' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS start_day FROM nation")
def q_scan_category_config(spark, sf_dir):
    path = f"{shared(spark, 'config')}/categories.txt"
    put(spark, path, "\n".join(f"category: c.{r.n_nationkey}\n  start_date: 2024-01-{r.n_nationkey + 1:02}" for r in _nations(spark, sf_dir)))
    return files.category_config(spark, path).select("category", F.date_format("start_date", "yyyy-MM-dd").alias("start_day"))


@query("SELECT 'KEY_' || n_nationkey AS key, n_name || '=' || r_name AS value FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_scan_settings(spark, sf_dir):
    path = f"{shared(spark, 'settings')}/.env"
    put(spark, path, "# settings\n\n" + "\n".join(f"KEY_{r.n_nationkey} = {r.n_name}={r.r_name}" for r in _nations(spark, sf_dir)) + "\nnothing\n")
    return files.settings(spark, path)


@query("WITH l AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id DESC) AS back FROM events) SELECT count(*) AS n, round(avg(value), 4) AS mean, round(min(value), 4) AS lowest, round(max(value), 4) AS highest, round(avg(value) FILTER (back <= 20), 4) AS last_20 FROM l")
def q_scan_logs(spark, sf_dir):
    """Numbers out of log lines: mean, extremes, and the mean of the last twenty by their number."""
    path = shared(spark, "logs")
    events = table(spark, sf_dir, "events").select(F.format_string("[%d] took RPS=%s of it", F.col("event_id"), F.col("value").cast("string")).alias("value"))
    events.unionByName(events.limit(1).select(F.lit("RPS=bad").alias("value"))).write.text(path)
    numbers = {"rps": r"RPS=([\d.E-]+)", "id": r"^\[(\d+)\]"}
    lines = spark.read.text(path).select(*[F.nullif(F.regexp_extract("value", p, 1), F.lit("")).try_cast("double").alias(n) for n, p in numbers.items()]).where("rps is not null")
    found = files.log_values(spark, path, {"rps": numbers["rps"]}).agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.min("value"), 4).alias("lowest"), F.round(F.max("value"), 4).alias("highest"))
    last = lines.orderBy(F.desc("id")).limit(20).agg(F.round(F.avg("rps"), 4).alias("last_20"))
    return found.join(F.broadcast(last))  # one row each


def _atom(spark, sf_dir) -> DataFrame:
    path = shared(spark, "atom")
    entries = [
        f"<entry><id>http://x/abs/{r.n_nationkey}v2</id><title>On\n  {r.n_name}</title><summary> about </summary><published>2024-01-01</published><author><name>A</name></author>"
        + ("<author><name>B</name></author>" if r.n_nationkey % 2 else "") + f'<category term="{r.r_name}"/><link href="http://x/{r.n_nationkey}" rel="related" type="text/html"/></entry>'
        for r in _nations(spark, sf_dir)
    ]
    put(spark, f"{path}/feed.xml", "<feed>" + "\n".join(entries) + "</feed>")
    return files.atom_entries(spark, f"{path}/feed.xml")


@query("SELECT 'http://x/abs/' || n_nationkey || 'v2' AS id, 'On ' || n_name AS title, '2024-01-01' AS updated, CAST(1 + n_nationkey % 2 AS INT) AS authors, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_scan_atom(spark, sf_dir):
    return _atom(spark, sf_dir).select("id", "title", "updated", F.size("authors").alias("authors"), F.element_at("categories", 1).alias("category"))


@query("SELECT 'http://x/abs/' || (n_nationkey * 2) || 'v2' AS id, CASE WHEN n_nationkey * 2 < 25 THEN 'yes' ELSE 'no' END AS there FROM nation")
def q_feed_lookup(spark, sf_dir):
    """Entries by id; ids that the feed does not have come back empty."""
    wanted = table(spark, sf_dir, "nation").select(F.concat(F.lit("http://x/abs/"), (F.col("n_nationkey") * 2).cast("string"), F.lit("v2")).alias("id"))
    got = wanted.join(_atom(spark, sf_dir).select("id", "title"), "id", "left")
    return got.select("id", F.when(F.col("title").isNull(), "no").otherwise("yes").alias("there"))


@query("SELECT 'http://b/' || n_nationkey AS url, CASE WHEN n_nationkey % 3 = 0 THEN 'Untitled' ELSE n_name END AS title, CASE WHEN n_nationkey % 2 = 0 THEN 'g' || n_nationkey ELSE 'http://b/' || n_nationkey END AS id FROM nation")
def q_scan_rss(spark, sf_dir):
    path = shared(spark, "rss")
    items = [("<item>" + (f"<title>{r.n_name}</title>" if r.n_nationkey % 3 else "") + (f"<guid>g{r.n_nationkey}</guid>" if r.n_nationkey % 2 == 0 else "") + f"<link>http://b/{r.n_nationkey}</link></item>") for r in _nations(spark, sf_dir)]
    put(spark, f"{path}/feed.xml", "<rss><channel>" + "".join(items) + "</channel></rss>")
    return files.rss_items(spark, f"{path}/feed.xml").select("url", "title", "id")


@query("SELECT p_partkey AS page_id, p_name AS title, 'https://b.org/p/' || (p_partkey % 50) AS url FROM part WHERE p_partkey % 5 <> 4")
def q_scan_headings(spark, sf_dir):
    """Headings with the nearest link around or beside them; a heading without a link is none."""
    k, name = F.col("p_partkey"), F.col("p_name")
    a = F.concat(F.lit('<a href="/p/'), (k % 50).cast("string"), F.lit('">'))
    html = F.when(k % 5 < 2, F.concat(F.lit("<div>"), a, F.lit("<h3>"), name, F.lit("</h3></a></div>"))).when(k % 5 < 4, F.concat(F.lit("<div><h3>"), name, F.lit("</h3>"), a, F.lit("more</a></div>"))).otherwise(F.concat(F.lit("<h3>"), name, F.lit("</h3>")))
    return files.heading_links(table(spark, sf_dir, "part").select(k.alias("page_id"), html.alias("html")), "https://b.org/")


@query(
    """WITH p AS (SELECT *, p_partkey % 5 = 0 AS is_pdf, p_partkey % 3 + 1 AS tex FROM part), t AS (SELECT count(*) AS everything, count(*) FILTER (NOT is_pdf) AS sources FROM p),
u AS (SELECT 'kind' AS statistic, CASE WHEN is_pdf THEN 'pdf' ELSE 'source' END AS name, count(*) AS n, (SELECT everything FROM t) AS total FROM p GROUP BY ALL
  UNION ALL SELECT 'structure', CASE WHEN tex = 1 THEN 'single-file' ELSE 'multi-file' END, count(*), (SELECT sources FROM t) FROM p WHERE NOT is_pdf GROUP BY ALL
  UNION ALL SELECT 'main_file', 'main.tex', count(*), NULL FROM p WHERE NOT is_pdf HAVING count(*) > 0
  UNION ALL SELECT 'abstract', CASE WHEN p_partkey % 7 < 3 THEN 'yes' ELSE 'no' END, count(*), (SELECT sources FROM t) FROM p WHERE NOT is_pdf GROUP BY ALL
  UNION ALL SELECT 'header', 'introduction', count(*), (SELECT sources FROM t) FROM p WHERE NOT is_pdf UNION ALL SELECT 'header', 'method ' || (p_size % 4), count(*), (SELECT sources FROM t) FROM p WHERE NOT is_pdf GROUP BY ALL
  UNION ALL SELECT 'extension', 'tex', CAST(sum(tex) AS BIGINT), NULL FROM p WHERE NOT is_pdf UNION ALL SELECT 'extension', 'png', count(*), NULL FROM p WHERE NOT is_pdf UNION ALL SELECT 'extension', 'bib', count(*), NULL FROM p WHERE NOT is_pdf AND p_partkey % 2 = 0)
SELECT statistic, name, n, coalesce(CAST(floor(100 * n / total::DOUBLE + 0.5) AS BIGINT), -1) AS pct FROM u"""
)
def q_archive_statistics(spark, sf_dir):
    """Tar archives of papers, packed from the parts table, analysed and counted."""

    def pack(batches):
        import io
        import tarfile

        import pandas as pd

        for batch in batches:
            out = []
            for k, size in zip(batch["p_partkey"], batch["p_size"], strict=True):
                if k % 5 == 0:
                    out.append((f"{k}.pdf", b"%PDF-1.4 x"))
                    continue
                main = ("\\begin{abstract}A\\end{abstract}" if k % 7 < 3 else "") + f"\\section{{Introduction}} a \\section{{Method {size % 4}}} b"
                members = {"main.tex": main, "fig/one.PNG": "x"} | {f"a{i}.tex": "x" for i in range(k % 3)} | ({"refs.bib": "x"} if k % 2 == 0 else {})
                held = io.BytesIO()
                with tarfile.open(fileobj=held, mode="w", format=tarfile.USTAR_FORMAT) as tar:
                    for name, text in members.items():
                        info = tarfile.TarInfo(name)
                        info.size = len(text)
                        tar.addfile(info, io.BytesIO(text.encode()))
                out.append((f"{k}.tar", held.getvalue()))
            yield pd.DataFrame(out, columns=["path", "content"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # keys and sizes are small and lie in few row groups, their archives are not
    packed = table(spark, sf_dir, "part").select("p_partkey", "p_size").repartition(parts, "p_partkey").mapInPandas(pack, "path string, content binary")
    return files.archive_statistics(files.analysed(packed)).withColumn("pct", F.coalesce("pct", F.lit(-1)))


@query("SELECT user_id, event_id, round(value, 6) AS value, strftime(ts, '%Y-%m-%d') AS day, (SELECT format('{:,}', count(*)) FROM events) AS announced FROM events")
def q_json_lines_sink(spark, sf_dir):
    """A data set written newest first as JSON lines with its header, and read back."""
    path = shared(spark, "lines")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "value", F.col("ts").cast("timestamp").alias("ts"))
    sinks.json_lines(events, "ts", "event_id", "Events", path)
    said = spark.read.text(f"{path}/header", wholetext=True).select(F.regexp_extract("value", "Total items: ([0-9,]+)", 1).alias("announced"))  # one row
    rows = spark.read.schema("user_id long, event_id long, value double, ts timestamp").json(f"{path}/data")
    return rows.join(F.broadcast(said)).select("user_id", "event_id", r6(F.col("value"), "value"), F.date_format("ts", "yyyy-MM-dd").alias("day"), "announced")


@query("SELECT CAST(conv_id AS VARCHAR) AS thread, count(*) AS nodes, count(*) FILTER (turn > 0) AS edges FROM conversations GROUP BY conv_id")
def q_edge_list_sink(spark, sf_dir):
    path = shared(spark, "edges")
    turn = F.col("turn")
    nodes = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("thread"), turn.alias("node"), F.when(turn > 0, turn - 1).alias("parent"))
    sinks.edge_lists(nodes, path)
    rows = spark.read.schema("thread string, nodes array<struct<node: bigint>>, edges array<array<string>>").json(path)
    return rows.select("thread", F.size("nodes").cast("long").alias("nodes"), F.size("edges").cast("long").alias("edges"))


@query("SELECT DISTINCT fetched_at, p_partkey, 'x ' || p_name AS name FROM part, (VALUES ('2024-01-01'), ('2024-01-02')) v(fetched_at)")
def q_snapshot_sink(spark, sf_dir):
    """Snapshots appended under their time, with white space made single."""
    path = shared(spark, "appended")
    part = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("  x \t"), "p_name").alias("name"))
    for day in ("2024-01-01", "2024-01-02"):
        sinks.append_snapshot(part, day, path)
    return spark.read.schema("p_partkey long, name string, fetched_at string").json(path)


@query("SELECT r_name AS thread, 'n' || n_nationkey AS node, n_name AS author FROM nation JOIN region ON n_regionkey = r_regionkey")
def q_thread_file_sink(spark, sf_dir):
    """A file of nodes for each thread, written and read back by key."""
    path = shared(spark, "threads")
    nodes = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sinks.thread_files(nodes.select(F.col("r_name").alias("thread"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("node"), F.col("n_name").alias("author")), path)
    rows = spark.read.option("recursiveFileLookup", False).text(path, wholetext=True)
    return rows.select("thread", F.explode(F.from_json("value", "map<string, struct<node: string, author: string>>")).alias("node", "x")).select("thread", "node", "x.author")


@query("SELECT r_name || '.json' AS file, n, CASE WHEN late THEN 'since 3000' ELSE 'since 2000' END AS modified FROM (SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name), (VALUES (false)) v(late)")
def q_scan_modified(spark, sf_dir):
    """Files modified after a time: those just landed are after 2000, and none is after 3000."""
    path, found = shared(spark, "modified"), {}
    for r in _nations(spark, sf_dir):
        found.setdefault(r.r_name, []).append(r.n_name)
    for name, nations in found.items():
        put(spark, f"{path}/{name}.json", json.dumps(nations))
    out = None
    for year in ("2000", "3000"):
        seen = files.whole_files(spark, path, "*.json", modified_after=f"{year}-01-01T00:00:00")
        part = seen.select("file", F.json_array_length("value").cast("long").alias("n"), F.lit(f"since {year}").alias("modified"))
        out = part if out is None else out.unionByName(part)
    return out


@query("SELECT n_name || ': ' || count(s_suppkey) || ' suppliers' AS value FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def q_report_sink(spark, sf_dir):
    """A text report, a line a nation, written and read back."""
    path = shared(spark, "report")
    found = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"))
    rows = table(spark, sf_dir, "nation").join(found, "n_nationkey", "left")
    sinks.report(rows, F.concat("n_name", F.lit(": "), F.coalesce("c", F.lit(0)).cast("string"), F.lit(" suppliers")), path)
    return spark.read.text(path)
