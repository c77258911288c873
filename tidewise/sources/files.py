"""Readers of landed files: JSON directories, snapshots, lists, settings, logs, feeds, pages, archives (survey S1-S27)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewise.session import cut_lineage

NODE = "struct<id: string, parentId: string, author: string, createdUtc: double, permalink: string, depth: int, textHistory: array<struct<value: string, timestamp: string>>, scoreHistory: array<struct<value: bigint, timestamp: string>>, isDeleted: boolean, deletedAt: string, subreddit: string, title: string, url: string>"
ENTRY = "struct<id: string, title: string, summary: string, published: string, updated: string, authors: array<string>, categories: array<string>, primaryCategory: string, links: array<struct<rel: string, href: string, type: string>>, comment: string>"
POST = "struct<id: string, url: string, title: string, content: string, publishedAt: string, published: string, date: string, author: string, sourceId: string>"


def _plain(name: Column) -> Column:
    """A name out of a URI as it is on disk; a plus sign is no blank."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def file_name() -> Column:
    return _plain(F.col("_metadata.file_name"))


def parent_folder() -> Column:
    return _plain(F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1))


def whole_files(spark: SparkSession, path: str, glob: str, recursive: bool = False, modified_after: str | None = None) -> DataFrame:
    """value, file, folder: one row a file; `modified_after` is pushed into the listing."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.text(path, wholetext=True).select("value", file_name().alias("file"), parent_folder().alias("folder"))


def thread_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of node-map threads (one JSON object a file, keyed by node id) in file order; files that don't parse go."""
    parsed = whole_files(spark, path, "*.json").select("file", F.from_json("value", f"map<string, {NODE}>").alias("m")).where("m is not null")
    return parsed.select("file", F.posexplode(F.map_entries("m")).alias("position", "e")).select("file", "position", F.col("e.key").alias("node_id"), "e.value.*")


def envelopes(spark: SparkSession, path: str) -> DataFrame:
    """Entries of {category, fetchedAt, entries: [...]} files; the state file is none of them."""
    files = whole_files(spark, path, "*.json", recursive=True).where("file <> 'state.json'")
    parsed = files.select("file", F.from_json("value", f"struct<category: string, fetchedAt: string, entries: array<{ENTRY}>>").alias("x"))
    return parsed.select("file", "x.category", "x.fetchedAt", F.explode("x.entries").alias("e")).select("file", "category", "fetchedAt", "e.*")


def posts_by_source(spark: SparkSession, path: str) -> DataFrame:
    """Posts of files that hold one object or an array of them; the folder names the source."""
    files = whole_files(spark, path, "*.json", recursive=True)
    many = F.coalesce(F.from_json("value", f"array<{POST}>"), F.array(F.from_json("value", POST)))
    return files.select("folder", "file", F.explode(many).alias("p")).where("p is not null").select(F.col("folder").alias("source"), "file", "p.*")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """scrape_*.json files with the time in their names, to be ordered by name."""
    files = whole_files(spark, path, "scrape_*.json", recursive=True)
    return files.withColumn("taken_at", F.try_to_timestamp(F.regexp_extract("file", r"(\d{8}_\d{6})", 1), F.lit("yyyyMMdd_HHmmss")))


def latest_per_folder(files: DataFrame) -> DataFrame:
    return files.groupBy("folder").agg(F.max_by(F.struct("file", "value"), "file").alias("x")).select("folder", "x.file", "x.value")


def state_or_default(spark: SparkSession, path: str, schema: str, default: str = "{}") -> DataFrame:
    """One row of parsed state; a missing or corrupt file gives the default."""
    try:
        text = spark.read.text(path, wholetext=True)
        rows = text.agg(F.coalesce(F.max("value"), F.lit(default)).alias("value"))
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        rows = spark.createDataFrame([(default,)], "value string")
    parsed = F.from_json("value", schema)
    return rows.select(F.coalesce(parsed, F.from_json(F.lit(default), schema)).alias("state"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line (from 0) and value of a text file, in the file's order whatever its size: the file is read whole and split."""
    return spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "value"))


def priority_list(spark: SparkSession, path: str) -> DataFrame:
    """name, rank: listed names in order, without comments, blanks and the r/ prefix."""
    names = numbered_lines(spark, path).withColumn("name", F.lower(F.regexp_replace(F.trim("value"), "^/?r/", ""))).where("name <> '' and not startswith(name, '#')")
    return names.select("name", (F.row_number().over(Window.orderBy("line")) - 1).alias("rank"))  # a hand-written list


def category_config(spark: SparkSession, path: str) -> DataFrame:
    """category, start_date from lines 'category: x' / 'start_date: y' (a date belongs to the category above it)."""
    lines = numbered_lines(spark, path).select("line", F.regexp_extract("value", r"^\s*(\w+)\s*:\s*(.*?)\s*$", 1).alias("k"), F.regexp_extract("value", r"^\s*(\w+)\s*:\s*(.*?)\s*$", 2).alias("v"))
    above = F.last(F.when(F.col("k") == "category", F.col("v")), ignorenulls=True).over(Window.orderBy("line"))
    return lines.withColumn("category", above).where("k = 'start_date' and category is not null").select("category", F.to_date("v").alias("start_date"))


def _hidden_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of one small file whose name Spark's readers pass over (it begins with a full stop), read through the store's own interface."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        scanner = jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
        text = scanner.next() if scanner.hasNext() else ""
    finally:
        stream.close()
    return spark.createDataFrame(list(enumerate(text.splitlines())), "line int, value string")


def settings(spark: SparkSession, path: str) -> DataFrame:
    """key, value of KEY=VALUE lines, split at the first sign; comments and blanks go."""
    hidden = path.rsplit("/", 1)[-1][:1] in "._"
    whole = _hidden_lines(spark, path) if hidden else numbered_lines(spark, path)
    lines = whole.select(F.trim("value").alias("l")).where("l <> '' and not startswith(l, '#') and contains(l, '=')")
    both = F.split("l", "=", 2)
    return lines.select(F.trim(both[0]).alias("key"), F.trim(both[1]).alias("value"))


def log_values(spark: SparkSession, path: str, patterns: dict[str, str]) -> DataFrame:
    """metric, value for each line that a pattern's first group matches as a number."""
    lines = spark.read.text(path)
    found = F.array(*[F.struct(F.lit(k).alias("metric"), F.nullif(F.regexp_extract("value", p, 1), F.lit("")).try_cast("double").alias("x")) for k, p in patterns.items()])
    return lines.select(F.explode(found).alias("f")).where("f.x is not null").select("f.metric", F.col("f.x").alias("value"))


def atom_entries(spark: SparkSession, path: str) -> DataFrame:
    """Atom entries; one or many authors, categories and links alike."""
    schema = "id string, title string, summary string, published string, updated string, author array<struct<name: string>>, category array<struct<_term: string>>, link array<struct<_href: string, _rel: string, _type: string>>"
    rows = spark.read.option("rowTag", "entry").schema(schema).xml(path)
    return rows.select(
        "id", F.regexp_replace(F.trim("title"), r"\s+", " ").alias("title"), F.regexp_replace(F.trim("summary"), r"\s+", " ").alias("summary"), "published", F.coalesce("updated", "published").alias("updated"),
        F.transform("author", lambda a: a["name"]).alias("authors"), F.transform("category", lambda c: c["_term"]).alias("categories"),
        F.transform("link", lambda x: F.struct(x["_rel"].alias("rel"), x["_href"].alias("href"), x["_type"].alias("type"))).alias("links"),
    )


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("rowTag", "item").schema("guid string, link string, title string, description string, pubDate string, creator string").xml(path)
    return rows.select(F.coalesce("guid", "link").alias("id"), F.col("link").alias("url"), F.coalesce("title", F.lit("Untitled")).alias("title"), F.col("description").alias("content"), F.col("pubDate").alias("published_at"), F.col("creator").alias("author"))


def links_by_pattern(pages: DataFrame, part: str, least_title: int = 5) -> DataFrame:
    """page_id, href, title of links whose address holds `part`."""
    found = F.arrays_zip(F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="([^"]*)"[^>]*>.*?</a>'), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit(r'<a\s[^>]*href="[^"]*"[^>]*>(.*?)</a>'), F.lit(1)).alias("title"))
    links = pages.select("page_id", F.explode(found).alias("l")).select("page_id", F.col("l.href").alias("href"), F.trim(F.regexp_replace("l.title", "<[^>]*>", "")).alias("title"))
    return links.where(F.col("href").contains(part) & (F.length("title") > least_title)).distinct()


def heading_links(pages: DataFrame, base: str) -> DataFrame:
    """page_id, title, url: each h3 heading with the nearest link around or in its block, made absolute, last of equal ones first seen."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from html.parser import HTMLParser
        from urllib.parse import urljoin

        class Reader(HTMLParser):
            def __init__(self) -> None:
                super().__init__()
                self.open, self.found, self.heading = [], [], None

            def handle_starttag(self, tag, attrs):
                href = dict(attrs).get("href") if tag == "a" else None
                self.open.append([tag, href])
                if href:
                    for block in self.open[-3:-1]:
                        block[1] = block[1] or href
                    for item in self.found:
                        if item[1] is None and item[2] in map(id, self.open[-3:]):
                            item[1] = href
                if tag == "h3":
                    near = next((b[1] for b in reversed(self.open[-3:]) if b[1]), None)
                    self.heading = ["", near, id(self.open[-2]) if len(self.open) > 1 else None]

            def handle_data(self, data):
                if self.heading:
                    self.heading[0] += data

            def handle_endtag(self, tag):
                if tag == "h3" and self.heading:
                    self.found.append(self.heading)
                    self.heading = None
                while self.open:
                    if self.open.pop()[0] == tag:
                        break

        for batch in batches:
            out = []
            for page_id, html in zip(batch["page_id"], batch["html"], strict=True):
                reader = Reader()
                reader.feed(html or "")
                seen = {}
                for title, href, _ in reader.found:
                    if href and title.strip():
                        seen[urljoin(base, href)] = title.strip()
                out += [(page_id, title, url) for url, title in seen.items()]
            yield pd.DataFrame(out, columns=["page_id", "title", "url"])

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, title string, url string")


def archives(spark: SparkSession, path: str) -> DataFrame:
    """The source archives under a path, analysed."""
    return analysed(spark.read.format("binaryFile").load(path).select("path", "content"))


def analysed(packed: DataFrame) -> DataFrame:
    """Members and text of source archives (path, content): name, is_pdf, files, main_file, headers, has_abstract."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import io
        import re
        import tarfile

        # fixed values: usual names of the main file, then names of templates
        names = ("main.tex", "paper.tex", "root.tex", "manuscript.tex", "article.tex")
        templates = [re.compile(r"acl.*\.tex$"), *(re.compile(rf"{t}.*\.tex$", re.I) for t in ("ieee", "iclr", "neurips"))]
        for batch in batches:
            out = []
            for file, content in zip(batch["path"], batch["content"], strict=True):
                name = file.rsplit("/", 1)[-1]
                row = {"name": name, "is_pdf": content[:4] == b"%PDF", "files": [], "main_file": None, "headers": [], "has_abstract": False}
                if not row["is_pdf"]:
                    try:
                        plain = content[257:262] == b"ustar" and content[:2] not in (b"\x1f\x8b", b"BZ", b"\xfd7")  # without asking gzip, bzip2 and xz first
                        with tarfile.open(fileobj=io.BytesIO(content), mode="r:" if plain else "r") as tar:
                            members = {m.name: m for m in tar.getmembers() if m.isfile()}
                            row["files"] = list(members)
                            tex = [m for m in members if m.endswith(".tex") and "/" not in m]
                            choices = [n for n in names if n in tex] + [m for t in templates for m in tex if t.search(m)] + tex
                            main = choices[0] if choices else None
                            text = tar.extractfile(members[main]).read().decode("utf-8", "replace") if main else ""
                    except tarfile.TarError:
                        main, text = (name, gzip.decompress(content).decode("utf-8", "replace")) if content[:2] == b"\x1f\x8b" else (None, "")
                    row["main_file"], row["headers"] = main, re.findall(r"\\(?:sub){0,2}section\{([^}]+)\}", text)
                    row["has_abstract"] = "\\begin{abstract}" in text
                out.append(row)
            yield pd.DataFrame(out)

    return packed.mapInPandas(run, "name string, is_pdf boolean, files array<string>, main_file string, headers array<string>, has_abstract boolean")


def archive_structure(archive: DataFrame) -> DataFrame:
    """archive with its file structure class and extension counts."""
    tex = F.filter("files", lambda f: f.endswith(".tex") & ~f.contains("/"))
    n = F.size(tex)
    kind = F.when(F.exists(tex, lambda f: f.rlike("^[0-9][0-9]-")) | (n > 10), "modular").when(n == 1, "single-file").when(n >= 2, "multi-file").otherwise("unknown")
    extension = F.transform("files", lambda f: F.lower(F.regexp_extract(f, r"\.([^./]+)$", 1)))
    counts = F.map_from_entries(F.transform(F.array_distinct(extension), lambda e: F.struct(e.alias("k"), F.size(F.filter(extension, lambda x: x == e)).alias("v"))))
    return archive.withColumn("structure", kind).withColumn("tex_files", F.size(tex)).withColumn("extensions", counts)


def clean_latex(text: Column) -> Column:
    """Plain text of LaTeX: comments, commands and environments out, braces opened."""
    for pattern, to in ((r"(?m)(?<!\\)%.*$", ""), (r"\\begin\{[^}]*\}|\\end\{[^}]*\}", " "), (r"\\(?:cite|ref|label)\{[^}]*\}", ""), (r"\\[a-zA-Z]+\*?(?:\[[^\]]*\])?\{([^}]*)\}", "$1"), (r"\\[a-zA-Z]+", " "), (r"[{}~]", " "), (r"\s+", " ")):
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)


def section_class(header: Column) -> Column:
    h = F.lower(F.trim(header))
    rules = (("introduction", "introduction"), ("related|background|prior work", "background"), ("method|approach|model", "method"), ("experiment|evaluation|setup", "experiment"), ("result", "result"), ("discussion|limitation", "discussion"), ("conclusion|future", "conclusion"), ("appendix|supplement", "appendix"), ("acknowledg", "acknowledgement"), ("reference|bibliograph", "reference"))
    out = F.lit("other")
    for pattern, name in reversed(rules):
        out = F.when(h.rlike(pattern), name).otherwise(out)
    return out


def sections(papers: DataFrame, key: str, text: str) -> DataFrame:
    """key, place, header, kind, content: the abstract (place 0) and each section from its command to the next one's (survey X8)."""
    abstract = F.trim(F.regexp_extract(text, r"(?s)\\begin\{abstract\}(.*?)\\end\{abstract\}", 1))
    first = F.when(F.col(text).rlike(r"(?s)\\begin\{abstract\}.*\\end\{abstract\}"), F.array(F.struct(F.lit("Abstract").alias("header"), F.lit("abstract").alias("kind"), abstract.alias("content")))).otherwise(F.array())
    parts = F.filter(F.split(text, r"(?=\\section\{[^}]+\})"), lambda p: p.startswith("\\section{"))

    def named(part: Column) -> Column:
        header = F.regexp_extract(part, r"^\\section\{([^}]+)\}", 1)
        return F.struct(header.alias("header"), section_class(header).alias("kind"), part.alias("content"))

    return papers.select(key, F.posexplode(F.concat(first, F.transform(parts, named))).alias("place", "s")).select(key, "place", "s.*")


def is_bibliography(name: Column) -> Column:
    """Files that hold references and no text (survey X10)."""
    return name.endswith(".bib") | name.endswith(".bbl") | (name.contains("ref") & name.endswith(".tex")) | name.contains("bibliograph")


def archive_statistics(archive: DataFrame) -> DataFrame:
    """statistic, name, n, pct of analysed archives (survey A43): kinds and structures, main files, abstracts, the 30 commonest headers and the 15
    commonest extensions; shares are of sources that are not PDF, but for the kinds, rounded half up.

    An archive is unpacked once: it gives all that is counted of it as rows, and what is read several times is the counts."""
    source, one = F.expr("not is_pdf"), F.lit(1).cast("long")

    def item(statistic: str, name: Column, n: Column = one) -> Column:
        return F.struct(F.lit(statistic).alias("statistic"), name.alias("name"), n.alias("n"))

    def given(condition: Column, items: Column) -> Column:
        return F.when(condition, items).otherwise(F.array().cast("array<struct<statistic: string, name: string, n: bigint>>"))

    items = F.concat(
        F.array(item("kind", F.when(F.col("is_pdf"), "pdf").otherwise("source"))),
        given(source, F.array(item("structure", F.col("structure")), item("abstract", F.when(F.col("has_abstract"), "yes").otherwise("no")))),
        given(F.col("main_file").isNotNull(), F.array(item("main_file", F.col("main_file")))),
        given(source & F.col("headers").isNotNull(), F.transform("headers", lambda h: item("header", F.lower(F.trim(h))))),
        given(F.col("extensions").isNotNull(), F.transform(F.map_entries("extensions"), lambda e: item("extension", e["key"], e["value"].cast("long")))),
    )
    counted = cut_lineage(archive_structure(archive).select(F.inline(items)).groupBy("statistic", "name").agg(F.sum("n").alias("n")))
    kind, n = F.col("statistic"), F.col("n")
    total = counted.agg(F.sum(F.when(kind == "kind", n)).alias("all"), F.sum(F.when(kind == "structure", n)).alias("sources"))  # one row; a source has one structure
    most = {"header": 30, "extension": 15}
    out = counted.where(~kind.isin(*most))
    for statistic, rows in most.items():
        out = out.unionByName(counted.where(kind == statistic).orderBy(F.desc("n"), "name").limit(rows))
    of = F.when(kind == "kind", F.col("all")).when(kind.isin("structure", "abstract", "header"), F.col("sources"))
    return out.join(F.broadcast(total)).select("statistic", "name", "n", F.floor(100 * n / of + 0.5).cast("long").alias("pct"))
