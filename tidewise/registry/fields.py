"""Scalar rules one by one: fallbacks, flags, formats, coverage curves, sections, shapes of nodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewise.functions import fallback, models, temporal
from tidewise.operators import threads
from tidewise.registry.base import query, r6, table
from tidewise.sources import files


@query("SELECT c_custkey, coalesce(nullif(CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END, ''), nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, ''), 'Untitled') AS title FROM customer")
def q_first_truthy(spark, sf_dir):
    k = F.col("c_custkey")
    a, b = F.when(k % 3 == 0, "").when(k % 3 == 1, F.lit(None)).otherwise(F.col("c_name")), F.when(k % 2 == 0, "").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select("c_custkey", fallback.first_truthy(a, b, F.lit("Untitled")).alias("title"))


@query("SELECT o_orderkey, regexp_replace('t' || (o_orderkey % 6) || '_' || o_orderkey, '^t[13]_', '') AS bare, o_orderkey % 6 = 3 AS is_root FROM orders")
def q_unprefixed_ids(spark, sf_dir):
    name = F.concat(F.lit("t"), (F.col("o_orderkey") % 6).cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fallback.unprefixed(name).alias("bare"), fallback.is_root_reference(name).alias("is_root"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(epoch(o_orderdate) AS BIGINT) ELSE -1 END AS sec FROM orders")
def q_parse_timestamps(spark, sf_dir):
    """ISO with a zone, ISO without, the compact form in a file name, and text that holds no time."""
    ts, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    said = F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).when(k == 2, F.concat(F.lit("scrape_"), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit(".json"))).otherwise("soon")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.coalesce(F.floor(temporal.epoch(temporal.parse_timestamp(said))).cast("long"), F.lit(-1)).alias("sec"))


@query("SELECT s_suppkey, least(greatest(s_acctbal, 0), 5000) AS kept, round(least(greatest(s_acctbal / 10000, 0), 1), 6) AS share FROM supplier")
def q_clamped(spark, sf_dir):
    b = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select("s_suppkey", models.clamp(b, 0.0, 5000.0).alias("kept"), r6(models.clamp(b / 10_000, 0.0, 1.0), "share"))


@query("SELECT o_orderkey, coalesce(lower(trim(CASE o_orderkey % 5 WHEN 0 THEN '1' WHEN 1 THEN ' TRUE ' WHEN 2 THEN 'Yes' WHEN 3 THEN 'off' END)) IN ('1', 'true', 'yes', 'on'), false) AS flag FROM orders")
def q_flags(spark, sf_dir):
    k = F.col("o_orderkey") % 5
    return table(spark, sf_dir, "orders").select("o_orderkey", fallback.as_flag(F.when(k == 0, "1").when(k == 1, " TRUE ").when(k == 2, "Yes").when(k == 3, "off")).alias("flag"))


@query("SELECT o_orderkey, CAST(floor(floor(o_totalprice) / 60) AS INT) || 'm ' || CAST(CAST(floor(o_totalprice) AS BIGINT) % 60 AS INT) || 's' AS took, strftime(o_orderdate, '%Y%m%d%H%M') AS stamp FROM orders")
def q_durations(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", temporal.minutes_seconds(F.col("o_totalprice")).alias("took"), temporal.compact_minutes(F.col("o_orderdate")).alias("stamp"))


@query(r"SELECT p_partkey, regexp_replace(trim('  ' || replace(p_name, ' ', chr(9) || '  ') || ' '), '\s+', ' ', 'g') AS tidy FROM part")
def q_collapsed(spark, sf_dir):
    loose = F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("\t  ")), F.lit(" "))
    return table(spark, sf_dir, "part").select("p_partkey", fallback.collapsed(loose).alias("tidy"))


@query(
    """WITH n AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'Withdrawn for now' WHEN 1 THEN 'was RETRACTED' WHEN 2 THEN p_name END AS comment, CASE WHEN p_partkey % 7 = 0 THEN 'This Paper has been withdrawn' ELSE p_name END AS summary FROM part)
SELECT p_partkey, regexp_matches(lower(coalesce(comment, '')), 'withdrawn|retracted|removed by author') OR regexp_matches(lower(summary), 'paper has been withdrawn|this submission has been withdrawn') AS withdrawn FROM n"""
)
def q_withdrawn(spark, sf_dir):
    k = F.col("p_partkey")
    comment = F.when(k % 5 == 0, "Withdrawn for now").when(k % 5 == 1, "was RETRACTED").when(k % 5 == 2, F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", fallback.is_withdrawn(comment, F.when(k % 7 == 0, "This Paper has been withdrawn").otherwise(F.col("p_name"))).alias("withdrawn"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'http://x/e/' || p_partkey WHEN 1 THEN 'http://x/' || p_partkey || '.tar.gz' WHEN 2 THEN 'http://x/t/' || p_partkey ELSE 'https://arxiv.org/e-print/' || p_partkey || 'v2' END AS source FROM part")
def q_source_links(spark, sf_dir):
    """The best address among an entry's links: what is marked as a source, a tar archive, a tar name, else the derived one."""
    k, name = F.col("p_partkey"), F.col("p_partkey").cast("string")

    def link(rel, start, end, kind):
        return F.struct(F.lit(rel).cast("string").alias("rel"), F.concat(F.lit(start), name, F.lit(end)).alias("href"), F.lit(kind).cast("string").alias("type"))

    page, paper = link("alternate", "http://x/abs/", "", "text/html"), link("related", "http://x/", ".pdf", "application/x-eprint")
    links = F.when(k % 4 == 0, F.array(page, paper, link("related", "http://x/e/", "", "application/x-eprint-tar"))).when(k % 4 == 1, F.array(page, link("alternate", "http://x/", ".tar.gz", None)))
    links = links.when(k % 4 == 2, F.array(link("alternate", "http://x/", ".tar", None), link("derived", "http://x/t/", "", "application/x-tar"))).otherwise(F.array(page, paper))
    return table(spark, sf_dir, "part").select("p_partkey", fallback.source_link(links, F.concat(F.lit("http://x/abs/"), name, F.lit("v2"))).alias("source"))


@query("SELECT c_custkey, CAST(to_json({c_name: c_name, c_mktsegment: c_mktsegment}) AS VARCHAR) AS extra FROM customer")
def q_extra_fields(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return threads.with_remainder(rows, ["c_custkey"])


@query("SELECT conv_id, turn, round(0.5::DOUBLE * (length(text) % 97) + 0.2::DOUBLE * (turn / 10.0::DOUBLE) + 0.1::DOUBLE * (turn % 2), 6) AS importance FROM conversations")
def q_batch_importance(spark, sf_dir):
    score, turn = F.length("text") % 97, F.col("turn")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", r6(models.batch_importance(score, turn / F.lit(10.0), turn % 2), "importance"))


@query("SELECT n_nationkey AS rank, round(CASE WHEN n_nationkey <= 5 THEN 1 ELSE greatest(1 - 0.8::DOUBLE * (n_nationkey - 5) / 15, 0.2::DOUBLE) END, 6) AS ramp, round(0.2::DOUBLE + 0.8::DOUBLE / (1 + exp(0.4::DOUBLE * (n_nationkey - 10))), 6) AS soft FROM nation")
def q_coverage_curves(spark, sf_dir):
    rank = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(rank.alias("rank"), r6(models.ramp_coverage(rank, 5, 20, 0.2), "ramp"), r6(models.floor_sigmoid_coverage(rank, 0.4, 10.0, 0.2), "soft"))


@query("SELECT event_id, CASE WHEN event_id % 11 >= 9 THEN 'high' WHEN event_id % 11 >= 6 THEN 'medium' ELSE 'low' END AS tier, round((event_id % 11) * CASE WHEN event_id % 100 < 24 THEN 1.0::DOUBLE WHEN event_id % 100 < 48 THEN 0.6::DOUBLE WHEN event_id % 100 < 72 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END, 6) AS weight FROM events")
def q_confidence(spark, sf_dir):
    score, hours = F.col("event_id") % 11, F.col("event_id") % 100
    return table(spark, sf_dir, "events").select("event_id", models.confidence(score).alias("tier"), r6(models.weighted_confidence(score, hours), "weight"))


#: Words of advertising, and signs of substance: digits.
HYPE = ("the", "licensed", "free", "best", "und", "que")


@query(
    f"""WITH w AS (SELECT source, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS word FROM documents), c AS (SELECT source, count(*) FILTER (word IN ({", ".join(f"'{h}'" for h in HYPE)})) AS hype, count(*) FILTER (regexp_matches(word, '^[0-9]')) AS substance FROM w GROUP BY source)
SELECT source, hype, substance, round(hype / nullif(substance, 0)::DOUBLE, 6) AS ratio, coalesce(hype / nullif(substance, 0)::DOUBLE > 2, hype > 0) AS marketing_heavy FROM c"""
)
def q_hype_ratio(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select("source", F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("word"))
    c = words.groupBy("source").agg(F.count_if(F.col("word").isin(*HYPE)).alias("hype"), F.count_if(F.col("word").rlike("^[0-9]")).alias("substance"))
    return c.withColumn("r", models.hype_ratio(F.col("hype"), F.col("substance").cast("double"))).select("source", "hype", "substance", r6(F.col("r.ratio"), "ratio"), "r.marketing_heavy")


@query("SELECT p_partkey, p_size <> 0 AND p_name <> '' AND p_partkey % 6 <> 0 AND p_partkey % 4 <> 1 AS kept FROM part")
def q_required_fields(spark, sf_dir):
    """Rows that lack an id, a time or a name (null, zero or empty) are no entries."""
    k = F.col("p_partkey")
    fine = fallback.is_truthy(F.col("p_size"), "int") & fallback.is_truthy(F.col("p_name"), "string") & fallback.is_truthy(F.when(k % 4 != 1, k % 6), "int")
    return table(spark, sf_dir, "part").select("p_partkey", fine.alias("kept"))


@query("SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN NULL ELSE role || turn END AS text FROM conversations")
def q_entry_text(spark, sf_dir):
    """History entries as arrays, objects under several keys and plain strings."""
    said, k = F.concat(F.lit('"'), "role", F.col("turn").cast("string"), F.lit('"')), F.col("turn") % 4
    entry = F.when(k == 0, F.concat(F.lit("["), said, F.lit(', "2024"]'))).when(k == 1, F.concat(F.lit('{"by": 1, "body": '), said, F.lit("}"))).when(k == 2, said).otherwise('{"other": 2}')
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", fallback.entry_text(entry).alias("text"))


@query(
    rf"""SELECT p_partkey, 0 AS place, 'Abstract' AS header, 'abstract' AS kind, 'On ' || p_name AS content FROM part UNION ALL SELECT p_partkey, 1, 'Introduction', 'introduction', '\section{{Introduction}} One. ' FROM part
UNION ALL SELECT p_partkey, 2, 'Related ' || p_brand, 'background', '\section{{Related ' || p_brand || '}} Two. ' FROM part UNION ALL SELECT p_partkey, 3, 'Limits', 'other', '\section{{Limits}} \textbf{{' || p_type || '}}~\cite{{a}}' FROM part"""
)
def q_paper_sections(spark, sf_dir):
    papers = table(spark, sf_dir, "part").select("p_partkey", F.expr("concat(r'\\begin{abstract} On ', p_name, r' \\end{abstract}\\section{Introduction} One. \\section{Related ', p_brand, r'} Two. \\section{Limits} \\textbf{', p_type, r'}~\\cite{a}')").alias("latex"))
    return files.sections(papers, "p_partkey", "latex")


@query("SELECT p_partkey, p_name || ' (' || p_type || ') and' AS plain FROM part")
def q_clean_latex(spark, sf_dir):
    latex = F.concat(F.lit("% a note\n\\begin{center}\\textbf{"), "p_name", F.lit("}\\end{center} ("), "p_type", F.lit(")~and\\cite{x}\n"))
    return table(spark, sf_dir, "part").select("p_partkey", files.clean_latex(latex).alias("plain"))


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN true ELSE false END AS references_only FROM part")
def q_bibliography_files(spark, sf_dir):
    names = F.array(*map(F.lit, ("main.bib", "main.bbl", "my_refs.tex", "bibliography.txt", "method.tex", "reference.txt")))
    return table(spark, sf_dir, "part").select("p_partkey", files.is_bibliography(F.element_at(names, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("references_only"))


@query("SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN 2 WHEN coalesce(text, '') = '' THEN 0 ELSE 1 END AS texts, 1 AS scores, CASE WHEN turn % 2 = 0 THEN 'old' ELSE nullif(text, '') END AS first_text FROM conversations")
def q_upgraded_nodes(spark, sf_dir):
    """Every second node has a text history already; all get histories, and none keeps the legacy columns."""
    entry = lambda v: F.struct(v.alias("value"), F.lit("2024").alias("ts"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", F.col("turn").alias("score"), F.when(F.col("turn") % 2 == 0, F.array(entry(F.lit("old")), entry(F.col("text")))).alias("text_history"), F.lit(None).cast("array<struct<value: bigint, ts: string>>").alias("score_history"))
    up = threads.upgraded(rows, F.lit("2024"))
    return up.select("conv_id", "turn", F.size("text_history").alias("texts"), F.size("score_history").alias("scores"), F.try_element_at("text_history", F.lit(1))["value"].alias("first_text"))


@query("SELECT CAST(conv_id AS VARCHAR) AS thread, CAST(turn AS VARCHAR) AS node, CASE WHEN turn > 0 THEN CAST(turn - 1 AS VARCHAR) END AS parent, role AS author, coalesce(text, '') AS text, turn * 3 AS score FROM conversations")
def q_clean_nodes(spark, sf_dir):
    """Threads as maps of nodes in camel case, made flat and cleaned (twice, which changes nothing)."""
    past = lambda v: F.array(F.struct(v.alias("value"), F.lit("t").alias("timestamp")))
    turn = F.col("turn")
    node = F.struct(turn.cast("string").alias("id"), F.when(turn > 0, (turn - 1).cast("string")).alias("parentId"), F.col("role").alias("author"), past(F.col("text")).alias("textHistory"), past(turn * 3).alias("scoreHistory"))
    maps = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("thread")).agg(F.map_from_entries(F.collect_list(F.struct(turn.cast("string").alias("k"), node.alias("v")))).alias("m"))
    return threads.clean(threads.clean(threads.from_map(maps)))
