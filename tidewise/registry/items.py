"""Cross-domain items: enrichment, dedup, unions, summaries, URLs and pages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewise.functions import fallback, temporal
from tidewise.operators import relational
from tidewise.registry.base import query, table

START, END = "2024-01-08 00:00:00", "2024-01-22 00:00:00"
TAG = "CASE WHEN d < 1 THEN 'BREAKING' WHEN d < 7 THEN 'EMERGING' WHEN d < 30 THEN 'SUSTAINED' ELSE 'RESURGENT' END"


def _enriched(spark, sf_dir):
    ts, end = F.col("ts").cast("timestamp"), F.lit(END).cast("timestamp")
    days = temporal.days_ago(ts, end)
    window = table(spark, sf_dir, "events").where(F.col("ts").between(F.lit(START).cast("timestamp_ntz"), F.lit(END).cast("timestamp_ntz")))
    return window.select("event_id", "event_type", F.floor(temporal.epoch(ts)).cast("long").alias("meta_timestamp"), F.date_format(ts, "yyyy-MM-dd").alias("meta_date_human"), days.alias("meta_days_ago"), temporal.temporal_tag(days).alias("meta_temporal_tag"), temporal.temporal_weight(days * 24).alias("meta_temporal_weight"))


ENRICHED = f"""w AS (SELECT *, CAST(floor((epoch_us(TIMESTAMP '{END}') - epoch_us(ts)) / 1e6 / 86400) AS BIGINT) AS d FROM events WHERE ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'),
  enriched AS (SELECT event_id, event_type, CAST(floor(epoch_us(ts) / 1e6) AS BIGINT) AS meta_timestamp, strftime(ts, '%Y-%m-%d') AS meta_date_human, d AS meta_days_ago, {TAG} AS meta_temporal_tag,
    CAST(CASE WHEN d * 24 < 24 THEN 1.0 WHEN d * 24 < 48 THEN 0.6 WHEN d * 24 < 72 THEN 0.3 ELSE 0.1 END AS DOUBLE) AS meta_temporal_weight FROM w)"""


@query(f"WITH {ENRICHED} SELECT * FROM enriched ORDER BY meta_timestamp DESC, event_id")
def q_temporal_enrich(spark, sf_dir):
    return _enriched(spark, sf_dir).orderBy(F.desc("meta_timestamp"), "event_id")


@query(
    f"""WITH {ENRICHED} SELECT event_type, count(*) FILTER (meta_temporal_tag = 'BREAKING') AS breaking, count(*) FILTER (meta_temporal_tag = 'EMERGING') AS emerging,
  count(*) FILTER (meta_temporal_tag = 'SUSTAINED') AS sustained, count(*) FILTER (meta_temporal_tag = 'RESURGENT') AS resurgent, round(sum(meta_temporal_weight), 6) AS weight FROM enriched GROUP BY event_type"""
)
def q_temporal_bucket_counts(spark, sf_dir):
    tags = {"breaking": "BREAKING", "emerging": "EMERGING", "sustained": "SUSTAINED", "resurgent": "RESURGENT"}
    return _enriched(spark, sf_dir).groupBy("event_type").agg(*[F.count_if(F.col("meta_temporal_tag") == t).alias(n) for n, t in tags.items()], F.round(F.sum("meta_temporal_weight"), 6).alias("weight"))


@query("SELECT string_agg(x, ', ' ORDER BY n DESC, source) AS top_sources, CAST(sum(n) AS BIGINT) AS n_top FROM (SELECT source, count(*) AS n, source || ' (' || count(*) || ')' AS x FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 5)")
def q_top_sources(spark, sf_dir):
    top = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source").limit(5)
    listed = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "source", F.concat("source", F.lit(" ("), F.col("n").cast("string"), F.lit(")")).alias("x"))))
    return top.agg(F.array_join(F.transform(listed, lambda s: s["x"]), ", ").alias("top_sources"), F.sum("n").cast("long").alias("n_top"))


@query(
    """WITH t AS (SELECT conv_id, count(*) AS n, count(*) - 1 AS comments FROM conversations GROUP BY conv_id)
SELECT count(*) AS threads, CAST(sum(comments) AS BIGINT) AS total_comments, round(avg(comments), 6) AS mean_comments, CAST(max(n) AS BIGINT) AS largest FROM t"""
)
def q_comment_totals(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return t.agg(F.count("*").alias("threads"), F.sum(F.col("n") - 1).cast("long").alias("total_comments"), F.round(F.avg(F.col("n") - 1), 6).alias("mean_comments"), F.max("n").cast("long").alias("largest"))


@query(
    """SELECT doc_id, source, n_chars FROM (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY coalesce(nullif(md5(text), ''), source) ORDER BY doc_id) AS n
  FROM documents WHERE n_chars >= 200) WHERE n = 1"""
)
def q_dedup_first_wins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("n_chars >= 200").select("doc_id", "source", "n_chars", F.md5(F.col("text").cast("binary")).alias("digest"))
    return relational.first_wins(docs, fallback.first_truthy(F.col("digest"), F.col("source")), "doc_id").select("doc_id", "source", "n_chars")


@query(
    """SELECT host, arg_max(url, page_id) AS url, max(page_id) AS page_id, min(page_id) AS first_position
FROM (SELECT page_id, url, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages) GROUP BY host"""
)
def q_dedup_last_wins(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), "url", "page_id", F.col("page_id").alias("position"))
    return relational.last_wins(pages, "host", "position").select("host", "url", "page_id", "first_position")


@query(
    """SELECT domain, count(*) AS items, CAST(sum(size) AS BIGINT) AS chars FROM (
  SELECT 'documents' AS domain, length(text) AS size FROM documents UNION ALL SELECT 'pages', length(html) FROM pages UNION ALL SELECT 'conversations', length(text) FROM conversations) GROUP BY domain"""
)
def q_union_domains(spark, sf_dir):
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("domain"), F.length(c).alias("size")) for t, c in (("documents", "text"), ("pages", "html"), ("conversations", "text"))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return both.groupBy("domain").agg(F.count("*").alias("items"), F.sum("size").cast("long").alias("chars"))


@query("SELECT page_id, coalesce(nullif(regexp_extract(url, '/([a-z]{2})/[0-9]+', 1), ''), 'none') AS section, CAST(nullif(regexp_extract(url, '/([0-9]+)', 1), '') AS BIGINT) AS number, regexp_replace(url, '[^a-zA-Z0-9.-]', '_', 'g') AS safe FROM pages")
def q_url_ids(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", fallback.path_part(url, "/([a-z]{2})/[0-9]+", "none").alias("section"), fallback.path_part(url, "/([0-9]+)").cast("long").alias("number"), fallback.safe_name(url).alias("safe"))


@query(
    """SELECT page_id, href, title FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS title FROM pages)
WHERE length(title) > 5 AND starts_with(href, '/') GROUP BY ALL"""
)
def q_html_links(spark, sf_dir):
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit('<a href="([^"]*)">[^<]*</a>'), F.lit(1)).alias("href"), F.regexp_extract_all("html", F.lit('<a href="[^"]*">([^<]*)</a>'), F.lit(1)).alias("title"))
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(both).alias("l")).select("page_id", F.col("l.href").alias("href"), F.col("l.title").alias("title"))
    return links.where((F.length("title") > 5) & F.col("href").startswith("/")).distinct()


@query("SELECT event_type, CAST(sum(k) AS BIGINT) AS k_sum, CAST(max(k) AS BIGINT) AS k_max, count(k) AS k_count FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type")
def q_json_props(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("event_type", k.alias("k")).groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.max("k").alias("k_max"), F.count("k").alias("k_count"))


@query("SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages h WHERE contains(h.url, '/en/') AND h.url = p.url)")
def q_anti_history(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    history = pages.where("contains(url, '/en/')").select("url").distinct()
    return pages.join(history, "url", "left_anti").select("page_id", "url")


@query("SELECT min(doc_id) AS doc_id, n_chars, lang FROM documents GROUP BY n_chars, lang")
def q_seen_dedup(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("n_chars", "lang").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "n_chars", "lang")


#: Words that are no keywords.
STOP_WORDS = (
    "the", "and", "to", "of", "a", "in", "is", "that", "for", "it", "on", "with", "as", "was", "at", "by", "an", "be", "this", "which", "or", "from",
    "but", "not", "are", "your", "have", "can", "you", "if", "we", "my", "me", "about", "so", "they", "what", "like", "just", "do", "no", "one",
    "all", "will", "there", "their", "has", "more", "who", "when", "out", "up", "would", "get", "some", "time", "actually", "deleted", "removed",
)


@query(
    f"""SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[^a-z0-9'']+')) AS word FROM documents)
WHERE length(word) > 3 AND word NOT IN ({", ".join(f"'{w}'" for w in STOP_WORDS)}) GROUP BY word ORDER BY n DESC, word LIMIT 50"""
)
def q_keywords(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), "[^a-z0-9']+")).alias("word"))
    kept = words.where((F.length("word") > 3) & ~F.col("word").isin(*STOP_WORDS))
    return kept.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(50)


@query(
    """WITH e AS (SELECT source, doc_id, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS entity FROM documents), s AS (SELECT source, entity, count(*) AS mentions, count(DISTINCT doc_id) AS uniques FROM e WHERE length(entity) >= 8 GROUP BY ALL)
SELECT source, entity, mentions, uniques, 'SIG:' || entity || ':' || mentions || ':' || uniques AS line FROM s WHERE uniques >= 2"""
)
def q_signal_dump(spark, sf_dir):
    e = table(spark, sf_dir, "documents").select("source", "doc_id", F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("entity")).where(F.length("entity") >= 8)
    s = e.groupBy("source", "entity").agg(F.count("*").alias("mentions"), F.count_distinct("doc_id").alias("uniques")).where("uniques >= 2")
    return s.select("source", "entity", "mentions", "uniques", F.concat_ws(":", F.lit("SIG"), "entity", F.col("mentions").cast("string"), F.col("uniques").cast("string")).alias("line"))


@query(
    """WITH e AS (SELECT 'documents' AS domain, unnest(string_split_regex(lower(text), '[^a-z0-9]+')) AS entity FROM documents UNION ALL SELECT 'conversations', unnest(string_split_regex(lower(text), '[^a-z0-9]+')) FROM conversations
  UNION ALL SELECT 'benchmark', unnest(string_split_regex(lower(text), '[^a-z0-9]+')) FROM benchmark),
m AS (SELECT entity, count(*) FILTER (domain = 'documents') AS documents, count(*) FILTER (domain = 'conversations') AS conversations, count(*) FILTER (domain = 'benchmark') AS benchmark FROM e WHERE length(entity) >= 6 GROUP BY entity)
SELECT *, CAST((documents > 0)::INT + (conversations > 0)::INT + (benchmark > 0)::INT AS BIGINT) AS domains FROM m WHERE (documents > 0)::INT + (conversations > 0)::INT + (benchmark > 0)::INT >= 2"""
)
def q_convergence_matrix(spark, sf_dir):
    parts = [table(spark, sf_dir, t).select(F.lit(t).alias("domain"), F.explode(F.split(F.lower("text"), "[^a-z0-9]+")).alias("entity")) for t in ("documents", "conversations", "benchmark")]
    e = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.length("entity") >= 6)
    m = e.groupBy("entity").pivot("domain", ["documents", "conversations", "benchmark"]).agg(F.count(F.lit(1))).fillna(0)
    return m.withColumn("domains", sum((F.col(c) > 0).cast("long") for c in ("documents", "conversations", "benchmark"))).where("domains >= 2")


@query(
    """WITH a AS (SELECT DISTINCT p_name AS l FROM part), b AS (SELECT l AS r FROM a)
SELECT l, r, CAST(levenshtein(lower(l), lower(r)) AS INT) AS distance FROM a, b WHERE l < r AND levenshtein(lower(l), lower(r)) <= 2"""
)
def q_fuzzy_entities(spark, sf_dir):
    names = table(spark, sf_dir, "part").select("p_name")
    return relational.similar_names(names, names).where("l < r")


@query("SELECT doc_id, replace(substr(regexp_replace(text, '[\\r\\n]+', ' ', 'g'), 1, 80), '|', '/') AS headline, CASE WHEN n_chars >= 2000 THEN 'high' WHEN n_chars >= 600 THEN 'medium' ELSE 'low' END AS tier FROM documents")
def q_headlines(spark, sf_dir):
    tier = F.when(F.col("n_chars") >= 2000, "high").when(F.col("n_chars") >= 600, "medium").otherwise("low")
    return table(spark, sf_dir, "documents").select("doc_id", F.replace(fallback.flattened(F.col("text"), 80), F.lit("|"), F.lit("/")).alias("headline"), tier.alias("tier"))


@query(
    """SELECT d.source, count(*) AS docs, count(l.doc_id) AS labelled, round(avg(CASE WHEN l.toxic = 1 THEN 1.0 ELSE 0.0 END), 6) AS toxic_share, round(CAST(max(n_chars) AS DOUBLE) / greatest(avg(n_chars), 1), 6) AS hype_ratio
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source"""
)
def q_source_profile(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(1))
    joined = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars").join(labels, "doc_id", "left")
    toxic = F.when(F.col("toxic") == 1, 1.0).otherwise(0.0)
    return joined.groupBy("source").agg(F.count("*").alias("docs"), F.count("labelled").alias("labelled"), F.round(F.avg(toxic), 6).alias("toxic_share"), F.round(F.max("n_chars").cast("double") / F.greatest(F.avg("n_chars"), F.lit(1.0)), 6).alias("hype_ratio"))


@query("SELECT doc_id, source, n_chars, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents) WHERE rank <= 3")
def q_top_per_source(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return relational.top_within(docs, ["source"], 3, F.desc("n_chars"), "doc_id")


@query(
    """SELECT source, doc_id, n_chars, CAST(running_size AS BIGINT) AS running_size FROM (SELECT source, doc_id, n_chars, sum(n_chars) OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING) AS running_size FROM documents)
WHERE running_size <= 60000"""
)
def q_prefix_budget(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return relational.prefix_budget(docs, ["source"], F.col("n_chars"), 60_000, [F.desc("n_chars"), "doc_id"])


@query(
    """WITH n AS (SELECT doc_id, text, length(text) - length(replace(text, ' ', '')) AS effort, n_chars AS imp FROM documents), a AS (SELECT doc_id FROM n ORDER BY imp DESC, doc_id LIMIT 40),
b AS (SELECT doc_id FROM n WHERE doc_id NOT IN (FROM a) ORDER BY effort DESC, doc_id LIMIT 30), c AS (SELECT doc_id FROM n WHERE doc_id NOT IN (FROM a) AND doc_id NOT IN (FROM b) ORDER BY imp DESC, doc_id LIMIT 1000)
SELECT doc_id, 'High Importance' AS reason FROM a UNION ALL SELECT doc_id, 'High Effort/Depth' FROM b UNION ALL SELECT doc_id, 'General Coverage' FROM c"""
)
def q_stratified_select(spark, sf_dir):
    effort = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", effort.alias("effort"), F.col("n_chars").alias("imp"))
    strata = [("High Importance", "imp", 40), ("High Effort/Depth", "effort", 30), ("General Coverage", "imp", 1000)]
    return relational.stratified(docs, "doc_id", strata).select("doc_id", "reason")


@query("SELECT lang, source, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY CUBE (lang, source)")
def q_cube_lang_source(spark, sf_dir):
    return table(spark, sf_dir, "documents").cube("lang", "source").agg(F.count("*").alias("docs"), F.sum("n_chars").alias("chars"))


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) // 100 AS batch FROM documents")
def q_id_batches(spark, sf_dir):
    """Batches of a hundred in order: positions come from counts of range partitions, not from one sorted partition."""
    placed = relational.running(table(spark, sf_dir, "documents").select("doc_id"), [], ["doc_id"], F.lit(1), "place")
    return placed.select("doc_id", F.floor((F.col("place") - 1) / 100).alias("batch"))
