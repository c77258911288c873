"""Further operators: node shapes, expiries, author caches, folds, sampling, rubrics, reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewise.functions import fallback, models
from tidewise.operators import relational, sequences, threads, trees
from tidewise.registry.base import CLOSURE, DELTAS, NODES, OBS, deltas, observations, query, r6, table, thread_nodes

REC = f"WITH RECURSIVE {NODES}, {CLOSURE}"


def _nested(spark, sf_dir):
    n = thread_nodes(spark, sf_dir)
    return n.select(F.col("thread").cast("string").alias("thread"), F.col("node").cast("int").alias("position"), F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("parent"), "author", "text", (F.length("text") % 97).cast("long").alias("score"))


@query(f"{REC}, d AS (SELECT thread, node, max(distance) AS depth FROM closure GROUP BY ALL) SELECT CAST(n.thread AS VARCHAR) AS thread, CAST(n.node AS VARCHAR) AS node, CAST(n.parent AS VARCHAR) AS parent, CAST(depth AS INT) AS depth, CAST(length(text) % 97 AS BIGINT) AS score FROM nodes n JOIN d USING (thread, node)")
def q_flatten_threads(spark, sf_dir):
    """Threads nested and flattened again: parents and depths come from the nesting."""
    nested = threads.rebuild(_nested(spark, sf_dir))
    return threads.flatten(nested).select("thread", "node", "parent", "depth", "score")


@query(f"WITH {NODES} SELECT CAST(thread AS VARCHAR) AS thread, count(*) AS nodes, CAST(sum(length(text) % 97) AS BIGINT) AS score, count(*) FILTER (text = '') AS empty FROM nodes GROUP BY thread")
def q_latest_view(spark, sf_dir):
    nodes = threads.as_nodes(_nested(spark, sf_dir).withColumn("depth", F.lit(0)), F.lit("2024-01-01"))
    return threads.latest_view(nodes).groupBy("thread").agg(F.count("*").alias("nodes"), F.sum("score").alias("score"), F.count_if(F.col("text") == "").alias("empty"))


@query(f"WITH {OBS}, v AS (SELECT item, arg_min(score, (sec, seq)) AS a, arg_max(score, (sec, seq)) AS b, (max(sec) - min(sec)) / 60 AS m, count(*) AS n FROM obs GROUP BY item) SELECT CAST(item % 25 AS BIGINT) AS thread, round(sum(abs(b - a)) / max(m), 6) AS velocity FROM v WHERE n >= 2 GROUP BY item % 25")
def q_thread_velocity(spark, sf_dir):
    order = F.struct("sec", "seq")
    v = observations(spark, sf_dir).groupBy("item").agg(F.min_by("score", order).alias("a"), F.max_by("score", order).alias("b"), ((F.max("sec") - F.min("sec")) / 60).alias("m"), F.count("*").alias("n")).where("n >= 2")
    return v.groupBy((F.col("item") % 25).cast("long").alias("thread")).agg(r6(F.sum(F.abs(F.col("b") - F.col("a"))) / F.max("m"), "velocity"))


@query(f"{REC}, d AS (SELECT thread, node, max(distance) AS depth FROM closure GROUP BY ALL) SELECT n.thread, n.node FROM nodes n JOIN d USING (thread, node) JOIN nodes p ON p.thread = n.thread AND p.node = n.parent WHERE depth >= 2 AND length(n.text) < 400 AND length(p.text) < 400")
def q_dead_branches(spark, sf_dir):
    nodes = thread_nodes(spark, sf_dir)
    depth = trees.depths(nodes)
    parents = nodes.select("thread", F.col("node").alias("parent"), F.length("text").alias("ps"))
    return nodes.join(depth, ["thread", "node"]).join(parents, ["thread", "parent"]).where((F.col("depth") >= 2) & (F.length("text") < 400) & (F.col("ps") < 400)).select("thread", "node")


@query("WITH l AS (SELECT quantile_cont(o_totalprice, 0.95) AS p95 FROM orders) SELECT o_orderkey, round(o_totalprice / p95, 6) AS times FROM orders, l WHERE o_totalprice > 1.02 * p95 OR (o_orderpriority = '1-URGENT' AND o_totalprice > 0.99 * p95)")
def q_hall_of_fame(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    limit = relational.percentiles(orders, [], "o_totalprice", {"p95": 0.95})  # one row
    kept = orders.join(F.broadcast(limit)).where((F.col("o_totalprice") > 1.02 * F.col("p95")) | ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 0.99 * F.col("p95"))))
    return kept.select("o_orderkey", r6(F.col("o_totalprice") / F.col("p95"), "times"))


@query("SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-08-01') > 30 AS expired FROM orders WHERE o_orderstatus = 'P'")
def q_pending_expiry(spark, sf_dir):
    age = F.datediff(F.lit("1998-08-01").cast("date"), F.col("o_orderdate").cast("date"))
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", (age > 30).alias("expired"))


@query("SELECT n_name AS name, CAST(least(greatest(30 + 5 * n_nationkey, 20), 300) AS INT) AS every_s, (n_nationkey * 37) % 200 >= least(greatest(30 + 5 * n_nationkey, 20), 300) AS due FROM nation")
def q_poll_due(spark, sf_dir):
    rank = F.col("n_nationkey")
    every = models.clamp(30 + 5 * rank, 20, 300)
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), every.cast("int").alias("every_s"), ((rank * 37) % 200 >= every).alias("due"))


@query(
    """WITH top AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 100) SELECT o_custkey, n FROM top WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 2000 AND c_mktsegment <> 'BUILDING')"""
)
def q_uncached_authors(spark, sf_dir):
    """The busiest hundred without a fresh profile: the cache is TTL-filtered, then anti-joined to the hundred."""
    top = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(100)
    fresh = table(spark, sf_dir, "customer").where("c_acctbal > 2000 and c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return top.join(fresh, "o_custkey", "left_anti")


@query(
    f"""WITH {DELTAS}, h AS (SELECT item, list(day) FILTER (day < 15) AS a, list(day) FILTER (n_score > 0) AS b FROM deltas GROUP BY item)
SELECT item, len(list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x))) AS only_a, len(list_filter(coalesce(b, []), lambda x: NOT list_contains(coalesce(a, []), x))) AS only_b FROM h"""
)
def q_timestamp_audit(spark, sf_dir):
    """Times in one history and not in the other, both ways."""
    h = deltas(spark, sf_dir).groupBy("item").agg(F.collect_list(F.when(F.col("day") < 15, F.col("day"))).alias("a"), F.collect_list(F.when(F.col("n_score") > 0, F.col("day"))).alias("b"))
    return h.select("item", F.size(F.array_except("a", "b")).cast("long").alias("only_a"), F.size(F.array_except("b", "a")).cast("long").alias("only_b"))


@query(
    f"""WITH {OBS}, e AS (SELECT kind, abs(score - avg(score) OVER (PARTITION BY kind ORDER BY sec, seq ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING)) AS err FROM obs) SELECT kind, count(err) AS predictions, round(avg(err), 4) AS mean_error FROM e GROUP BY kind"""
)
def q_mean_prediction_error(spark, sf_dir):
    e = sequences.mean_of_last(observations(spark, sf_dir).select("kind", "sec", "seq", "score"), ["kind"], ["sec", "seq"], "score", 100, "expected")
    e = e.withColumn("err", F.abs(F.col("score") - F.col("expected")))
    return e.groupBy("kind").agg(F.count("err").alias("predictions"), F.round(F.avg("err"), 4).alias("mean_error"))


@query("SELECT CASE WHEN c_acctbal < 0 THEN 'conservative' WHEN c_acctbal < 5000 THEN 'balanced' ELSE 'aggressive' END AS profile, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM customer), 4) AS pct, round(avg(c_acctbal), 4) AS mean FROM customer GROUP BY profile")
def q_profile_mix(spark, sf_dir):
    b = F.col("c_acctbal")
    c = table(spark, sf_dir, "customer").select(F.when(b < 0, "conservative").when(b < 5000, "balanced").otherwise("aggressive").alias("profile"), "c_acctbal")
    total = c.agg(F.count("*").alias("total"))  # one row
    g = c.groupBy("profile").agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))
    return g.join(F.broadcast(total)).select("profile", "n", F.round(F.lit(100.0) * F.col("n") / F.col("total"), 4).alias("pct"), "mean")


@query(
    f"""WITH {OBS}, {DELTAS.replace("days AS", "days AS", 1)}, w AS (SELECT item, delta, row_number() OVER (PARTITION BY item ORDER BY day DESC) AS back FROM deltas)
SELECT (SELECT count(DISTINCT item) FROM obs WHERE sec >= 1706570000) AS recent_items, (SELECT round(1 - avg(CASE WHEN delta > 0 THEN 1.0 ELSE 0.0 END), 6) FROM w WHERE back <= 10) AS recent_waste"""
)
def q_recent_coverage(spark, sf_dir):
    items = observations(spark, sf_dir).where("sec >= 1706570000").agg(F.count_distinct("item").alias("recent_items"))
    last = relational.top_within(deltas(spark, sf_dir).select("item", "day", "delta"), ["item"], 10, F.desc("day"))
    waste = last.agg(r6(1 - F.avg(F.when(F.col("delta") > 0, 1.0).otherwise(0.0)), "recent_waste"))
    return items.join(F.broadcast(waste))  # one row each


@query("SELECT conv_id, count(*) AS got, CAST(max(turn) + 3 AS BIGINT) AS expected, round(100.0 * count(*) / nullif(max(turn) + 3, 0), 2) AS coverage_pct FROM conversations GROUP BY conv_id")
def q_coverage_pct(spark, sf_dir):
    expected = F.max("turn") + 3
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("got"), expected.cast("long").alias("expected"), F.round(F.lit(100.0) * F.count("*") / F.nullif(expected, F.lit(0)), 2).alias("coverage_pct"))


@query(
    f"""WITH RECURSIVE {OBS}, o AS (SELECT item, row_number() OVER (PARTITION BY item ORDER BY sec, seq) AS n, score FROM obs), f AS (SELECT item, n, 0.1::DOUBLE * score AS drift FROM o WHERE n = 1 UNION ALL SELECT o.item, o.n, 0.9::DOUBLE * f.drift + 0.1::DOUBLE * o.score FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1)
SELECT item, round(arg_max(drift, n), 6) AS drift FROM f GROUP BY item"""
)
def q_budget_drift(spark, sf_dir):
    steps = sequences.sorted_steps(observations(spark, sf_dir), ["item"], ["sec", "seq"], "score")
    return steps.select("item", r6(F.aggregate("steps", F.lit(0.0), lambda acc, x: 0.9 * acc + 0.1 * x["score"]), "drift"))


@query(
    f"""WITH RECURSIVE {DELTAS}, o AS (SELECT item, row_number() OVER (PARTITION BY item ORDER BY day) AS n, delta FROM deltas), f AS (SELECT item, n, CASE WHEN delta >= 3 THEN 1 ELSE 0 END AS mode FROM o WHERE n = 1
  UNION ALL SELECT o.item, o.n, CASE WHEN o.delta >= 3 THEN least(f.mode + 1, 2) WHEN o.delta < 0.5 THEN greatest(f.mode - 1, 0) ELSE f.mode END FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1)
SELECT item, CAST(arg_max(mode, n) AS INT) AS mode, CAST(max(mode) AS INT) AS deepest FROM f GROUP BY item"""
)
def q_depth_mode(spark, sf_dir):
    """Shallow, medium, deep: promoted by a rich observation, demoted by a poor one."""
    steps = sequences.sorted_steps(deltas(spark, sf_dir), ["item"], ["day"], "delta")

    def step(acc, x):
        up, down = F.least(acc["mode"] + 1, F.lit(2)), F.greatest(acc["mode"] - 1, F.lit(0))
        mode = F.when(x["delta"] >= 3, up).when(x["delta"] < 0.5, down).otherwise(acc["mode"])
        return F.struct(mode.alias("mode"), F.greatest(acc["deepest"], mode).alias("deepest"))

    return steps.select("item", F.aggregate("steps", F.struct(F.lit(0).alias("mode"), F.lit(0).alias("deepest")), step).alias("s")).select("item", "s.mode", "s.deepest")


@query(f"WITH {OBS}, r AS (SELECT item, seq, row_number() OVER (PARTITION BY item ORDER BY sec DESC, seq DESC) AS back, count(*) OVER (PARTITION BY item) AS n FROM obs) SELECT item, seq FROM r WHERE back <= CASE WHEN n > 60 THEN 30 ELSE n END")
def q_half_trim(spark, sf_dir):
    """Histories over 60 keep their newest half of it."""
    w = Window.partitionBy("item")
    r = observations(spark, sf_dir).withColumn("back", F.row_number().over(w.orderBy(F.desc("sec"), F.desc("seq")))).withColumn("n", F.count("*").over(w))
    return r.where(F.col("back") <= F.when(F.col("n") > 60, 30).otherwise(F.col("n"))).select("item", "seq")


@query(f"WITH {DELTAS}, s AS (SELECT item, count(*) AS scrapes, max(day) AS last FROM deltas GROUP BY item) SELECT item, scrapes FROM s ORDER BY scrapes, last, item LIMIT CAST(greatest(5, 40 * greatest(0.5, 0.8) * 0.5) AS BIGINT)")
def q_launch_cap(spark, sf_dir):
    """Few-scraped first, as many as the gain (0.8) and the target (40) allow."""
    s = deltas(spark, sf_dir).groupBy("item").agg(F.count("*").alias("scrapes"), F.max("day").alias("last"))
    return s.orderBy("scrapes", "last", "item").limit(int(max(5, 40 * max(0.5, 0.8) * 0.5))).select("item", "scrapes")


@query("SELECT o_orderkey, o_orderkey * 7919 % 1000 AS bucket FROM orders WHERE o_orderkey * 7919 % 1000 < 250")
def q_hash_sample(spark, sf_dir):
    """A repeatable quarter: the draw is a function of the key."""
    bucket = F.col("o_orderkey") * 7919 % 1000
    return table(spark, sf_dir, "orders").select("o_orderkey", bucket.alias("bucket")).where("bucket < 250")


@query(
    """SELECT item_id, CAST(CASE WHEN length(text) > 250 THEN 3 ELSE 0 END + CASE WHEN contains(text, ',') THEN 2 ELSE 0 END + CASE WHEN contains(text, chr(10)) THEN 3 ELSE 0 END + CASE WHEN length(text) % 2 = 0 THEN 2 ELSE 0 END AS INT) AS score,
  CASE WHEN length(text) % 10 >= 9 THEN 'high' WHEN length(text) % 10 >= 6 THEN 'medium' ELSE 'low' END AS confidence FROM benchmark"""
)
def q_headline_score(spark, sf_dir):
    n, t = F.length("text"), F.col("text")
    score = F.when(n > 250, 3).otherwise(0) + F.when(t.contains(","), 2).otherwise(0) + F.when(t.contains("\n"), 3).otherwise(0) + F.when(n % 2 == 0, 2).otherwise(0)
    return table(spark, sf_dir, "benchmark").select("item_id", score.cast("int").alias("score"), F.when(n % 10 >= 9, "high").when(n % 10 >= 6, "medium").otherwise("low").alias("confidence"))


@query("SELECT p_partkey, split_part(line, ':', 2) AS entity, CAST(split_part(line, ':', 3) AS BIGINT) AS mentions FROM (SELECT p_partkey, 'SIG:' || p_brand || ':' || p_size AS line FROM part)")
def q_signals_parse(spark, sf_dir):
    line = F.split(F.concat_ws(":", F.lit("SIG"), "p_brand", F.col("p_size").cast("string")), ":")
    return table(spark, sf_dir, "part").select("p_partkey", line[1].alias("entity"), line[2].cast("long").alias("mentions"))


@query("WITH p AS (SELECT p_partkey, '24' || lpad(CAST(p_partkey % 50 AS VARCHAR), 2, '0') || '.' || p_size || 'v' || (p_partkey % 12 + 1) AS id FROM part) SELECT base, max(version) AS newest, count(*) AS versions FROM (SELECT regexp_replace(id, 'v[0-9]+$', '') AS base, CAST(regexp_extract(id, 'v([0-9]+)$', 1) AS INT) AS version FROM p) GROUP BY base")
def q_newest_versions(spark, sf_dir):
    key = F.concat(F.lit("24"), F.lpad((F.col("p_partkey") % 50).cast("string"), 2, "0"), F.lit("."), F.col("p_size").cast("string"), F.lit("v"), (F.col("p_partkey") % 12 + 1).cast("string"))
    p = table(spark, sf_dir, "part").select(key.alias("id"))
    return p.groupBy(fallback.base_identifier(F.col("id")).alias("base")).agg(F.max(fallback.version_of(F.col("id"))).alias("newest"), F.count("*").alias("versions"))


@query("SELECT page_id, len(regexp_extract_all(html, '<p>', 0)) AS paragraphs, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS heading, regexp_extract(html, 'lang=\"([a-z]+)\"', 1) AS lang FROM pages")
def q_page_sections(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))).cast("long").alias("paragraphs"), F.regexp_extract("html", "<h1>([^<]*)</h1>", 1).alias("heading"), F.regexp_extract("html", 'lang="([a-z]+)"', 1).alias("lang"))


@query(f"WITH {OBS} SELECT kind, seq FROM (SELECT kind, seq, row_number() OVER (PARTITION BY kind ORDER BY sec DESC, seq DESC) AS back FROM obs) WHERE back <= 100")
def q_ring_buffer(spark, sf_dir):
    return relational.top_within(observations(spark, sf_dir), ["kind"], 100, F.desc("sec"), F.desc("seq")).select("kind", "seq")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 60 DAY ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000")
def q_lookback_cap(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    edge = orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 60 DAYS")).alias("edge"))  # one row
    return orders.join(F.broadcast(edge)).where("o_orderdate >= edge").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1000).select("o_orderkey")


@query(
    """SELECT s_nationkey, count(*) AS posts, round(avg(s_acctbal), 4) AS mean, count(*) FILTER (s_acctbal > 5000) AS big, round(sum(s_acctbal), 2) AS total FROM supplier GROUP BY s_nationkey ORDER BY posts DESC, s_nationkey LIMIT 10"""
)
def q_backfill_stats(spark, sf_dir):
    g = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("posts"), F.round(F.avg("s_acctbal"), 4).alias("mean"), F.count_if(F.col("s_acctbal") > 5000).alias("big"), F.round(F.sum("s_acctbal"), 2).alias("total"))
    return g.orderBy(F.desc("posts"), "s_nationkey").limit(10)
