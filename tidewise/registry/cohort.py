"""Decisions with looked-up context: author profiles, names, backoff, value per request, dead comments, lookups, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewise.functions import models
from tidewise.operators import relational, sequences, threads, trees
from tidewise.registry.base import CLOSURE, DELTAS, NODES, OBS, deltas, observations, query, r6, table, thread_nodes
from tidewise.sources import sinks

REC = f"WITH RECURSIVE {NODES}, {CLOSURE}"
DEPTHS = "depths AS (SELECT thread, node, CAST(max(distance) AS BIGINT) AS depth FROM closure GROUP BY ALL)"


@query(
    f"""{REC}, {DEPTHS}, x AS (SELECT n.thread, n.node, d.depth, n.node * 6.0 AS age, length(n.text) % 97 AS score, length(p.text) % 97 AS parent_score, c_acctbal AS karma, c_nationkey * 40 AS days
  FROM nodes n JOIN depths d USING (thread, node) LEFT JOIN nodes p ON p.thread = n.thread AND p.node = n.parent LEFT JOIN customer c ON c_custkey = (n.thread * 3 + n.node) % 200 AND c_mktsegment <> 'BUILDING')
SELECT thread, node, CASE WHEN depth < 1 OR age < 24 OR coalesce(karma > 4000, false) OR coalesce(days > 800, false) THEN true WHEN parent_score <= 40 AND score <= 40 THEN false ELSE true END AS go_on, depth < 1 OR age < 24 AS all_siblings FROM x"""
)
def q_author_depth_decision(spark, sf_dir):
    """How far to read below a comment: by depth, age, its author's profile (if there is a fresh one) and both scores."""
    nodes = thread_nodes(spark, sf_dir)
    parents = nodes.select("thread", F.col("node").alias("parent"), (F.length("text") % 97).alias("parent_score"))
    fresh = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("karma"), (F.col("c_nationkey") * 40).alias("days"))
    x = nodes.join(trees.depths(nodes), ["thread", "node"]).join(parents, ["thread", "parent"], "left").withColumn("key", (F.col("thread") * 3 + F.col("node")) % 200).join(fresh, "key", "left")
    said = models.explore_decision(F.col("depth"), F.col("node") * 6.0, F.col("karma"), F.col("days"), F.col("parent_score"), F.length("text") % 97, 1, 24.0, 4000, 800, 40)
    return x.select("thread", "node", said.alias("s")).select("thread", "node", "s.go_on", "s.all_siblings")


@query(
    """WITH u AS (SELECT s_name AS user, row_number() OVER (ORDER BY s_name) AS i FROM (SELECT DISTINCT s_name FROM supplier)), n AS (SELECT c_name AS name, row_number() OVER (ORDER BY md5(c_name || '/7'), c_name) AS i FROM (SELECT DISTINCT c_name FROM customer))
SELECT "user", name FROM u JOIN n USING (i)"""
)
def q_shuffled_names(spark, sf_dir):
    return relational.shuffled_mapping(table(spark, sf_dir, "supplier").select("s_name"), table(spark, sf_dir, "customer").select("c_name"), 7)


@query(
    f"""WITH RECURSIVE {OBS}, o AS (SELECT item, kind = 'error' AS refused, row_number() OVER (PARTITION BY item ORDER BY sec, seq) AS n FROM obs),
f AS (SELECT item, n, CASE WHEN refused THEN 4.0::DOUBLE ELSE 2.0::DOUBLE END AS wait FROM o WHERE n = 1 UNION ALL SELECT o.item, o.n, CASE WHEN o.refused THEN least(f.wait * 2, 256.0::DOUBLE) ELSE greatest(f.wait / 2, 2.0::DOUBLE) END FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1)
SELECT item, arg_max(wait, n) AS wait, max(wait) AS longest FROM f GROUP BY item"""
)
def q_global_backoff(spark, sf_dir):
    steps = sequences.sorted_steps(observations(spark, sf_dir).withColumn("refused", F.col("kind") == "error"), ["item"], ["sec", "seq"], "refused")
    return steps.select("item", sequences.fold_backoff(F.col("steps")).alias("f")).select("item", "f.wait", "f.longest")


@query(
    f"""WITH RECURSIVE {DELTAS}, o AS (SELECT item, delta / (1 + day % 3)::DOUBLE AS vpr, row_number() OVER (PARTITION BY item ORDER BY day) AS n FROM deltas),
f AS (SELECT item, n, vpr AS ema FROM o WHERE n = 1 UNION ALL SELECT o.item, o.n, 0.8::DOUBLE * f.ema + 0.2::DOUBLE * o.vpr FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1) SELECT item, round(arg_max(ema, n), 6) AS ema FROM f GROUP BY item"""
)
def q_value_per_request(spark, sf_dir):
    """Information gained a request (a day costs one to three), as a moving average."""
    vpr = deltas(spark, sf_dir).withColumn("vpr", F.col("delta") / (1 + F.col("day") % 3))
    steps = sequences.sorted_steps(vpr, ["item"], ["day"], "vpr")
    ema = F.aggregate("steps", F.lit(None).cast("double"), lambda last, x: F.coalesce(0.8 * last + 0.2 * x["vpr"], x["vpr"]))
    return steps.select("item", r6(ema, "ema"))


@query("SELECT c.conv_id, c.turn FROM conversations c JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1 WHERE c.turn >= 4 AND length(c.text) % 3 = 1 AND length(p.text) % 3 = 1")
def q_dead_comments(spark, sf_dir):
    """Deep comments with a score of one under a parent with a score of one (each turn answers the last: its depth is its number)."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.length("text") % 3).alias("score"))
    parents = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("score").alias("parent_score"))
    return turns.join(parents, ["conv_id", "turn"]).where("turn >= 4 and score = 1 and parent_score = 1").select("conv_id", "turn")


@query(
    """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice * 50 ELSE o_totalprice / 400 END AS score, (o_orderkey % 10) / 10.0::DOUBLE AS ratio FROM orders), l AS (SELECT quantile_cont(score, 0.95) AS p95 FROM s)
SELECT o_orderkey, round(score / p95, 6) AS times FROM s, l WHERE score > 5 * p95 OR (ratio > 0.8 AND score > 500)"""
)
def q_outstanding_posts(spark, sf_dir):
    """Over five times the 95th percentile, or well liked and over 500."""
    k = F.col("o_orderkey")
    s = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 97 == 0, F.col("o_totalprice") * 50).otherwise(F.col("o_totalprice") / 400).alias("score"), ((k % 10) / F.lit(10.0)).alias("ratio"))
    limit = relational.percentiles(s, [], "score", {"p95": 0.95})  # one row
    kept = s.join(F.broadcast(limit)).where((F.col("score") > 5 * F.col("p95")) | ((F.col("ratio") > 0.8) & (F.col("score") > 500)))
    return kept.select("o_orderkey", r6(F.col("score") / F.col("p95"), "times"))


@query("SELECT n_name, coalesce(CASE lower(n_name) WHEN 'france' THEN 3 WHEN 'china' THEN 5 WHEN 'peru' THEN 1 END, 2) AS weight FROM nation")
def q_config_lookup(spark, sf_dir):
    """Settings by name, whatever its case, with a default; the settings are a fixed literal."""
    config = spark.createDataFrame([("France", 3), ("CHINA", 5), ("peru", 1)], "name string, weight int").select(F.lower("name").alias("key"), "weight")
    return table(spark, sf_dir, "nation").withColumn("key", F.lower("n_name")).join(F.broadcast(config), "key", "left").select("n_name", F.coalesce("weight", F.lit(2)).alias("weight"))


@query(f"WITH {OBS}, h AS (SELECT item, count(*) AS n, arg_max(kind, (sec, seq)) AS last FROM obs GROUP BY item) SELECT conv_id, turn, coalesce(n, 0) AS history, coalesce(last, 'none') AS last FROM conversations LEFT JOIN h ON item = conv_id * 10 + turn")
def q_history_attach(spark, sf_dir):
    """The nodes of the latest tree with what earlier snapshots have of them."""
    past = observations(spark, sf_dir).groupBy("item").agg(F.count("*").alias("n"), F.max_by("kind", F.struct("sec", "seq")).alias("last"))
    nodes = table(spark, sf_dir, "conversations").select("conv_id", "turn", (F.col("conv_id") * 10 + F.col("turn")).alias("item"))
    return nodes.join(past, "item", "left").select("conv_id", "turn", F.coalesce("n", F.lit(0)).alias("history"), F.coalesce("last", F.lit("none")).alias("last"))


@query("SELECT p_partkey, coalesce(f, '-') AS first_category, f IS NOT NULL AS there FROM part LEFT JOIN (SELECT l_partkey, min(l_returnflag) AS f FROM lineitem WHERE l_quantity > 48 GROUP BY l_partkey) ON l_partkey = p_partkey")
def q_cross_category(spark, sf_dir):
    """Whether an entry was fetched under any category, and the first of them."""
    got = table(spark, sf_dir, "lineitem").where("l_quantity > 48").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_returnflag").alias("f"))
    return table(spark, sf_dir, "part").select("p_partkey").join(got, "p_partkey", "left").select("p_partkey", F.coalesce("f", F.lit("-")).alias("first_category"), F.col("f").isNotNull().alias("there"))


@query("SELECT s_name FROM supplier LEFT JOIN (SELECT user_id, max(ts) AS last FROM events WHERE user_id % 3 > 0 GROUP BY user_id) ON user_id = s_suppkey ORDER BY last ASC NULLS FIRST, s_name LIMIT 12")
def q_recency_order(spark, sf_dir):
    """Never seen first, then the longest unseen; ties by name."""
    last = table(spark, sf_dir, "events").where("user_id % 3 > 0").groupBy(F.col("user_id").alias("s_suppkey")).agg(F.max("ts").alias("last"))
    return table(spark, sf_dir, "supplier").join(last, "s_suppkey", "left").orderBy(F.asc_nulls_first("last"), "s_name").limit(12).select("s_name")


@query("SELECT s_name FROM supplier ORDER BY s_name LIMIT 50")
def q_first_by_name(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_name").orderBy("s_name").limit(50)


@query("SELECT 'all' AS mode, n_name FROM nation UNION ALL SELECT 'new only', n_name FROM nation WHERE n_nationkey % 4 <> 0")
def q_unverified_sources(spark, sf_dir):
    """What either mode works on: all sources, or those not verified yet."""
    sources = table(spark, sf_dir, "nation").select("n_name", (F.col("n_nationkey") % 4 == 0).alias("verified"))
    return sources.select(F.lit("all").alias("mode"), "n_name").unionByName(sources.where("not verified").select(F.lit("new only").alias("mode"), "n_name"))


BRANCH = NODES.replace("FROM conversations", "FROM conversations WHERE turn <> 1")


@query(
    f"""WITH RECURSIVE {BRANCH}, {CLOSURE}, e AS (SELECT n.thread, n.node, n.parent, EXISTS (SELECT 1 FROM nodes p WHERE p.thread = n.thread AND p.node = n.parent) AS inner_, (SELECT count(*) FROM closure c WHERE c.thread = n.thread AND c.ancestor = n.node AND c.distance > 0) AS below FROM nodes n),
r AS (SELECT thread, node AS root FROM (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY inner_, below DESC, node) AS k FROM e) WHERE k = 1)
SELECT e.thread, e.node, CASE WHEN e.node = root THEN -1 WHEN inner_ THEN parent ELSE root END AS parent, e.node = root AS is_root FROM e JOIN r USING (thread)"""
)
def q_single_tree(spark, sf_dir):
    """Threads that lost a node, as one tree each."""
    return trees.single_tree(thread_nodes(spark, sf_dir).where("node <> 1")).select("thread", "node", F.coalesce("parent", F.lit(-1)).alias("parent"), "is_root")


@query("SELECT s_suppkey AS thread, s_nationkey % 8 AS node, coalesce(role, '-') AS author, length(text) AS size FROM supplier LEFT JOIN conversations ON conv_id = s_suppkey AND turn = s_nationkey % 8".replace("length(text)", "coalesce(length(coalesce(text, CASE WHEN role IS NOT NULL THEN '' END)), -1)"))
def q_comment_lookup(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("thread"), (F.col("s_nationkey") % 8).alias("node"))
    return threads.found(thread_nodes(spark, sf_dir), wanted).select("thread", "node", F.coalesce("author", F.lit("-")).alias("author"), F.coalesce(F.length("text"), F.lit(-1)).cast("long").alias("size"))


@query(
    """SELECT '# Events' || chr(10) || '# Format: JSON lines, newest first' || chr(10) || '# Total items: ' || format('{:,}', count(*)) || chr(10) || '# Date range: ' || strftime(min(ts), '%Y-%m-%d') || ' to ' || strftime(max(ts), '%Y-%m-%d') || chr(10) || '# items: ' || count(DISTINCT user_id) || chr(10) || '# errors: ' || count(*) FILTER (event_type = 'error') AS value FROM events"""
)
def q_dataset_header(spark, sf_dir):
    return sinks.header(table(spark, sf_dir, "events"), "ts", "Events", {"items": F.count_distinct("user_id"), "errors": F.count_if(F.col("event_type") == "error")})


@query(
    """WITH g AS (SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events)::DOUBLE AS share FROM events GROUP BY event_type)
SELECT rpad(event_type, 14, ' ') || lpad(format('{:,}', n), 10, ' ') || lpad(printf('%.1f%%', 100 * share), 7, ' ') || ' ' || repeat('█', CAST(floor(share * 20) AS INT)) || repeat('░', 20 - CAST(floor(share * 20) AS INT)) AS value FROM g"""
)
def q_report_lines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    total = events.agg(F.count("*").alias("total"))  # one row
    g = events.groupBy("event_type").agg(F.count("*").alias("n")).join(F.broadcast(total))
    return sinks.table_lines(g, "event_type", "n", F.col("n") / F.col("total"))
