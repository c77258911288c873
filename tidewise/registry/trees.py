"""Discussion trees: shape, closures, engagement, importance, authors, pruning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewise.functions import fallback, models
from tidewise.operators import relational, trees
from tidewise.registry.base import CLOSURE, NODES, query, r6, thread_nodes
from tidewise.session import cut_lineage

REC = f"WITH RECURSIVE {NODES}, {CLOSURE}"
DEPTHS = "depths AS (SELECT thread, node, CAST(max(distance) AS BIGINT) AS depth FROM closure GROUP BY ALL)"


def _depths(nodes):
    return trees.depths(nodes)


@query(f"{REC}, {DEPTHS} SELECT n.thread, count(*) AS nodes, max(depth) AS max_depth, count(parent) AS comments FROM nodes n JOIN depths USING (thread, node) GROUP BY n.thread")
def q_thread_shape(spark, sf_dir):
    nodes = thread_nodes(spark, sf_dir)
    return trees.shape(nodes.join(_depths(nodes), ["thread", "node"]))


@query(f"{REC}, {DEPTHS}, s AS (SELECT n.thread, count(*) AS nodes, max(depth) AS max_depth FROM nodes n JOIN depths USING (thread, node) GROUP BY n.thread) SELECT max_depth, count(*) AS threads, round(avg(nodes), 6) AS mean_nodes FROM s GROUP BY max_depth")
def q_depth_histogram(spark, sf_dir):
    return q_thread_shape(spark, sf_dir).groupBy("max_depth").agg(F.count("*").alias("threads"), r6(F.avg("nodes"), "mean_nodes"))


@query(f"{REC}, {DEPTHS} SELECT n.thread, max(depth) AS max_depth, count(*) AS nodes FROM nodes n JOIN depths USING (thread, node) GROUP BY n.thread ORDER BY max_depth DESC, nodes DESC, thread LIMIT 10")
def q_deepest_threads(spark, sf_dir):
    return q_thread_shape(spark, sf_dir).select("thread", "max_depth", "nodes").orderBy(F.desc("max_depth"), F.desc("nodes"), "thread").limit(10)


ENG = f"{REC}, eng AS (SELECT n.thread, n.node, count(c.node) AS descendants FROM nodes n LEFT JOIN closure c ON c.thread = n.thread AND c.ancestor = n.node AND c.distance > 0 GROUP BY ALL)"


@query(f"{ENG} SELECT * FROM eng")
def q_engagement(spark, sf_dir):
    return trees.descendant_counts(thread_nodes(spark, sf_dir))


@query(f"{REC} SELECT thread, node, ancestor, CAST(distance AS INT) AS distance FROM closure WHERE distance > 0")
def q_ancestors(spark, sf_dir):
    return trees.closure(thread_nodes(spark, sf_dir)).where("distance > 0")


@query(f"{REC} SELECT thread, node, string_agg(CAST(ancestor AS VARCHAR), '/' ORDER BY distance DESC) AS path FROM closure GROUP BY ALL")
def q_paths(spark, sf_dir):
    return trees.paths(thread_nodes(spark, sf_dir))


@query(
    f"""{REC}, mine AS (SELECT thread, node FROM nodes WHERE author = 'assistant' AND length(text) > 500)
SELECT c.thread, c.ancestor AS node FROM closure c JOIN mine USING (thread, node) UNION SELECT c.thread, c.node FROM closure c JOIN mine m ON m.thread = c.thread AND m.node = c.ancestor"""
)
def q_user_subtree(spark, sf_dir):
    return trees.subtree_of(thread_nodes(spark, sf_dir), (F.col("author") == "assistant") & (F.length("text") > 500))


@query(
    f"""{REC}, inside AS (SELECT c.thread, c.ancestor AS node, sum((n.author = 'assistant' AND length(n.text) > 500)::INT) AS n_mine, sum((length(n.text) >= 400)::INT) AS n_active FROM closure c JOIN nodes n USING (thread, node) GROUP BY ALL),
  own AS (SELECT n.thread, n.node, n.parent IS NULL OR ((n_mine > 0 OR n_active >= 2) AND length(n.text) >= 60) AS stays FROM nodes n JOIN inside USING (thread, node))
SELECT c.thread, c.node FROM closure c JOIN own o ON o.thread = c.thread AND o.node = c.ancestor GROUP BY ALL HAVING bool_and(o.stays)"""
)
def q_prune(spark, sf_dir):
    mine = (F.col("author") == "assistant") & (F.length("text") > 500)
    return trees.pruned(thread_nodes(spark, sf_dir), mine, F.length("text") >= 400, F.length("text") < 60)


@query(f"WITH {NODES}, k AS (SELECT * FROM nodes WHERE length(text) >= 150) SELECT thread, node, parent FROM k WHERE parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k p WHERE p.thread = k.thread AND p.node = k.parent)")
def q_orphans(spark, sf_dir):
    return trees.orphans(thread_nodes(spark, sf_dir).where("length(text) >= 150")).select("thread", "node", "parent")


@query(f"WITH {NODES} SELECT thread, parent AS src, node AS dst, 't1_' || node AS dst_name FROM nodes WHERE parent IS NOT NULL")
def q_edges(spark, sf_dir):
    return thread_nodes(spark, sf_dir).where("parent is not null").select("thread", F.col("parent").alias("src"), F.col("node").alias("dst"), fallback.prefixed(F.col("node").cast("string"), "t1_").alias("dst_name"))


@query(f"WITH {NODES}, tree AS (SELECT * FROM nodes WHERE node <= 2) SELECT b.thread, b.node, CASE WHEN h.node IS NOT NULL THEN 'replace' WHEN p.node IS NOT NULL THEN 'child' ELSE 'root' END AS placement FROM nodes b LEFT JOIN tree h ON h.thread = b.thread AND h.node = b.node LEFT JOIN tree p ON p.thread = b.thread AND p.node = b.parent WHERE b.node >= 2")
def q_attach_branch(spark, sf_dir):
    nodes = thread_nodes(spark, sf_dir)
    return trees.attach(nodes.where("node >= 2"), nodes.where("node <= 2"))


SCORED = f"""{ENG}, scored AS (SELECT n.thread, n.node, n.author, n.text, length(n.text) % 97 AS score, e.descendants AS eng, (length(n.text) % 13) / 10.0::DOUBLE AS vel, length(n.text) % 3 // 2 AS edits,
  0.5::DOUBLE * (length(n.text) % 97) + 0.3::DOUBLE * e.descendants + 0.1::DOUBLE * ((length(n.text) % 13) / 10.0::DOUBLE) + 0.1::DOUBLE * (length(n.text) % 3 // 2) AS imp FROM nodes n JOIN eng e USING (thread, node))"""


def _scored(spark, sf_dir):
    nodes, n = thread_nodes(spark, sf_dir), F.length("text")
    base = nodes.join(trees.descendant_counts(nodes), ["thread", "node"]).select("thread", "node", "author", "text", (n % 97).alias("score"), F.col("descendants").alias("eng"), ((n % 13) / F.lit(10.0)).alias("vel"), F.floor((n % 3) / 2).alias("edits"))
    return base.withColumn("imp", models.node_importance(F.col("score"), F.col("eng"), F.col("vel"), F.col("edits")))


@query(f"{SCORED} SELECT thread, node, round(imp, 6) AS imp, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY round(imp, 6) DESC, node) AS rank FROM scored) WHERE rank <= 50")
def q_top_comments(spark, sf_dir):
    s = _scored(spark, sf_dir).select("thread", "node", r6(F.col("imp"), "imp"))
    return relational.top_within(s, ["thread"], 50, F.desc("imp"), "node")


#: Words that mark a dispute.
CONFLICT = ("disagree", "actually", "wrong", "propaganda", "bullshit", "false", "correction", "source?", "lie", "biased")


@query(
    f"""{SCORED}, t AS (SELECT (list_sort(list(imp)))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS imp_at, (list_sort(list(vel)))[CAST(floor(count(*) * 0.9) AS BIGINT) + 1] AS vel_at FROM scored)
SELECT thread, node, round(imp, 6) AS imp, eng FROM scored, t WHERE imp >= imp_at OR eng >= 5 OR edits >= 1 OR vel >= vel_at OR {" OR ".join(f"contains(lower(text), '{w}')" for w in CONFLICT)} ORDER BY scored.imp DESC, thread, node LIMIT 100"""
)
def q_interesting(spark, sf_dir):
    """Five ways to be interesting; both thresholds are nearest-rank percentiles of all nodes, joined as one row.

    The percentiles come from counts of distinct values, summed over ranges of values."""
    s = cut_lineage(_scored(spark, sf_dir))  # read by both thresholds and by the filter

    both = s.select(F.inline(F.array(F.struct(F.lit("imp").alias("which"), F.col("imp").alias("x")), F.struct(F.lit("vel").alias("which"), F.col("vel").alias("x")))))
    ranks = relational.nearest_ranks(both, ["which"], "x", {"p95": 0.95, "p90": 0.9})  # a row for each of the two
    limits = ranks.agg(F.max(F.when(F.col("which") == "imp", F.col("p95"))).alias("imp_at"), F.max(F.when(F.col("which") == "vel", F.col("p90"))).alias("vel_at"))
    conflict = F.lit(False)
    for w in CONFLICT:
        conflict |= F.lower("text").contains(w)
    kept = s.join(F.broadcast(limits)).where((F.col("imp") >= F.col("imp_at")) | (F.col("eng") >= 5) | (F.col("edits") >= 1) | (F.col("vel") >= F.col("vel_at")) | conflict)
    return kept.orderBy(F.desc("imp"), "thread", "node").limit(100).select("thread", "node", r6(F.col("imp"), "imp"), "eng")


@query(
    f"""{REC}, {DEPTHS}, kids AS (SELECT thread, parent AS node, count(*) AS replies FROM nodes WHERE parent IS NOT NULL GROUP BY ALL), a AS (SELECT n.thread, n.author, sum(length(text) % 97) AS score, count(*) AS comments, sum(length(text)) AS length, sum(coalesce(replies, 0)) AS replies, max(depth) AS depth
  FROM nodes n JOIN depths USING (thread, node) LEFT JOIN kids USING (thread, node) WHERE author NOT IN ('[deleted]', 'AutoModerator') GROUP BY ALL)
SELECT thread, author, comments, round(score * 1.0::DOUBLE + comments * 0.5::DOUBLE + (length / 100.0::DOUBLE) * 0.3::DOUBLE + replies * 2.0::DOUBLE + depth * 0.2::DOUBLE, 6) AS interest FROM a"""
)
def q_author_interest(spark, sf_dir):
    nodes = thread_nodes(spark, sf_dir)
    kids = nodes.where("parent is not null").groupBy("thread", F.col("parent").alias("node")).agg(F.count("*").alias("replies"))
    j = nodes.where(~F.col("author").isin("[deleted]", "AutoModerator")).join(_depths(nodes), ["thread", "node"]).join(kids, ["thread", "node"], "left")
    a = j.groupBy("thread", "author").agg(F.sum(F.length("text") % 97).alias("score"), F.count("*").alias("comments"), F.sum(F.length("text")).alias("length"), F.sum(F.coalesce("replies", F.lit(0))).alias("replies"), F.max("depth").alias("depth"))
    return a.select("thread", "author", "comments", r6(models.author_interest(F.col("score"), F.col("comments"), F.col("length"), F.col("replies"), F.col("depth")), "interest"))


@query(f"WITH {NODES} SELECT thread, node, count(*) OVER (PARTITION BY thread, parent) - 1 AS siblings, count(*) OVER (PARTITION BY thread, parent) - 1 >= 1 AS dense FROM nodes")
def q_sibling_density(spark, sf_dir):
    siblings = F.count("*").over(Window.partitionBy("thread", "parent")) - 1
    return thread_nodes(spark, sf_dir).select("thread", "node", siblings.alias("siblings"), (siblings >= 1).alias("dense"))


@query(
    f"""{REC}, {DEPTHS}, x AS (SELECT n.thread, n.node, d.depth, length(n.text) % 97 AS score, length(p.text) % 97 AS parent_score FROM nodes n JOIN depths d USING (thread, node) LEFT JOIN nodes p ON p.thread = n.thread AND p.node = n.parent)
SELECT thread, node, depth < 1 OR NOT coalesce(parent_score <= 40 AND score <= 40, false) AS go_on, depth < 1 AS all_siblings FROM x"""
)
def q_depth_decision(spark, sf_dir):
    nodes = thread_nodes(spark, sf_dir)
    parents = nodes.select("thread", F.col("node").alias("parent"), (F.length("text") % 97).alias("parent_score"))
    x = nodes.join(_depths(nodes), ["thread", "node"]).join(parents, ["thread", "parent"], "left")
    said = models.explore_decision(F.col("depth"), F.lit(99.0), F.lit(0), F.lit(0), F.col("parent_score"), F.length("text") % 97, 1, 24.0, 1000, 365, 40)
    return x.select("thread", "node", said.alias("s")).select("thread", "node", "s.go_on", "s.all_siblings")


@query(f"""WITH {NODES}, names AS (SELECT author, 'user_' || row_number() OVER (ORDER BY author) AS alias FROM (SELECT DISTINCT author FROM nodes WHERE author <> '[deleted]')) SELECT thread, node, coalesce(alias, author) AS author FROM nodes LEFT JOIN names USING (author)""")
def q_obfuscate(spark, sf_dir):
    """Authors under new names; a deleted author stays so.  Distinct authors are numbered over ranges of names."""
    nodes = thread_nodes(spark, sf_dir)
    authors = nodes.where("author <> '[deleted]'").select("author").distinct()
    names = relational.running(authors, [], ["author"], F.lit(1), "n").select("author", F.concat(F.lit("user_"), F.col("n").cast("string")).alias("alias"))
    return nodes.join(names, "author", "left").select("thread", "node", F.coalesce("alias", "author").alias("author"))


@query(
    f"""WITH {NODES} SELECT author, count(*) AS kept, round(avg(length(text)), 6) AS effort, CAST(sum((text IN ('[deleted]', '[removed]', ''))::INT) AS BIGINT) AS removed FROM nodes GROUP BY author"""
)
def q_thread_effort(spark, sf_dir):
    gone = fallback.is_removed(F.col("text"), F.lit(""))
    return thread_nodes(spark, sf_dir).groupBy("author").agg(F.count("*").alias("kept"), r6(F.avg(F.length("text")), "effort"), F.sum(gone.cast("long")).alias("removed"))
