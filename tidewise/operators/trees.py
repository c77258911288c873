"""Tree operators over adjacency lists (thread, node, parent): closures, subtrees, pruning, shape (survey G1-G16, A5, F9, F18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewise.session import cut_lineage


def _most_nodes(nodes: DataFrame) -> int:
    """Nodes of the largest thread: no line of ancestors without a cycle is longer."""
    return nodes.groupBy("thread").count().agg(F.max("count")).first()[0] or 0


def closure(nodes: DataFrame) -> DataFrame:
    """thread, node, ancestor, distance (0: itself) for every node and each of its ancestors, however deep.

    By doubling: links of up to 2**k steps join with themselves, so depth d takes log2(d) joins, all on (thread, node), whose
    results are checkpointed to keep each plan small; parents outside the thread end a path.  A line that comes back to its node is cut there."""
    links = nodes.select("thread", "node", F.col("parent").alias("ancestor")).where("parent is not null and parent <> node")
    known = nodes.select("thread", F.col("node").alias("ancestor"))
    reach = cut_lineage(links.join(known, ["thread", "ancestor"], "left_semi").select("thread", "node", "ancestor", F.lit(1).alias("distance")))
    span, most = 1, None
    while True:
        upper = reach.select("thread", F.col("node").alias("ancestor"), F.col("ancestor").alias("_top"), F.col("distance").alias("_more"))
        longer = reach.where(F.col("distance") == span).join(upper, ["thread", "ancestor"]).where("_top <> node")
        longer = cut_lineage(longer.select("thread", "node", F.col("_top").alias("ancestor"), (F.col("distance") + F.col("_more")).alias("distance")))
        if longer.isEmpty():
            break
        reach = reach.unionByName(longer)
        span *= 2
        most = _most_nodes(nodes) if most is None else most
        if span > most:  # only lines that run into a cycle are as long
            break
    own = nodes.select("thread", "node", F.col("node").alias("ancestor"), F.lit(0).alias("distance"))
    return own.unionByName(reach.groupBy("thread", "node", "ancestor").agg(F.min("distance").alias("distance")))


def rooted(nodes: DataFrame) -> DataFrame:
    """thread, node, depth, descendants: one row a node throughout, in log2(depth) rounds.

    Each node points 2**k steps up; it hands what it has counted below itself to the node it points at, and its pointer is doubled.  Nodes whose
    line of ancestors runs into a cycle have no depth (null), and what is counted for them is bounded by the rounds."""
    known = nodes.select("thread", F.col("node").alias("up"), F.lit(True).alias("_there"))
    state = nodes.select("thread", "node", F.col("parent").alias("up")).join(known, ["thread", "up"], "left")
    up = F.when(F.col("_there"), F.col("up"))
    state = cut_lineage(state.select("thread", "node", up.alias("up"), up.isNotNull().cast("long").alias("depth"), F.lit(1).cast("long").alias("below")))
    rounds, most = 0, None
    while True:
        moving = state.where("up is not null")
        if moving.isEmpty():
            break
        most = _most_nodes(nodes) if most is None else most
        if 1 << rounds > most:
            state = state.withColumn("depth", F.when(F.col("up").isNull(), F.col("depth")))
            break
        handed = moving.groupBy("thread", F.col("up").alias("node")).agg(F.sum("below").alias("_more"))
        above = state.select("thread", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"))
        state = state.join(handed, ["thread", "node"], "left").join(above, ["thread", "up"], "left")
        state = cut_lineage(state.select("thread", "node", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), (F.col("below") + F.coalesce("_more", F.lit(0))).alias("below")))
        rounds += 1
    return state.select("thread", "node", "depth", (F.col("below") - 1).alias("descendants"))


def depths(nodes: DataFrame) -> DataFrame:
    return rooted(nodes).select("thread", "node", "depth")


def descendant_counts(nodes: DataFrame) -> DataFrame:
    return rooted(nodes).select("thread", "node", "descendants")


def orphans(nodes: DataFrame) -> DataFrame:
    """Nodes whose parent is named but not there."""
    known = nodes.select("thread", F.col("node").alias("parent"))
    return nodes.where("parent is not null").join(known, ["thread", "parent"], "left_anti")


def subtree_of(nodes: DataFrame, chosen: Column) -> DataFrame:
    """thread, node of the chosen nodes with all their ancestors and descendants."""
    reach = closure(nodes)
    picked = nodes.where(chosen).select("thread", "node")
    up = reach.join(picked, ["thread", "node"], "left_semi").select("thread", F.col("ancestor").alias("node"))
    down = reach.join(picked.withColumnRenamed("node", "ancestor"), ["thread", "ancestor"], "left_semi").select("thread", "node")
    return up.unionByName(down).distinct()


def pruned(nodes: DataFrame, mine: Column, active: Column, dead: Column) -> DataFrame:
    """thread, node kept: a branch stays if the user is active in it or two nodes are, it is not dead, and all above it stay; roots stay."""
    reach = closure(nodes)
    marks = nodes.select("thread", "node", mine.cast("int").alias("mine"), active.cast("int").alias("active"))
    inside = reach.join(marks, ["thread", "node"]).groupBy("thread", F.col("ancestor").alias("node")).agg(F.sum("mine").alias("n_mine"), F.sum("active").alias("n_active"))
    own = nodes.join(inside, ["thread", "node"]).select("thread", "node", (F.col("parent").isNull() | (((F.col("n_mine") > 0) | (F.col("n_active") >= 2)) & ~dead)).alias("stays"))
    above = reach.join(own.withColumnRenamed("node", "ancestor"), ["thread", "ancestor"]).groupBy("thread", "node").agg(F.bool_and("stays").alias("stays"))
    return above.where("stays").select("thread", "node")


def paths(nodes: DataFrame) -> DataFrame:
    """thread, node, path: ids from the root down, as text."""
    listed = closure(nodes).groupBy("thread", "node").agg(F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("d"), F.col("ancestor").cast("string").alias("a")))).alias("p"))
    return listed.select("thread", "node", F.array_join(F.transform("p", lambda x: x["a"]), "/").alias("path"))


def shape(nodes: DataFrame, depth: str = "depth") -> DataFrame:
    return nodes.groupBy("thread").agg(F.count("*").alias("nodes"), F.max(depth).cast("long").alias("max_depth"), F.count_if(F.col("parent").isNotNull()).alias("comments"))


def attach(branch: DataFrame, tree: DataFrame) -> DataFrame:
    """Where each branch node goes in the tree: 'replace' at its own id, 'child' under its parent, else 'root'."""
    here = tree.select("thread", "node").withColumn("_here", F.lit(1))
    under = tree.select("thread", F.col("node").alias("parent")).withColumn("_under", F.lit(1))
    joined = branch.join(here, ["thread", "node"], "left").join(under, ["thread", "parent"], "left")
    return joined.select("thread", "node", F.when(F.col("_here") == 1, "replace").when(F.col("_under") == 1, "child").otherwise("root").alias("placement"))


def single_tree(branch: DataFrame) -> DataFrame:
    """Each thread's nodes as one tree (survey G9): thread, node, parent, is_root.

    The root is the node without a parent in the branch that has most descendants, then the smallest id; other nodes without a parent hang under it.
    A thread that is all cycle gets its smallest node as root, and a node that is its own parent is without one."""
    known = branch.select("thread", F.col("node").alias("parent"), F.lit(True).alias("_there"))
    open_ends = branch.join(known, ["thread", "parent"], "left").select("thread", "node", F.when(F.col("_there") & (F.col("parent") != F.col("node")), F.col("parent")).alias("parent"))
    ranked = open_ends.join(descendant_counts(open_ends), ["thread", "node"])
    root = ranked.groupBy("thread").agg(F.min(F.struct(F.col("parent").isNotNull().alias("inner"), F.when(F.col("parent").isNull(), -F.col("descendants")).alias("size"), F.col("node").alias("root"))).alias("r")).select("thread", "r.root")
    joined = open_ends.join(root, "thread")
    parent = F.when(F.col("node") != F.col("root"), F.coalesce("parent", "root"))
    return joined.select("thread", "node", parent.alias("parent"), (F.col("node") == F.col("root")).alias("is_root"))
