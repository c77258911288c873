"""Approximate nearest neighbours by a hash-prefix forest.

Each different vector gets `trees` hash strings of BITS random-hyperplane bits.  A tree is the array of all vectors' strings, sorted over the whole
table, so vectors that share a prefix are neighbours in it.  The arrays are dealt in ranges of (tree, string), equal strings by a hash of
the id, so that no prefix, however common, meets in one task.  A query stands in each tree where its own string stands: there it has descended
to its longest matching prefix, and the window of `window` entries around it holds the next shorter ones.  Then all trees are ascended together, one
level at a time, each level taking in the vectors that share a prefix one bit shorter, until the candidates of all trees number `wanted`.  Of these the
`scored` ones go on that differ least from the query in a sketch of SKETCH further bits.

They are looked up by vector, not by query: vectors are dealt to blocks, a query visits the blocks that hold candidates of its own with the
list of them, and is answered with their exact cosines in double precision, of which the best of all blocks are kept.  All three budgets are fixed
numbers a query, so the work grows as the queries do; the price is that recall falls with the size of the table where vectors are not clustered
at all, and the budgets have to be raised (README has figures).

Vectors that are null, empty, zero, or hold null or non-finite components take no part, as queries or as candidates; nor do
those of another length than most.  Vectors are scaled by a power of two before they are multiplied, so neither very large nor very small ones are lost.
Equal vectors are one entry of the forest, whose smallest ids are given out.  Equal scores go to the smaller vec_id.  Rows repeated under one vec_id
count once (if they differ, as the smallest vector); a query is never its own candidate.  Null vec_ids take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, cut

TREES = 160
BITS = 32
SKETCH = 256
WINDOW, WANTED, SCORED = 128, 16_384, 1_024
ENTRIES = 1_000_000
BLOCK_ROWS = 8_192
SEED = 11


def usable(table: DataFrame) -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.size(v) > 0
    fine &= ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(v).alias("v"))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to between a half and one."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def strings(vectors: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, trees) hash strings as integers, first bit highest, and (rows, words) sketches."""
    plane = np.random.default_rng(SEED).standard_normal((vectors.shape[1], SKETCH + trees * BITS)).astype(np.float32)
    weights = 2.0 ** np.arange(BITS - 1, -1, -1)
    out, sketch = np.empty((len(vectors), trees), np.int64), np.empty((len(vectors), SKETCH // 64), np.uint64)
    for at in range(0, len(vectors), 512):
        bits = (scaled(vectors[at : at + 512]).astype(np.float32) @ plane) > 0
        sketch[at : at + 512] = np.packbits(bits[:, :SKETCH], axis=1).view(np.uint64)
        out[at : at + 512] = bits[:, SKETCH:].reshape(len(bits), trees, BITS) @ weights
    return out, sketch


def _entries(rows: DataFrame, dim: int, trees: int, role: int) -> DataFrame:
    """tree, string, tie, role, id, sketch: a row's places in all trees."""
    schema = pa.schema([("id", pa.int64()), ("sketch", pa.binary()), ("strings", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                found, sketch = strings(part.column(1).flatten().to_numpy().reshape(-1, dim), trees)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, trees, dtype=np.int32)), pa.array(found.reshape(-1)))
                yield batch_of(schema, id=part.column(0), sketch=[x.tobytes() for x in sketch], strings=lists)

    spread = rows.mapInArrow(run, "id long, sketch binary, strings array<long>").select("id", "sketch", F.posexplode("strings").alias("tree", "string"))
    return spread.select("tree", "string", F.xxhash64("id", "tree").alias("tie"), F.lit(role).alias("role"), "id", "sketch")


def _windows(width: int):
    """For each query of a range its neighbours in the tree, the lengths of the prefixes they share with it and the distances of their sketches."""
    schema = pa.schema([("query", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("far", pa.list_(pa.int32()))])

    def near(role, string, ids, sketch):
        """Rows of one tree in order."""
        index, asked = np.flatnonzero(role == 0), np.flatnonzero(role == 1)
        if not len(index) or not len(asked):
            return
        keys, names, sketches = string[index], ids[index], sketch[index]
        k = min(width, len(index))
        for at in range(0, len(asked), 256):
            part = asked[at : at + 256]
            place = np.searchsorted(index, part)  # so many entries stand before the query
            cells = np.clip(place - k // 2, 0, len(index) - k)[:, None] + np.arange(k)
            lengths = BITS - np.frexp((keys[cells] ^ string[part][:, None]).astype(np.float64))[1]
            far = np.bitwise_count(sketches[cells] ^ sketch[part][:, None]).sum(axis=2, dtype=np.int32)
            offsets = pa.array(np.arange(0, cells.size + 1, k, dtype=np.int32))
            lists = {n: pa.ListArray.from_arrays(offsets, pa.array(x.reshape(-1).astype(t))) for n, x, t in (("ids", names[cells], np.int64), ("lengths", lengths, np.int32), ("far", far, np.int32))}
            yield batch_of(schema, query=ids[part], **lists)

    def run(batches):
        tree, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            t, string, role, ids = (batch.column(i).to_numpy() for i in (0, 1, 3, 4))
            sketch = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint64).reshape(-1, SKETCH // 64)
            edges = np.concatenate([[0], np.flatnonzero(t[1:] != t[:-1]) + 1, [len(t)]])
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if t[s] != tree and held:
                    yield from near(*(np.concatenate(x) for x in zip(*held, strict=True)))
                    held = []
                tree = t[s]
                held.append((role[s:e], string[s:e], ids[s:e], sketch[s:e]))
        if held:
            yield from near(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def _ascend(wanted: int, scored: int):
    """From the windows of all trees, sorted by query: the candidates (query, node) of the synchronous ascent that come nearest by sketch."""
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64())])

    def found(query, held):
        ids, lengths, far = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.lexsort((-lengths, ids))
        ids, lengths, far = ids[order], lengths[order], far[order]
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        ids, lengths, far = ids[first], lengths[first], far[first]  # of each candidate the longest prefix in any tree
        upto = np.cumsum(np.bincount(lengths, minlength=BITS + 1)[::-1])  # candidates at a level, from the longest prefix down
        level = BITS - int(np.argmax(upto >= min(wanted, len(ids))))
        ids, far = ids[lengths >= level], far[lengths >= level]
        ids = ids[np.lexsort((ids, far))[:scored]]
        return batch_of(schema, query=np.full(len(ids), query), node=ids)

    def run(batches):
        query, held = None, []
        for batch in batches:
            for i, x in enumerate(batch.column(0).to_pylist()):
                if x != query and held:
                    yield found(query, held)
                    held = []
                query = x
                held.append(tuple(batch.column(c)[i].values.to_numpy() for c in (1, 2, 3)))
        if held:
            yield found(query, held)

    return run


def candidates(nodes: DataFrame, asked: DataFrame, dim: int, trees: int = TREES, window: int = WINDOW, wanted: int = WANTED, scored: int = SCORED) -> DataFrame:
    """query, node: what the forest over nodes (node, v) proposes for the queries (vec_id, v)."""
    both = _entries(nodes.select(F.col("node").alias("id"), "v"), dim, trees, 0).unionByName(_entries(asked.select(F.col("vec_id").alias("id"), "v"), dim, trees, 1))
    ranges = max(1, -(-nodes.count() * trees // ENTRIES))
    dealt = both.repartitionByRange(ranges, "tree", "string", "tie").sortWithinPartitions("tree", "string", "tie")
    near = dealt.mapInArrow(_windows(window), "query long, ids array<long>, lengths array<int>, far array<int>")
    return near.repartition("query").sortWithinPartitions("query").mapInArrow(_ascend(wanted, scored), "query long, node long")


def _score(dim: int, k: int):
    """From blocks of vectors (role 0) and of queries with their candidates there (role 1): each query's best."""
    schema = pa.schema([("query_id", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])

    def run(batches):
        block, ids, vectors, norms = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            b, role, key = (batch.column(i).to_numpy() for i in range(3))
            v = scaled(batch.column(3).flatten().to_numpy().reshape(-1, dim))
            lists = batch.column(4)
            for i in range(len(b)):
                if b[i] != block:
                    block, ids, vectors, norms = b[i], [], [], None
                if role[i] == 0:
                    ids.append(key[i])
                    vectors.append(v[i])
                    continue
                if norms is None:
                    ids, vectors = np.array(ids), np.array(vectors)
                    order = np.argsort(ids)
                    ids, vectors = ids[order], vectors[order]
                    norms = np.sqrt((vectors * vectors).sum(axis=1))
                rows = np.searchsorted(ids, lists[i].values.to_numpy())
                score = (vectors[rows] * v[i]).sum(axis=1) / (norms[rows] * np.sqrt((v[i] * v[i]).sum()))
                if len(rows) > k:
                    keep = score >= np.partition(score, len(score) - k)[len(score) - k]
                    rows, score = rows[keep], score[keep]
                best = np.lexsort((ids[rows], -score))[:k]
                yield batch_of(schema, query_id=np.full(len(best), key[i]), node=ids[rows[best]], score=score[best])

    return run


def search(table: DataFrame, queries: DataFrame, k: int = 5, trees: int = TREES, window: int = WINDOW, wanted: int = WANTED, scored: int = SCORED) -> DataFrame:
    """query_id, rank, vec_id, score: for each query (vec_id, embedding) its k nearest found among the rows of table."""
    spark = table.sparkSession
    index, asked = cut(usable(table)), usable(queries)
    most = index.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, asked = index.where(F.size("v") == most.d), cut(asked.where(F.size("v") == most.d))
    # of equal vectors the k + 1 smallest ids are all that can be given out; the limit acts before the exchange
    first = index.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    nodes = cut(first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("node"), "v", "ids"))
    rows = nodes.count()
    blocks = -(-rows // BLOCK_ROWS)
    home = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int").alias("block")
    pairs = candidates(nodes, asked, most.d, trees, window, wanted, scored).select("query", "node", home)
    visits = pairs.groupBy("query", "block").agg(F.collect_list("node").alias("list")).join(asked, F.col("query") == F.col("vec_id"))
    both = nodes.select(home, F.lit(0).alias("role"), F.col("node").alias("id"), "v", F.lit(None).cast("array<long>").alias("list"))
    both = both.unionByName(visits.select("block", F.lit(1).alias("role"), F.col("query").alias("id"), "v", "list"))
    found = both.repartition(blocks, "block").sortWithinPartitions("block", "role", "id").mapInArrow(_score(most.d, k + 1), "query_id long, node long, score double")
    ranks = Window.partitionBy("query_id")
    best = found.withColumn("place", F.row_number().over(ranks.orderBy(F.desc("score"), "node"))).where(F.col("place") <= k + 1)
    named = best.join(nodes.select("node", "ids"), "node").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    ranked = named.withColumn("rank", F.row_number().over(ranks.orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
