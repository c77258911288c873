"""Shared plumbing of the llm operators: batching, text access, checkpoints, components.

Every operator here works on DataFrames.  Python runs only inside ``mapInArrow``; each call
sees a stream of Arrow batches, and the helpers below cut those into small pieces so a worker
holds a bounded number of bytes whatever the length of the texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_ROWS = 512


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, ...]]:
    """Python lists of the named columns, at most SLICE_ROWS rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            yield tuple(part.column(part.schema.get_field_index(n)).to_pylist() for n in names)


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about `most` bytes of the column (at least one row each)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(sizes, dtype=np.int64), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


_held: list = [None, None]


def worker_state(key, make):
    """make(), once for a run of tasks with the same key in a worker process.

    One state is held at a time: workers are shared by all operators of a job, and the tables of one that is done would crowd the next."""
    if _held[0] != key:
        _held[0] = _held[1] = None
        _held[1] = make()
        _held[0] = key
    return _held[1]


def forget_state() -> None:
    """Give up the state that an earlier operator left in this worker process, and its memory: what comes next needs none."""
    if _held[0] is None:
        return
    _held[0] = _held[1] = None
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can trim
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def kept_rows(docs: DataFrame, column: str, judge) -> DataFrame:
    """The rows of docs, all columns, for which judge() gives a function that is true of the column's value; rows pass as Arrow slices."""
    place = docs.columns.index(column)

    def run(batches):
        keep = judge()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                yield part.filter(pa.array([keep(x) for x in part.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of the schema's columns; others given are left out."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def raw(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty, lone surrogates are kept out by replacement."""
    return b"" if text is None else text.encode("utf-8", "replace")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone: other columns, whatever their names, never reach an operator's joins."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's spark.checkpoint.dir; only where it is unset (tests) fall back to a local folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows of a few numbers each that may be broadcast: some 20 MB.
BROADCAST_ROWS = 500_000


def is_small(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether df (whose lineage is cut) has few enough rows to be broadcast; with more it is joined by a shuffle."""
    return df.count() <= most


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of shared_path that nothing will read again."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bounded_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About `rows` rows of df (never over twice as many), those with the smallest hash of the keys; all, if there are no more."""
    total = df.count()
    if total <= rows:
        return df
    space = 1 << 40
    return df.where(F.pmod(F.xxhash64(*keys), F.lit(space)) < int(space * rows / total)).limit(2 * rows)


def sliding(values: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """op over every run of `width` neighbours, by doubling; one value per run start."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[:-step], out[step:])
        have += step
    return out


def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """The links of a spanning forest: as many connections with at most one link a node."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while (up := root.get(x, x)) != top:
            root[x], x = top, up
        return top

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every linked node that isn't the smallest of its component; component is that smallest node.

    `links` has two long columns a, b.  Alternating large-star and small-star steps: each is an
    aggregation and an equi-join, so a node with very many links is pre-aggregated on the map side and
    its join partition may be split by AQE; nothing is gathered on the driver but two numbers a round.
    """
    spark = links.sparkSession
    edges = cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
