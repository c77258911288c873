"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur with up to k = m // CHARS_PER_ERROR edits.  It is cut into k + 1 pieces; an
occurrence with at most k edits leaves at least one piece untouched, so exact piece hits (one Aho-Corasick pass over each
text) propose places, and Myers' bit-parallel distance decides them: the pass is exact, nothing is sampled.
Both sides are compared in lower case with white space collapsed.

The items are the stated query set: they are dealt by hash to blocks of about BLOCK_CHARS characters, and each block makes one pass
over all documents.  One block at a time is on the driver and in the workers, however many items there are; where there are several, what a pass
finds is written to the shared folder before the next begins.  Null or empty texts hold nothing.  Items too short for one error (under
`chars_per_error` characters) must occur unchanged and as whole words; items that are null or empty after normalising match
nothing.  Equal items each match.  Repeated rows are judged alike (and give repeated matches); null doc_ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, kept_rows, remove, rows_of, shared_path, texts

CHARS_PER_ERROR = 12
BLOCK_CHARS = 4_000_000


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(item: str, chars_per_error: int = CHARS_PER_ERROR) -> int:
    return len(item) // chars_per_error


def pieces(item: str, parts: int) -> list[tuple[int, str]]:
    """The item cut into so many pieces of nearly equal length, with their places in it."""
    edges = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(pattern: str, text: str, most: int) -> int | None:
    """Least edit distance between the pattern and any substring of text, if at most `most` (Myers 1999, on one big integer)."""
    m = len(pattern)
    table: dict[str, int] = {}
    for i, c in enumerate(pattern):
        table[c] = table.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << m - 1
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = table.get(c, 0)
        xv = eq | minus
        xh = ((eq & plus) + plus ^ plus) | eq
        ph = minus | ~(xh | plus) & full
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        ph = ph << 1 & full  # a match may start anywhere: no cost at the top row
        mh = mh << 1 & full
        plus = mh | ~(xv | ph) & full
        minus = ph & xv
    return best if best <= most else None


class Matcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int) -> None:
        self.items, self.least = [(i, t, budget(t, chars_per_error)) for i, t in items], chars_per_error
        places: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text, k) in enumerate(self.items):
            for at, piece in pieces(text, k + 1):
                places.setdefault(piece, []).append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def match(self, text: str | None) -> list[tuple[int, int]]:
        """(item, distance) of the items that occur in the text."""
        text = normal(text)
        if not text or not self.items:
            return []
        starts: dict[int, set[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for number, at in where:
                starts.setdefault(number, set()).add(end - length + 1 - at)
        out = []
        for number, found in starts.items():
            item, pattern, k = self.items[number]
            best = None
            if not k and len(pattern) < self.least:  # whole words only
                best = 0 if any(_stands_alone(text, at, at + len(pattern)) for at in found) else None
            else:
                for low, high in _reaches(sorted(found), len(pattern), k):
                    part = text[max(0, low) : high]
                    got = 0 if pattern in part else myers(pattern, part, k)
                    if got is not None and (best is None or got < best):
                        best = got
                    if best == 0:
                        break
            if best is not None:
                out.append((item, best))
        return out


def _stands_alone(text: str, start: int, stop: int) -> bool:
    return not (text[start - 1 : start].isalnum() and text[start].isalnum()) and not (text[stop : stop + 1].isalnum() and text[stop - 1].isalnum())


def _reaches(starts: list[int], length: int, errors: int) -> Iterator[tuple[int, int]]:
    """The stretches in which an item proposed at these places can lie; proposals whose stretches meet share one."""
    low, high = starts[0] - errors, starts[0] + length + errors
    for start in starts[1:]:
        if start - errors > high:
            yield low, high
            low = start - errors
        high = start + length + errors
    yield low, high


def _sized(items: DataFrame, block_chars: int) -> tuple[DataFrame, int]:
    """The distinct items with the block each is dealt to, and how many blocks there are."""
    chosen = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null").distinct()
    size = chosen.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    return chosen.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def _load(sized: DataFrame, block: int) -> list[tuple[int, str]]:
    rows = sorted((r.item_id, normal(r.text)) for r in sized.where(F.col("block") == block).select("item_id", "text").toLocalIterator())
    return [(i, t) for i, t in rows if t]


def matches(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance: one row for each document and item that occurs in it within the item's error budget."""
    spark, (sized, blocks) = docs.sparkSession, _sized(items, block_chars)
    schema, ddl = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32())]), "doc_id long, item_id long, distance int"
    path = shared_path(spark, "matches") if blocks > 1 else None
    for block in range(blocks):
        shared = spark.sparkContext.broadcast(_load(sized, block))

        def run(batches, shared=shared):
            matcher = Matcher(shared.value, chars_per_error)
            for keys, rows in rows_of(batches, "doc_id", "text"):
                found = [(key, item, d) for key, text in zip(keys, rows, strict=True) for item, d in matcher.match(text)]
                if found:
                    key, item, d = zip(*found, strict=True)
                    yield batch_of(schema, doc_id=key, item_id=item, distance=d)

        part = texts(docs).mapInArrow(run, ddl)
        if path is None:
            return part
        part.write.mode("append").parquet(path)
        shared.destroy()
    return spark.read.parquet(path)


def clean(docs: DataFrame, items: DataFrame, chars_per_error: int = CHARS_PER_ERROR, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs, all columns, in which no item occurs."""
    spark, (sized, blocks), out, before = docs.sparkSession, _sized(items, block_chars), docs, None
    for block in range(blocks):
        shared = spark.sparkContext.broadcast(_load(sized, block))

        def judge(shared=shared):
            matcher = Matcher(shared.value, chars_per_error)
            return lambda text: not matcher.match(text)

        out = kept_rows(out, "text", judge)
        if block + 1 < blocks:
            path = shared_path(spark, "clean")
            out.write.parquet(path)
            shared.destroy()
            if before:
                remove(spark, before)
            out, before = spark.read.parquet(path), path
    return out
