"""Content-chosen anchors: the filter that keeps unrepeated text out of every shuffle.

A window of `width` units (words or bytes) is represented by the smallest hash among its `gram`-unit runs.
Equal windows have equal anchors, so a window can only repeat if its anchor hash occurs at two positions.
About 2 / (width - gram + 2) of all positions are anchors; only their hashes are shuffled to find the repeated ones,
and only windows whose anchor repeats are looked at again.  Nothing is lost: a hash collision merely
adds a window that the exact step behind then rejects.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, cut, forget_state, sliding

PIECE = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_TOP = 1 << 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def grams(values: np.ndarray, k: int, base: int = _BASE) -> np.ndarray:
    """Polynomial hash (mod 2**64) of every run of k values, by doubling."""
    done, length, power, step = None, 0, values, 1
    while k:
        if k & 1:
            if done is None:
                done, length = power, step
            else:
                n = len(values) - length - step + 1
                done = done[:n] * np.uint64(pow(base, step, _TOP)) + power[length : length + n]
                length += step
        k >>= 1
        if k:
            n = len(power) - step
            power = power[:n] * np.uint64(pow(base, step, _TOP)) + power[step : step + n]
            step *= 2
    return done


@dataclass(frozen=True)
class Scheme:
    """width: units of a window; gram: units hashed for an anchor; words: units are words, else UTF-8 bytes; piece: units worked on at once."""

    width: int
    gram: int
    words: bool
    piece: int = PIECE

    @property
    def span(self) -> int:
        return self.width - self.gram + 1

    def units(self, text: bytes) -> np.ndarray:
        """The text's units as 64-bit values; words as rows of two independent lanes."""
        if self.words:
            digest = xxhash.xxh3_128_digest
            return np.frombuffer(b"".join([digest(w) for w in text.split()]), "<u8").reshape(-1, 2)
        return np.frombuffer(text, np.uint8)

    def values(self, units: np.ndarray, lane: int = 0) -> np.ndarray:
        return np.ascontiguousarray(units[:, lane]) if self.words else _BYTES[units]


_BYTES = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([i])) for i in range(256)), "<u8").copy()


@dataclass
class Pack:
    """Pieces of documents laid end to end."""

    units: np.ndarray
    doc: np.ndarray  # row number of each piece
    offset: np.ndarray  # where the piece starts in its document
    begin: np.ndarray  # where it starts in `units`
    piece_of: np.ndarray  # piece of each window start
    valid: np.ndarray  # window starts that stay in their piece

    def owners(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document rows and positions in them."""
        p = self.piece_of[at]
        return self.doc[p], at - self.begin[p] + self.offset[p]


def packs(scheme: Scheme, texts: Iterable[bytes]) -> Iterator[Pack]:
    """Documents cut into pieces (overlapping by width - 1, so that each window is in one piece) and packed."""
    width, held, size = scheme.width, [], 0

    def pack() -> Pack:
        units = np.concatenate([u for _, _, u in held])
        lengths = np.array([len(u) for _, _, u in held])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        n = len(units) - width + 1
        piece_of = np.repeat(np.arange(len(held)), lengths)[:n]
        valid = np.arange(n) - begin[piece_of] <= lengths[piece_of] - width
        return Pack(units, np.array([d for d, _, _ in held]), np.array([o for _, o, _ in held]), begin, piece_of, valid)

    for row, text in enumerate(texts):
        units = scheme.units(text)
        for at in range(0, len(units) - width + 1, scheme.piece):
            piece = units[at : at + scheme.piece + width - 1]
            held.append((row, at, piece))
            size += len(piece)
            if size >= scheme.piece:
                yield pack()
                held, size = [], 0
    if held:
        yield pack()


def minima(scheme: Scheme, pack: Pack) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the grams, and for each window start the smallest gram hash in the window (zero where not valid)."""
    g = _mix(grams(scheme.values(pack.units), scheme.gram))
    m = sliding(g, scheme.span)
    return g, np.where(pack.valid, m, np.uint64(0))


_ANCHOR = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("c", pa.int32())])
SETTLED = 0


def _collapsed(h: np.ndarray, doc: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    """Of a hash that several documents of one batch hold, one row goes on for all (c = 2); the others are settled."""
    order = np.lexsort((doc, h))
    h, doc, c = h[order], doc[order], c[order]
    first = np.concatenate([[True], h[1:] != h[:-1]])
    size = np.diff(np.append(np.flatnonzero(first), len(h)))
    c = np.where(first, np.where(np.repeat(size, size) > 1, 2, c), SETTLED)
    return batch_of(_ANCHOR, h=h, doc_id=doc, c=c.astype(np.int32))


def anchors(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """h, doc_id, c: each document's distinct anchor hashes; c tells whether one occurs once (1) or more often (2) in what the row
    stands for, or that it is known to repeat already (0), so a hash that very many documents hold gives one unsettled row a batch."""

    def run(batches):
        forget_state()
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                keys = part.column(0).to_numpy()
                rows = [b"" if t is None else t.encode("utf-8", "replace") for t in part.column(1).to_pylist()]
                for pack in packs(scheme, rows):
                    g, m = minima(scheme, pack)
                    rim = np.zeros(scheme.span - 1, np.uint64)
                    chosen = np.flatnonzero(g == sliding(np.concatenate([rim, m, rim]), scheme.span, np.maximum))
                    piece = np.searchsorted(pack.begin, chosen, side="right") - 1
                    doc, h = keys[pack.doc[piece]], g[chosen].view(np.int64)
                    order = np.lexsort((h, doc))
                    doc, h = doc[order], h[order]
                    if not len(h):
                        continue
                    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
                    out.append((h[first], doc[first], np.minimum(np.diff(np.append(first, len(h))), 2)))
            if out:
                yield _collapsed(*(np.concatenate(x) for x in zip(*out, strict=True)))

    return docs.where("doc_id is not null").mapInArrow(run, "h long, doc_id long, c int")


_KEPT = pa.schema([("doc_id", pa.int64()), ("h", pa.int64())])


def _keep_repeated(batches):
    """From rows sorted by h, the settled ones and those of hashes that occur more than once in all; one pending row is all that is carried."""
    last, total, pending = None, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, doc, c = (batch.column(i).to_numpy() for i in range(3))
        settled = c == SETTLED
        if settled.any():
            yield batch_of(_KEPT, doc_id=doc[settled], h=h[settled])
            h, doc, c = h[~settled], doc[~settled], c[~settled]
            if not len(h):
                continue
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        sums = np.add.reduceat(c.astype(np.int64), first)
        goes_on = last is not None and h[0] == last
        if goes_on:
            sums[0] += total
        many = sums >= 2
        keep = np.repeat(many, np.diff(np.append(first, len(h))))
        out_doc, out_h = doc[keep], h[keep]
        if pending is not None and goes_on and many[0]:
            out_doc, out_h = np.append(out_doc, pending), np.append(out_h, last)
            pending = None
        if not (goes_on and len(first) == 1):
            pending = None
        last, total = h[-1], int(sums[-1])
        if total < 2:
            pending = doc[-1]
        if len(out_h):
            yield batch_of(_KEPT, doc_id=out_doc, h=out_h)


def repeated(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """doc_id, h: the documents' anchor hashes that occur more than once in all.

    Unsettled rows are dealt by hash and streamed in sorted order, settled ones by document."""
    home = F.when(F.col("c") == SETTLED, F.xxhash64("doc_id")).otherwise(F.col("h"))
    return anchors(docs, scheme).repartition(home).sortWithinPartitions("h").mapInArrow(_keep_repeated, "doc_id long, h long")


SALTS = 64


def with_repeated(docs: DataFrame, scheme: Scheme, hot: int) -> DataFrame:
    """doc_id, text, hs, hot for every document; hs are the hashes of its repeated anchors (null: none), hot those that over `hot` documents hold.

    The two-sided join on a hash is salted by document, so that a hash which very many documents hold meets in no one task.  The last join
    keeps all documents so that their exchange by doc_id is the very one the callers' last join asks for: Spark makes it once and reads it twice.
    """
    found = cut(repeated(docs, scheme))  # small: repeated anchors only
    often = found.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    often = often.select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("is_hot"))
    marked = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(often, ["h", "salt"], "left")
    lists = marked.groupBy("doc_id").agg(F.collect_list("h").alias("hs"), F.collect_list(F.when(F.col("is_hot"), F.col("h"))).alias("hot"))
    return docs.join(lists, "doc_id", "left").select("doc_id", "text", "hs", "hot")


def stretches(scheme: Scheme, pack: Pack, lists: list[np.ndarray], hot: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the pack's segments start, how many windows each has, and under which key it meets its like.

    A segment is a run of neighbouring windows under one repeated anchor, cut after `longest` windows.  Under an anchor that is hot the gram
    grows to the whole window: there each window is a segment of its own under its own hash, so that no key gathers texts that differ."""
    at, h = candidates(scheme, pack, lists)
    if not len(at):
        return at, at, h
    is_hot = np.isin(h, hot) if len(hot) else np.zeros(len(h), bool)
    if is_hot.any():
        h = np.where(is_hot, grams(scheme.values(pack.units), scheme.width)[at].view(np.int64), h)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (h[1:] != h[:-1]) | is_hot[1:]]))
    n = np.diff(np.append(first, len(at)))
    if n.max() > longest:  # very periodic text
        first = np.concatenate([np.arange(s, s + k, longest) for s, k in zip(first.tolist(), n.tolist(), strict=True)])
        n = np.diff(np.append(first, len(at)))
    return at[first], n, h[first]


def listed(column) -> list[np.ndarray]:
    """Sorted arrays of an Arrow list column; null counts as empty."""
    return [np.sort(np.asarray(x or (), np.int64)) for x in column.to_pylist()]


def candidates(scheme: Scheme, pack: Pack, lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Window starts whose anchor is among the repeated ones of their document, and the anchors."""
    _, m = minima(scheme, pack)
    hashes, keep = m.view(np.int64), np.zeros(len(m), bool)
    stops = np.append(pack.begin[1:], len(pack.units))
    for doc, begin, stop in zip(pack.doc.tolist(), pack.begin.tolist(), np.minimum(stops, len(m)).tolist(), strict=True):
        known = lists[doc]
        if stop > begin and len(known):
            part = hashes[begin:stop]
            keep[begin:stop] = known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part
    keep &= pack.valid
    at = np.flatnonzero(keep)
    return at, hashes[at]
