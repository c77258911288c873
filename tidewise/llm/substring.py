"""Substring dedup by relative Lempel-Ziv parsing against an index of the whole corpus.

Every document is factored against what comes before it (smaller doc_id, or the same document further left).  The reference is
the corpus cut into blocks by anchor (see anchors): a block holds, in order of (doc_id, start), the stretches of text
whose windows have anchors of the block, and an index of their windows.  Equal windows have equal anchors, so a document's
stretch is factored against the one block that can hold its like, and between them the blocks are the whole reference.  The parse
is greedy: the first window with an earlier occurrence starts a factor, which is extended word by word for as long as its reference
goes on; at the factor's end the next window not inside it is looked up afresh, so windows across factor boundaries are judged too.  Where
a stretch or its reference ends the parse goes on in the next one, and factors that continue each other are joined
again when a document's factors come together.  Factors are at least `window` words long; the words they cover are the duplicate spans.
Texts are compared word by word, no hash decides.

Stretches that are equal within a reading task are factors of the first one there and then; one goes on.  Only windows whose anchor
repeats take part; windows of an anchor that over `hot` documents hold meet under their own hash instead, so a block never gathers more
than that many different stretches of one anchor.

A null text has no words.  Rows with a null doc_id are returned whole and take no part.  Repeated rows of one doc_id are the same document:
neither is earlier than the other, and each is returned with the same result.  Texts shorter than a window keep all words.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.anchors import PIECE, Scheme, listed, packs, stretches, with_repeated
from tidewise.llm.common import batch_of, raw, texts

HOT = 20_000
RUN = 4_096
#: Stretches of so many bytes are compared within a reading task before they go on.
HELD_BYTES = 1 << 24
_LOW = 24  # a place is packed as start << _LOW | windows

_STRETCH = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("seg", pa.binary()), ("ref_doc", pa.int64()), ("ref_pos", pa.int32())])
_STRETCH_DDL = "h long, doc_id long, place long, seg binary, ref_doc long, ref_pos int"
_FACTOR = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("ref_doc", pa.int64()), ("ref_pos", pa.int32())])
_FACTOR_DDL = "doc_id long, place long, ref_doc long, ref_pos int"


def _stretches(scheme: Scheme, run_windows: int):
    """Rows of stretches, and of those already settled as factors of an equal one (no seg; dealt by document)."""

    def settled(h, doc, place, segs):
        """The held stretches: of equal ones the earliest keeps its text, the others refer to it."""
        out: dict[str, list] = {f.name: [] for f in _STRETCH}
        lead: dict[tuple, tuple[int, int]] = {}
        for i in np.lexsort((place, doc)).tolist():
            key, d, p = (h[i], segs[i]), doc[i], place[i]
            first = lead.setdefault(key, (d, p))
            if first == (d, p):
                row = (h[i], d, p, segs[i], None, None)
            else:
                row = (d * 1_000_003 + p, d, p, None, first[0], first[1] >> _LOW)
            for values, x in zip(out.values(), row, strict=True):
                values.append(x)
        out["h"] = np.array([x & (1 << 64) - 1 for x in out["h"]], np.uint64).view(np.int64)
        return batch_of(_STRETCH, **out)

    def run(batches):
        held, size = ([], [], [], []), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                part = part.filter(part.column(2).is_valid())
                if not part.num_rows:
                    continue
                keys, lists = part.column(0).to_numpy(), listed(part.column(2))
                hot = np.unique(np.concatenate([np.empty(0, np.int64), *listed(part.column(3))]))
                rows = [raw(t) for t in part.column(1).to_pylist()]
                lines: dict[int, tuple[bytes, list[int]]] = {}
                for pack in packs(scheme, rows):
                    starts, n, h = stretches(scheme, pack, lists, hot, run_windows)
                    row, pos = pack.owners(starts)
                    for r, p, k, key in zip(row.tolist(), pos.tolist(), n.tolist(), h.tolist(), strict=True):
                        if r not in lines:
                            words = rows[r].split()
                            lines[r] = b" ".join(words), list(accumulate([len(w) + 1 for w in words], initial=0))
                        line, edge = lines[r]
                        seg = line[edge[p] : edge[p + k + scheme.width - 1] - 1]
                        for values, x in zip(held, (key, int(keys[r]), p << _LOW | k, seg), strict=True):
                            values.append(x)
                        size += len(seg)
                if size >= HELD_BYTES:
                    yield settled(*held)
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield settled(*held)

    return run


class Block:
    """The reference under one anchor: stretches in order of (doc_id, start), and where each window of theirs first occurs."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.held: list[tuple[int, int, list[bytes]]] = []
        self.index: dict[bytes, tuple[int, int]] = {}
        self.whole: dict[bytes, tuple[int, int]] = {}

    def parse(self, doc: int, start: int, seg: bytes) -> list[tuple[int, int, int, int]]:
        """The greedy factors of a stretch that comes after all held: (start, windows, ref_doc, ref_start) from left to right; what has no
        earlier occurrence becomes reference."""
        same = self.whole.get(seg)
        window, words = self.window, seg.split(b" ")
        if same is not None:
            return [(start, len(words) - window + 1, *same)]
        self.whole[seg] = (doc, start)
        edge, number, index, p, out = list(accumulate([len(w) + 1 for w in words], initial=0)), len(self.held), self.index, 0, []
        self.held.append((doc, start, words))
        last = len(words) - window
        while p <= last:
            key = seg[edge[p] : edge[p + window] - 1]
            got = index.get(key)
            if got is None:
                index[key] = (number, p)
                p += 1
                continue
            ref_doc, ref_start, ref = self.held[got[0]]
            r, k = got[1], window
            most = min(len(words) - p, len(ref) - r)
            while k < most and words[p + k] == ref[r + k]:
                k += 1
            out.append((start + p, k - window + 1, ref_doc, ref_start + r))
            p += k - window + 1  # the first window that crosses the factor's end
        return out


def _parse(window: int):
    """From stretches sorted by anchor, document and place: their factors; settled ones pass."""

    def run(batches):
        key, before, block = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            seg = batch.column(3)
            done = seg.is_null()
            if done.true_count:
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(done) for i in (1, 2, 4, 5)], schema=_FACTOR)
                batch = batch.filter(seg.is_valid())
            found: list[tuple[int, int, int, int]] = []
            owner: list[int] = []
            for h, doc, place, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if h != key:
                    key, before, block = h, None, Block(window)
                if before == (doc, place):
                    continue  # a repeated row
                before = (doc, place)
                factors = block.parse(doc, place >> _LOW, text)
                found += factors
                owner += [doc] * len(factors)
            if found:
                start, n, ref_doc, ref_pos = zip(*found, strict=True)
                yield batch_of(_FACTOR, doc_id=owner, place=np.array(start, np.int64) << _LOW | np.array(n, np.int64), ref_doc=ref_doc, ref_pos=ref_pos)

    return run


def joined(start: np.ndarray, windows: np.ndarray, ref_doc: np.ndarray, ref_start: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """A document's factors from left to right as (start, words, ref_doc, ref_start); those that continue each other in the same reference are one."""
    order = np.lexsort((windows, start))
    start, windows, ref_doc, ref_start = (x[order] for x in (start, windows, ref_doc, ref_start))
    goes_on = (start[1:] == start[:-1] + windows[:-1]) & (ref_doc[1:] == ref_doc[:-1]) & (ref_start[1:] == ref_start[:-1] + windows[:-1])
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(start)), bool), ~goes_on]))
    return start[at], (np.add.reduceat(windows, at) if len(at) else windows) + window - 1, ref_doc[at], ref_start[at]


def dedup(docs: DataFrame, window: int = 20, gram: int = 5, detail: bool = False, hot: int = HOT, run_windows: int = RUN, piece: int = PIECE) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; with `detail` also kept (the text left) and factors."""
    scheme = Scheme(window, gram, True, piece)
    docs = texts(docs)
    cuts = with_repeated(docs, scheme, hot).mapInArrow(_stretches(scheme, run_windows), _STRETCH_DDL)
    factors = cuts.repartition("h").sortWithinPartitions("h", "doc_id", "place").mapInArrow(_parse(window), _FACTOR_DDL)
    per_doc = factors.groupBy("doc_id").agg(F.collect_list(F.struct("place", "ref_doc", "ref_pos")).alias("factors"))
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if detail:
        fields += [("kept", pa.string()), ("factors", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("ref_doc", pa.int64()), ("ref_start", pa.int64())])))]
        ddl += ", kept string, factors array<struct<start: long, words: long, ref_doc: long, ref_start: long>>"
    schema = pa.schema(fields)

    def finish(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: dict[str, list] = {f.name: [] for f in schema}
                lists = part.column(2)
                flat, ends = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy().cumsum()
                place, ref_doc, ref_pos = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
                for i, (key, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    words = raw(text).split()
                    a, b = int(ends[i - 1]) if i else 0, int(ends[i])
                    start, length, rd, rp = joined(place[a:b] >> _LOW, place[a:b] & (1 << _LOW) - 1, ref_doc[a:b], ref_pos[a:b], window)
                    kept = words
                    if b > a:
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, np.minimum(start, len(words)), 1)
                        np.add.at(gone, np.minimum(start + length, len(words)), -1)
                        kept = [words[j] for j in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
                    left = b" ".join(kept)
                    out["doc_id"].append(key)
                    out["n_words"].append(len(words))
                    out["n_removed"].append(len(words) - len(kept))
                    out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                    if detail:
                        out["kept"].append(left.decode("utf-8"))
                        rows = zip(*(x.tolist() for x in (start, length, rd, rp)), strict=True)
                        out["factors"].append([dict(zip(("start", "words", "ref_doc", "ref_start"), x, strict=True)) for x in rows])
                yield batch_of(schema, **out)

    return docs.join(per_doc, "doc_id", "left").select("doc_id", "text", "factors").mapInArrow(finish, ddl)
