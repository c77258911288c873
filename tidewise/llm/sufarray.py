"""Suffix-array dedup: bytes covered by a `length`-byte string that also starts anywhere else are removed.

The exact step is threshold-bounded interval expansion on a Burrows-Wheeler transform.  A block of text is
suffix-sorted (to a depth beyond the threshold, which is all that is asked of it); from the empty string's interval,
breadth-first backward extension visits the intervals of ever longer strings, and each interval that ends at a
boundary not seen before fixes the common prefix there to the current depth.  So common prefixes are found in
increasing order, and the search stops at the threshold: boundaries not reached then have a common prefix of at least
`length`, and the suffixes beside them start a repeated string.

What reaches that step: windows whose anchor hash repeats (see anchors) are cut into segments, one for each run of
windows under an anchor.  All segments of an anchor meet in one task; equal segments collapse (their windows repeat by
that alone), and what differs is packed into blocks of about BLOCK bytes.  For an anchor that over HOT documents hold the gram grows to
the whole window, so that only equal windows share a key: a group holds HOT different segments of RUN windows at the most.
Texts are compared byte by byte, no hash decides.

A null text is empty; texts shorter than `length` lose nothing.  Rows with a null doc_id are returned whole and
take no part.  Repeated rows are separate occurrences: each is a repeat of the other.  Matches never cross documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.anchors import PIECE, Scheme, listed, packs, stretches, with_repeated
from tidewise.llm.common import batch_of, raw, texts

BLOCK = 1 << 20
HOT = 4_000
RUN = 1_024
#: Segments of so many bytes are compared within a reading task before they go on.
HELD_BYTES = 1 << 24

_ROW = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("span", pa.int64()), ("twice", pa.bool_()), ("seg", pa.binary())])
_ROW_DDL = "h long, doc_id long, span long, twice boolean, seg binary"
_SPAN = pa.schema([("doc_id", pa.int64()), ("span", pa.int64())])
_LOW = 24  # a span is packed as start << _LOW | windows


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes (by start) sorted by their first `depth` symbols at least; symbols are 1 and up, the end counts as 0."""
    n = len(symbols)
    bits = int(symbols.max()).bit_length()
    have = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(have, np.int64)])
    for j in range(have):
        key = (key << bits) | padded[j : j + n]
    while True:
        order = np.argsort(key)
        ranked = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (ranked[1:] != ranked[:-1]).astype(np.int64)]))
        if have >= depth or rank[order[-1]] == n:
            return order
        tail = np.zeros(n, np.int64)
        tail[: n - have] = rank[have:] if have < n else 0
        key = rank * (n + 1) + tail
        have *= 2


def repeated_starts(symbols: np.ndarray, length: int) -> np.ndarray:
    """For each position: does the string of `length` symbols there (the end counts as a symbol) start elsewhere too?"""
    n = len(symbols)
    if n < 2:
        return np.zeros(n, bool)
    alphabet, dense = np.unique(symbols, return_inverse=True)
    sigma = len(alphabet) + 1
    text = np.append(dense.astype(np.int64) + 1, 0)  # a terminator smaller than all
    order = suffix_order(text + 1, length + 1)
    n += 1
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")  # the LF mapping: where the suffix one symbol longer stands
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)
    known = np.zeros(n + 1, bool)  # boundaries whose common prefix is fixed
    known[0] = known[n] = True
    lb, rb = np.array([0]), np.array([n])
    for _ in range(length):
        # an interval's children: its positions of one symbol map to neighbours, so each child is where such a stretch begins and ends
        sizes = rb - lb
        wide = sizes > 1
        single = lf[lb[~wide]]
        sizes, from_ = sizes[wide], lb[wide]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(from_ - (ends - sizes), sizes)
        owner = np.repeat(np.arange(len(sizes)) * sigma, sizes) + bwt[at]
        rank = np.argsort(owner, kind="stable")
        owner, target = owner[rank], lf[at[rank]]
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(owner)), bool), owner[1:] != owner[:-1]]))
        new_lb = np.concatenate([single, target[starts]])
        new_rb = np.concatenate([single, target[np.append(starts[1:], len(target))[: len(starts)] - 1]]) + 1
        fresh = ~known[new_rb]
        new_lb, new_rb = new_lb[fresh], new_rb[fresh]
        if not len(new_rb):
            break
        known[new_rb] = True
        lb, rb = new_lb, new_rb
    same = ~known[1:n]  # suffixes i-1 and i share at least `length` symbols
    hit = np.zeros(n, bool)
    hit[1:] |= same
    hit[:-1] |= same
    out = np.zeros(n, bool)
    out[order] = hit
    return out[: n - 1]


def _cut_segments(scheme: Scheme, run_windows: int):
    """Rows of segments; of equal ones within a task the first goes on as one that repeats (twice), the others are settled (no seg; dealt by document)."""

    def settled(h, doc, span, segs):
        lead: dict[tuple, int] = {}
        home, twice, left = list(h), [False] * len(h), list(segs)
        for i, key in enumerate(zip(h, segs, strict=True)):
            first = lead.setdefault(key, i)
            if first != i:
                twice[first] = True
                home[i], left[i] = doc[i] * 1_000_003 + span[i], None
        home = np.array([x & (1 << 64) - 1 for x in home], np.uint64).view(np.int64)
        return batch_of(_ROW, h=home, doc_id=doc, span=span, twice=twice, seg=left)

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
                for pack in packs(scheme, [raw(t) for t in part.column(1).to_pylist()]):
                    starts, n, h = stretches(scheme, pack, lists, hot, run_windows)
                    row, pos = pack.owners(starts)
                    whole, width = pack.units.tobytes(), scheme.width
                    segs = [whole[s : s + k + width - 1] for s, k in zip(starts.tolist(), n.tolist(), strict=True)]
                    for values, more in zip(held, (h.tolist(), keys[row].tolist(), (pos.astype(np.int64) << _LOW | n).tolist(), segs), strict=True):
                        values += more
                    size += sum(map(len, segs))
                if size >= HELD_BYTES:
                    yield settled(*held)
                    held, size = ([], [], [], []), 0
        if held[0]:
            yield settled(*held)

    return run


class _Meeting:
    """Takes segments sorted by key, gives spans of repeated windows."""

    def __init__(self, length: int, block: int) -> None:
        self.length, self.most = length, block
        self.spans: list[tuple[int, int]] = []
        self.block: list[tuple[bytes, int, int, bool]] = []
        self.size = 0
        self.group: dict[bytes, list] = {}  # of each different segment the first place and whether it repeats
        self.key: int | None = None

    def take(self, h: int, doc: int, span: int, twice: bool, seg: bytes) -> None:
        if h != self.key:
            self.close()
            self.key = h
        first = self.group.get(seg)
        if first is None:
            self.group[seg] = [doc, span, twice]
            if twice:
                self.spans.append((doc, span))
            return
        if not first[2]:
            first[2] = True
            self.spans.append((first[0], first[1]))
        self.spans.append((doc, span))

    def close(self) -> None:
        """The group of a key is complete: what differs in it goes to one block; a lone segment that repeats as a whole is settled."""
        if len(self.group) > 1 or any(not x[2] for x in self.group.values()):
            for seg, (doc, span, repeats) in self.group.items():
                self.block.append((seg, doc, span, repeats))
                self.size += len(seg) + 1
        self.group = {}
        if self.size >= self.most:
            self.solve()

    def solve(self) -> None:
        if not self.block:
            return
        lengths = np.array([len(x[0]) for x in self.block])
        symbols = np.full(int(lengths.sum()) + len(lengths), 256, np.int32)
        begin = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        joined = np.frombuffer(b"".join(x[0] for x in self.block), np.uint8)
        symbols[np.arange(len(joined)) + np.repeat(np.arange(len(lengths)), lengths)] = joined
        hit = repeated_starts(symbols, self.length)
        for (_, doc, span, repeats), b, k in zip(self.block, begin.tolist(), lengths.tolist(), strict=True):
            if repeats:
                continue  # given out already
            mine = np.flatnonzero(hit[b : b + k - self.length + 1])
            if len(mine):
                first = np.flatnonzero(np.concatenate([[True], np.diff(mine) != 1]))
                n = np.diff(np.append(first, len(mine)))
                self.spans += [(doc, ((span >> _LOW) + p) << _LOW | m) for p, m in zip(mine[first].tolist(), n.tolist(), strict=True)]
        self.block, self.size = [], 0

    def flush(self):
        if self.spans:
            doc, span = zip(*self.spans, strict=True)
            self.spans = []
            yield batch_of(_SPAN, doc_id=doc, span=span)


def _meet(length: int, block: int):
    def run(batches):
        meeting = _Meeting(length, block)
        for batch in batches:
            seg = batch.column(4)
            done = seg.is_null()
            if done.true_count:
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(done) for i in (1, 2)], schema=_SPAN)
                batch = batch.filter(seg.is_valid())
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                meeting.take(*row)
            yield from meeting.flush()
        meeting.close()
        meeting.solve()
        yield from meeting.flush()

    return run


def dedup(docs: DataFrame, length: int = 200, gram: int = 96, detail: bool = False, hot: int = HOT, run_windows: int = RUN, block: int = BLOCK, piece: int = PIECE) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row; with `detail` also spans (start, stop), kept (bytes) and
    kept_text (kept as text; characters that were cut through are left out)."""
    scheme = Scheme(length, gram, False, piece)
    docs = texts(docs)
    rows = with_repeated(docs, scheme, hot).mapInArrow(_cut_segments(scheme, run_windows), _ROW_DDL)
    spans = rows.repartition("h").sortWithinPartitions("h").mapInArrow(_meet(length, block), "doc_id long, span long")
    per_doc = spans.groupBy("doc_id").agg(F.collect_list("span").alias("spans"))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if detail:
        fields += [("kept", pa.binary()), ("kept_text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]
        ddl += ", kept binary, kept_text string, spans array<struct<start: long, stop: long>>"
    schema = pa.schema(fields)

    def finish(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: dict[str, list] = {f.name: [] for f in schema}
                spans_ = part.column(2)
                flat, ends = spans_.flatten(), spans_.value_lengths().fill_null(0).to_numpy().cumsum()
                packed = flat.to_numpy(zero_copy_only=False).astype(np.int64)
                starts, counts = packed >> _LOW, packed & (1 << _LOW) - 1
                for i, (key, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)):
                    data = raw(text)
                    a, b = int(ends[i - 1]) if i else 0, int(ends[i])
                    kept, cuts = data, []
                    if b > a:
                        s, order = starts[a:b], np.argsort(starts[a:b], kind="stable")
                        s, e = s[order], np.minimum((s + counts[a:b] + length - 1)[order], len(data))
                        reach = np.maximum.accumulate(e)
                        new = np.flatnonzero(np.concatenate([[True], s[1:] > reach[:-1]]))
                        cuts = list(zip(s[new].tolist(), reach[np.append(new[1:], len(s)) - 1].tolist(), strict=True))
                        pieces, at_ = [], 0
                        for x, y in cuts:
                            pieces.append(data[at_:x])
                            at_ = y
                        kept = b"".join([*pieces, data[at_:]])
                    out["doc_id"].append(key)
                    out["n_bytes"].append(len(data))
                    out["n_removed"].append(len(data) - len(kept))
                    out["n_spans"].append(len(cuts))
                    out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                    if detail:
                        out["kept"].append(kept)
                        out["kept_text"].append(None if text is None else kept.decode("utf-8", "ignore"))
                        out["spans"].append([{"start": x, "stop": y} for x, y in cuts])
                yield batch_of(schema, **out)

    return docs.join(per_doc, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(finish, ddl)
