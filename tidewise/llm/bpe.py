"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Each pre-token is a doubly linked list of byte positions.  Every neighbouring pair whose bytes are
a vocabulary entry waits in the bucket of its merge rank; a two-level bitmap over the ranks finds
the lowest non-empty bucket by find-first-set.  Entries of pairs that changed since they were queued
are stale and skipped, so a pre-token of n bytes costs O(n log n) however long it is.

Null texts count as empty; an empty text has no ids.  Repeated rows each give a row; columns other
than doc_id and text are ignored.  Order and ties need no rule: every row stands alone.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewise.llm.common import batch_of, raw, rows_of, texts, worker_state

CACHE_ENTRIES = 500_000
CACHED_CHARS = 64


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token.

    The queue is inlined, as it is the whole cost: `buckets` holds positions by rank, `words` one 64-bit
    occupancy word for 64 ranks, `summary` one bit for each word that is not zero.  The lowest rank comes
    first and, within it, the leftmost position (each bucket is a small heap).
    """
    n = len(piece)
    get = ranks.get
    end = list(range(1, n + 1))  # where the token that starts here ends
    before = list(range(-1, n))
    rank_at = [-1] * n  # the rank this position's pair is queued under, to tell stale entries
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    summary = 0
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            rank_at[i] = r
            if r in buckets:
                buckets[r].append(i)  # ascending, so a heap already
            else:
                buckets[r] = [i]
                hi = r >> 6
                words[hi] = words.get(hi, 0) | 1 << (r & 63)
                summary |= 1 << hi
    while summary:
        hi = (summary & -summary).bit_length() - 1
        word = words[hi]
        r = (hi << 6) + (word & -word).bit_length() - 1
        bucket = buckets[r]
        i = heappop(bucket)
        if not bucket:
            del buckets[r]
            word &= word - 1
            words[hi] = word
            if not word:
                summary &= summary - 1
        if rank_at[i] != r:
            continue
        mid = end[i]
        stop = end[i] = end[mid]
        rank_at[mid] = rank_at[i] = -1
        fresh = ()
        if stop < n:
            before[stop] = i
            q = get(piece[i : end[stop]])
            if q is not None:
                fresh = ((q, i),)
        if i:
            p = before[i]
            q = get(piece[p:stop])
            if q is None:
                rank_at[p] = -1
            elif q != rank_at[p]:
                fresh += ((q, p),)
        for q, p in fresh:
            rank_at[p] = q
            if q in buckets:
                heappush(buckets[q], p)
            else:
                buckets[q] = [p]
                hi = q >> 6
                words[hi] = words.get(hi, 0) | 1 << (q & 63)
                summary |= 1 << hi
    out, i = [], 0
    while i < n:
        stop = end[i]
        out.append(ranks[piece[i:stop]])
        i = stop
    return out


class Codec:
    """Encoder and decoder over a tiktoken-style rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.vocab = ranks, {i: b for b, i in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str, pattern: str) -> Codec:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}, pattern)

    def _new(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode("utf-8", "replace")
            whole = self.ranks.get(data)
            ids = whole.to_bytes(4, "little") if whole is not None else array("I", merge(data, self.ranks)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self.cache) >= CACHE_ENTRIES:
                self.older, self.cache = self.cache, {}
            self.cache[piece] = ids
        return ids

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        get, new = self.cache.get, self._new
        return b"".join([get(p) or new(p) for p in self.find(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))


def codec(path: str, pattern: str) -> Codec:
    return worker_state(("bpe", path, pattern), lambda: Codec.load(path, pattern))


def encode_documents(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>, if asked for), ids_sha256, decoded_sha256 for every row; no shuffle."""
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        ddl += ", ids array<int>"
    schema = pa.schema(fields)

    def run(batches):
        coder = codec(path, pattern)
        for ids, rows in rows_of(batches, "doc_id", "text"):
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc_id, text in zip(ids, rows, strict=True):
                data = coder.encode_bytes(raw(text).decode())
                numbers = np.frombuffer(data, "<u4")
                out["doc_id"].append(doc_id)
                out["n_tokens"].append(len(numbers))
                out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(coder.decode(numbers.tolist())).hexdigest())
                if with_ids:
                    out["ids"].append(numbers.astype(np.int32))
            yield batch_of(schema, **out)

    return texts(docs).mapInArrow(run, ddl)


def decode_documents(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and text for rows of doc_id and ids (array<int>; null: empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        coder = codec(path, pattern)
        for keys, rows in rows_of(batches, "doc_id", "ids"):
            yield batch_of(schema, doc_id=keys, text=[coder.decode(r or []).decode("utf-8", "replace") for r in rows])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
