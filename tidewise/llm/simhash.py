"""SimHash near-duplicates by tiled exact comparison.

Fingerprints: XXH64 (seed 42) of space-joined word shingles, one 64-bit majority vote a document.
Links: every pair of distinct fingerprints at Hamming distance <= radius, found exactly.

Tiles are keyed by population counts: the 64 bits are cut into SEGMENTS, and a tile holds the fingerprints with
one vector of segment counts.  Two fingerprints within the radius differ by at most that much in the sum
of their count differences, so all other tile pairs are skipped without being formed; a fingerprint visits its
own tile as a member and each later tile in reach as a probe.  Inside a tile the comparison is numpy
exclusive-or and bit counts over blocks, again skipping blocks whose total counts differ beyond the radius.  The members and the probes of a tile with more than
`block` of them are split by hash into blocks, and each pair of blocks is a unit of work, so no task holds an unbounded group.
Only a spanning forest of the links found in a batch of tiles leaves a task.

Exact copies collapse to one fingerprint before any of this.  Null texts have no words (fingerprint zero).  A null doc_id
keeps its own row: it has a fingerprint, and its component_id is that of its equals, or null if all of them
lack an id.  Repeated rows repeat in the result.
"""

from __future__ import annotations

import math
from itertools import chain, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, components, cut, forest, forget_state, is_small, raw, rows_of, texts

SEED = 42
SEGMENTS = 6
BLOCK = 4096
STEP = 1024
#: A document is placed in the tiles of its TILES smallest shingle hashes; its SKETCH smallest say which pairs are worth an exact comparison.
TILES = 6
SKETCH = 64
VERIFY = 4096
#: Filters before the exact comparison keep what is within so many standard deviations of a pair at the wanted similarity.
DEVIATIONS = 5
#: Whole shingle sets are compared in blocks of about so many hashes, COLUMNS shingles at a time.
SET_HASHES = 1 << 17
SET_ROWS = 256
COLUMNS = 1 << 12
#: Shingles in FREQUENT of about SAMPLE documents come last in the order of leading shingles (at most MOST_FREQUENT of them); any order is exact.
SAMPLE = 8192
FREQUENT = 4
MOST_FREQUENT = 1 << 18
#: Parities of a set's hashes in so many classes (and, for large sets, in as many as they have hashes twice over): two sets differ in as many
#: hashes at least as these in bits.
PARITIES = 512
#: The first HEAD leading shingles say in which of the tiles two documents share they are compared.
HEAD = 8
#: Tiles of leading shingles up to SMALL_TILE rows are judged pair by pair before signatures are fetched; of one beyond LONG_TILE all rows go on.
SMALL_TILE = 64
LONG_TILE = 1 << 16
#: About so many leading shingles are sorted in one task.
LED_ROWS = 400_000


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of `size` words joined by one space; of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)


def vote(hashes: np.ndarray) -> int:
    """Each bit is set if it is set in over half of the hashes; no hashes: zero."""
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long)."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        forget_state()
        for keys, rows in rows_of(batches, "doc_id", "text"):
            votes = [vote(shingle_hashes(raw(t).lower().split(), shingle)) for t in rows]
            yield batch_of(schema, doc_id=keys, fp=np.array(votes, np.uint64).view(np.int64))

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def by_hash(common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The frequent hashes (the most frequent last) ascending, and the place of each among them."""
    order = np.argsort(common)
    return common[order], order


def leading(hashes: np.ndarray, similarity: float, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first hashes of a set (ascending) in one order for all sets: ascending, but the frequent ones (see by_hash) last, in their own order.

    They are so many that two sets of at least that Jaccard similarity have one of them in common: each set shares ceil(similarity * size) of its
    hashes, so the first that both hold comes among the size - ceil(similarity * size) + 1 first of either."""
    wanted = len(hashes) - math.ceil(similarity * len(hashes) - 1e-6) + 1
    common, place = frequent
    at = np.searchsorted(common, hashes)
    at[at == len(common)] = 0
    is_common = common[at] == hashes if len(common) else np.zeros(len(hashes), bool)
    if is_common.any():
        hashes = np.concatenate([hashes[~is_common], hashes[is_common][np.argsort(place[at[is_common]])]])
    return hashes[:wanted]


def parities(hashes: np.ndarray, classes: int) -> bytes:
    """Whether the number of hashes in each class is odd, a bit a class."""
    return np.packbits(np.bincount((hashes >> np.uint64(20)).astype(np.int64) % classes, minlength=classes) & 1).tobytes()


NONE = np.empty(0, np.uint64)


def shingle_sets(docs: DataFrame, shingle: int, *wanted: str, similarity: float = 1.0, common: np.ndarray = NONE) -> DataFrame:
    """doc_id and what is wanted of the set of a text's distinct shingle hashes: mark (128-bit digest), fp (vote of the set), low (the
    TILES smallest), sketch (the SKETCH smallest, ascending and big-endian: low whole, of the others the upper halves), size, hashes (all, ascending),
    lead (the leading ones for `similarity`, in order), bits (PARITIES parities), wide (a power of two of them, twice the size at least)."""
    kinds = {"mark": ("binary", pa.binary()), "fp": ("long", pa.int64()), "low": ("array<long>", pa.list_(pa.int64())), "sketch": ("binary", pa.binary()), "size": ("long", pa.int64()), "hashes": ("binary", pa.binary()), "lead": ("binary", pa.binary()), "bits": ("binary", pa.binary()), "wide": ("binary", pa.binary())}
    make = {
        "mark": lambda h: xxhash.xxh3_128_digest(h.tobytes()),
        "fp": lambda h: _signed(vote(h)),
        "low": lambda h: h[:TILES].view(np.int64),
        "sketch": lambda h: h[:TILES].astype(">u8").tobytes() + (h[TILES:SKETCH] >> np.uint64(32)).astype(">u4").tobytes(),
        "size": len,
        "hashes": lambda h: h.astype("<u8").tobytes(),
        "lead": lambda h: leading(h, similarity, frequent).astype("<u8").tobytes(),
        "bits": lambda h: parities(h, PARITIES),
        "wide": lambda h: parities(h, max(PARITIES, 1 << (2 * len(h) - 1).bit_length() if len(h) else 0)),
    }
    frequent = by_hash(common)
    schema = pa.schema([("doc_id", pa.int64()), *[(w, kinds[w][1]) for w in wanted]])

    def run(batches):
        forget_state()
        for keys, rows in rows_of(batches, "doc_id", "text"):
            sets = [np.unique(shingle_hashes(raw(t).lower().split(), shingle)) for t in rows]
            yield batch_of(schema, doc_id=keys, **{w: [make[w](h) for h in sets] for w in wanted})

    return texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{w} {kinds[w][0]}" for w in wanted))


def _segments() -> list[int]:
    """Masks of the segments, as near equal in width as 64 allows."""
    edges = [round(64 * i / SEGMENTS) for i in range(SEGMENTS + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]


def _offsets(radius: int) -> list[int]:
    """Differences of tile numbers for all vectors of count differences whose sizes sum to the radius at most, later tiles only."""
    base = [32**i for i in range(SEGMENTS)]
    near = (v for v in product(range(-radius, radius + 1), repeat=SEGMENTS) if sum(map(abs, v)) <= radius)
    return sorted(x for x in (sum(b * d for b, d in zip(base, v, strict=True)) for v in near) if x > 0)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def tiles_by_counts(fps: DataFrame, radius: int) -> DataFrame:
    """tile, role (0 member, 1 probe), fp, node: each fingerprint in its own tile and in the later ones in reach."""
    tile = sum((F.bit_count(F.col("fp").bitwiseAND(F.lit(_signed(m)))).cast("long") * 32**i for i, m in enumerate(_segments())), F.lit(0).cast("long"))
    reach = F.array(F.lit(0).cast("long"), *[F.lit(x).cast("long") for x in _offsets(radius)])
    spread = fps.withColumn("own", tile).select("fp", "node", "own", F.explode(reach).alias("step"))
    return spread.select((F.col("own") + F.col("step")).alias("tile"), (F.col("step") > 0).cast("int").alias("role"), "fp", "node")


SALTS = 64
_WIDE = 1 << 20


def _looked_up(spread: DataFrame, facts: DataFrame) -> DataFrame:
    """spread with what is known of some tiles (facts, whose lineage is cut): broadcast if they are few, else by a join that is salted by document."""
    if is_small(facts):
        return spread.join(F.broadcast(facts), "tile", "left")
    salted = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return spread.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["tile", "salt"], "left").drop("salt")


def _split_hot(spread: DataFrame, block: int) -> DataFrame:
    """Adds blk, the unit of work of a row: one a tile, or, for a tile with over `block` members or probes, one for each pair of blocks of them.

    Members and probes of such a tile are dealt to blocks by hash: a block of members meets itself (blk < 0), each later block of members and each block of
    probes (blk > 0, where members are not compared among themselves), so a unit holds about two blocks."""
    sizes = spread.groupBy("tile").agg(F.count_if(F.col("role") == 0).alias("members"), F.count_if(F.col("role") == 1).alias("probes"))
    hot = sizes.where((F.col("members") > block) | (F.col("probes") > block) & (F.col("members") > 0))
    hot = cut(hot.select("tile", F.ceil(F.col("members") / block).alias("nb"), F.ceil(F.col("probes") / block).alias("pb")))
    own, member = F.col("own"), F.col("role") == 0

    def units(upto, keep, blk, role):
        row = lambda i: F.struct(blk(i).cast("long").alias("blk"), F.lit(role).alias("role"))
        return F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(upto, F.lit(1)) - 1), lambda i: keep(i) & (i < upto)), row)

    pair = lambda i, j: 2 * (i * _WIDE + j)
    mine = F.concat(
        units(F.col("nb"), lambda i: i == own, lambda i: -1 - i, 0),
        units(F.col("nb"), lambda j: j > own, lambda j: pair(own, j) + 1, 0),
        units(F.col("nb"), lambda i: i < own, lambda i: pair(i, own) + 1, 1),
        units(F.col("pb"), lambda j: F.lit(True), lambda j: pair(own, j) + 2, 0),
    )
    probe = units(F.col("nb"), lambda i: F.lit(True), lambda i: pair(i, own) + 2, 1)
    alone = F.array(F.struct(F.lit(0).cast("long").alias("blk"), F.col("role").alias("role")))
    more = [c for c in spread.columns if c not in ("tile", "role", "fp", "node")]
    dealt = _looked_up(spread, hot)
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("fp", "node"), F.greatest(F.when(member, F.col("nb")).otherwise(F.col("pb")), F.lit(1))))
    dealt = dealt.withColumn("unit", F.explode(F.when(F.col("nb").isNull(), alone).when(member, mine).otherwise(probe)))
    return dealt.select("tile", F.col("unit.blk").alias("blk"), F.col("unit.role").alias("role"), "fp", "node", *more)


def _near(a: np.ndarray, b: np.ndarray, radius: int, upper: bool, step: int):
    """Index pairs within the radius, block by block; both sides are sorted by population count, and block pairs out of reach are skipped."""
    ca, cb = np.bitwise_count(a), np.bitwise_count(b)
    for i in range(0, len(a), step):
        x, lo, hi = a[i : i + step], int(ca[i]) - radius, int(ca[min(i + step, len(a)) - 1]) + radius
        first, last = int(np.searchsorted(cb, max(lo, 0))), int(np.searchsorted(cb, min(hi, 64), side="right"))
        for j in range(max(first, i) if upper else first, last, step):
            y = b[j : min(j + step, last)]
            r, c = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
            if upper:
                keep = r + i < c + j
                r, c = r[keep], c[keep]
            if len(r):
                yield r + i, c + j


def compare_tiles(spread: DataFrame, radius: int, block: int = BLOCK, step: int = STEP) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints are within the radius and that share a tile; a forest for each block."""
    dealt = _split_hot(spread, block).repartition("tile", "blk").sortWithinPartitions("tile", "blk", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        forget_state()
        key, fp, node = None, np.empty(0, np.uint64), np.empty(0, np.int64)

        def link(nodes_a, fps_a, nodes_b, fps_b, upper):
            oa, ob = np.argsort(np.bitwise_count(fps_a), kind="stable"), np.argsort(np.bitwise_count(fps_b), kind="stable")
            for r, c in _near(fps_a[oa], fps_b[ob], radius, upper, step):
                yield nodes_a[oa][r], nodes_b[ob][c]

        for batch in batches:
            if not batch.num_rows:
                continue
            tile, blk, role, f, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            f = f.astype(np.int64).view(np.uint64)
            starts = np.concatenate([[0], np.flatnonzero((tile[1:] != tile[:-1]) | (blk[1:] != blk[:-1])) + 1, [len(tile)]])
            links_a, links_b = [], []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                members = s + int(np.searchsorted(role[s:e], 1))
                if key == (tile[s], blk[s]):  # the tile goes on from the batch before
                    old_f, old_n = fp, node
                else:
                    key, old_f, old_n = (tile[s], blk[s]), f[:0], n[:0]
                fp, node = (np.concatenate([old_f, f[s:members]]), np.concatenate([old_n, n[s:members]])) if members > s else (old_f, old_n)
                if len(fp) == 0 or (e - s == 1 and len(fp) == 1 and members == e):
                    continue
                found = []
                if members > s and blk[s] <= 0:
                    found.append(link(n[s:members], f[s:members], n[s:members], f[s:members], True))
                    if len(old_f):
                        found.append(link(old_n, old_f, n[s:members], f[s:members], False))
                if e > members:
                    found.append(link(node, fp, n[members:e], f[members:e], False))
                for a, b in chain.from_iterable(found):
                    links_a.append(a)
                    links_b.append(b)
            if links_a:
                tree = forest(np.concatenate(links_a), np.concatenate(links_b))
                yield batch_of(schema, a=[x for x, _ in tree], b=[x for _, x in tree])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, block: int = BLOCK, step: int = STEP) -> DataFrame:
    """doc_id, fp, component_id of every row: all links within `radius` bits (4 at most), whichever documents they join."""
    if not 0 <= radius <= 4:
        raise ValueError("population counts prune too little beyond 4 bits; use similar_groups")
    marked = cut(fingerprints(docs, shingle))  # two numbers a document, read three times
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null")
    links = compare_tiles(tiles_by_counts(cut(distinct), radius), radius, block, step)
    groups = components(links)
    named = distinct.join(groups, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of sketches (ascending, padded by the largest value): the share of common hashes among
    the SKETCH smallest of both together."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    fresh = np.concatenate([np.ones((len(both), 1), bool), both[:, 1:] != both[:, :-1]], axis=1) & (both != _PAD)
    rank = np.cumsum(fresh, axis=1)
    shared = (~fresh & (both != _PAD) & (rank <= SKETCH)).sum(axis=1)
    return shared / np.maximum(np.minimum(rank[:, -1], SKETCH), 1)


_PAD = np.uint64(1 << 33)


def _sketches(column) -> tuple[np.ndarray, np.ndarray]:
    """Sketches (upper halves) and their whole TILES smallest hashes, padded; a row each."""
    out, low = np.full((len(column), SKETCH), _PAD, np.uint64), np.zeros((len(column), TILES), np.uint64)
    for i, data in enumerate(column.to_pylist()):
        head, tail = np.frombuffer(data[: 8 * TILES], ">u8"), np.frombuffer(data[8 * TILES :], ">u4")
        low[i, : len(head)] = head
        out[i, : len(head)] = head >> np.uint64(32)
        out[i, len(head) : len(head) + len(tail)] = tail
    return out, low


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest hash that two rows of smallest hashes share (they share one)."""
    same = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return a[np.arange(len(a)), same.argmax(axis=1)]


class _Side:
    """Documents of a tile in order of a key, a column for each value given; `marked` are those known to be in a pair worth an exact comparison."""

    def __init__(self, nodes, key, **values) -> None:
        order = np.argsort(key, kind="stable")
        self.nodes, self.marked = nodes[order], np.zeros(len(nodes), bool)
        for name, x in values.items():
            setattr(self, name, x[order])


def _mark(a: _Side, b: _Side, tile: int, radius: int, similarity: float) -> None:
    """Marks both documents of every pair that may be similar and whose first shared tile this is; pairs of two marked ones need no look."""
    least = similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / SKETCH)
    for left, right in _near(a.fps, b.fps, radius, a is b, STEP):
        na, nb = a.sizes[left], b.sizes[right]
        near = np.minimum(na, nb) >= similarity * np.maximum(na, nb) - 1e-9
        left, right = left[near], right[near]
        for at in range(0, len(left), VERIFY):
            x, y = left[at : at + VERIFY], right[at : at + VERIFY]
            unknown = ~(a.marked[x] & b.marked[y])
            x, y = x[unknown], y[unknown]
            here = _first_shared(a.low[x], b.low[y]) == np.uint64(tile)
            x, y = x[here], y[here]
            if len(x):
                alike = overlap(a.sketches[x], b.sketches[y]) >= least
                a.marked[x[alike]] = True
                b.marked[y[alike]] = True


def _mark_possible(a: _Side, b: _Side, tile: int, similarity: float) -> None:
    """Marks both documents of every pair of two groups that is not proved to be less similar, unless an earlier tile compares it.

    Sets that similar share `need` hashes at least, all from their first shared one on, and differ in size_a + size_b - 2 * need at most,
    which the differing parities never exceed."""
    part, step = similarity / (1 + similarity), STEP // 2
    for i in range(0, len(a.nodes), step):
        na, ga, la = (x[i : i + step, None] for x in (a.sizes, a.groups, a.sizes - a.places))
        first = int(np.searchsorted(b.sizes, similarity * na[0, 0] - 1e-6))
        last = int(np.searchsorted(b.sizes * similarity, na[-1, 0] + 1e-6, side="right"))
        for j in range(max(first, i) if a is b else first, last, step):
            nb, gb, lb = (x[None, j : min(j + step, last)] for x in (b.sizes, b.groups, b.sizes - b.places))
            need = (na + nb) * part - 1e-6
            left, right = np.nonzero((ga != gb) & (la >= need) & (lb >= need))
            left, right = left + i, right + j
            if a is b:
                left, right = left[left < right], right[left < right]
            for at in range(0, len(left), VERIFY):
                x, y = left[at : at + VERIFY], right[at : at + VERIFY]
                unknown = ~(a.marked[x] & b.marked[y])
                x, y = x[unknown], y[unknown]
                most = (a.sizes[x] + b.sizes[y]) * (1 - 2 * part) + 1e-5
                near = np.bitwise_count(a.bits[x] ^ b.bits[y]).sum(axis=1, dtype=np.int64) <= most
                x, y = x[near], y[near]
                if len(x):
                    same = (a.low[x][:, :, None] == b.low[y][:, None, :]).any(axis=2)
                    shared = a.low[x][np.arange(len(x)), same.argmax(axis=1)]
                    here = ~same.any(axis=1) | (shared == np.uint64(tile)) | (shared == 0)  # zero fills short rows
                    a.marked[x[here]] = True
                    b.marked[y[here]] = True


def _folded(wide: np.ndarray, words: int) -> np.ndarray:
    """Parities in 64 * words classes, a row each, from those in some multiple of that."""
    return np.stack([np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x in wide])


def _mark_wide(a: _Side, b: _Side, similarity: float) -> None:
    """Marks both documents of every pair of two groups that sizes and wide parities do not prove to be less similar."""
    part = similarity / (1 + similarity)
    for wa, wb in product(np.unique(a.words).tolist(), np.unique(b.words).tolist()):
        words, ia, ib = min(wa, wb), np.flatnonzero(a.words == wa), np.flatnonzero(b.words == wb)
        step = max(1, min(STEP, (1 << 20) // max(wa, wb)))
        for i, j in product(range(0, len(ia), step), range(0, len(ib), step)):
            x, y = ia[i : i + step], ib[j : j + step]
            na, nb = a.sizes[x, None], b.sizes[None, y]
            fits = (a.groups[x, None] != b.groups[None, y]) & (np.minimum(na, nb) >= (na + nb) * part - 1e-6)
            if a is b:
                fits &= x[:, None] < y[None, :]
            if not fits.any():
                continue
            left, right, most = _folded(a.wide[x], words), _folded(b.wide[y], words), (na + nb) * (1 - 2 * part) + 1e-5
            for r in np.flatnonzero(fits.any(axis=1)).tolist():
                c = np.flatnonzero(fits[r])
                c = c[np.bitwise_count(left[r] ^ right[c]).sum(axis=1, dtype=np.int64) <= most[r, c]]
                if len(c):
                    a.marked[x[r]] = True
                    b.marked[y[c]] = True


def _marked(dealt: DataFrame, sides, mark) -> DataFrame:
    """tile, blk, role, node: the documents that mark() marks, members (0) and probes (1) of each block of dealt rows.

    sides(batch) gives a function that makes a _Side of a stretch of the batch; mark(a, b, number) gets the number of the last column too."""
    dealt = dealt.repartition("tile", "blk").sortWithinPartitions("tile", "blk", "role")
    schema = pa.schema([("tile", pa.int64()), ("blk", pa.int64()), ("role", pa.int32()), ("node", pa.int64())])

    def run(batches):
        forget_state()
        key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            tile, blk, role, base = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, batch.num_columns - 1))
            side = None
            starts = np.concatenate([[0], np.flatnonzero((tile[1:] != tile[:-1]) | (blk[1:] != blk[:-1])) + 1, [len(tile)]])
            out = []
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                goes_on = key == (tile[s], blk[s])
                if not goes_on:
                    key, held = (tile[s], blk[s]), []
                if not goes_on and e - s == 1 and e < len(tile):
                    continue
                side = side or sides(batch)
                members, number = s + int(np.searchsorted(role[s:e], 1)), int(base[s]) % (1 << 64)
                new, probes = side(s, members), side(members, e)
                before = [x.marked.copy() for x in held]
                for x in [*held, new] if blk[s] <= 0 else []:
                    mark(x, new, number)
                held.append(new)
                before.append(np.zeros(len(new.nodes), bool))
                for x in held:
                    mark(x, probes, number)
                fresh = [x.nodes[x.marked & ~old] for x, old in zip(held, before, strict=True)]
                for r, nodes in ((0, np.concatenate(fresh)), (1, probes.nodes[probes.marked])):
                    if len(nodes):
                        out.append((np.full(len(nodes), tile[s]), np.full(len(nodes), blk[s]), np.full(len(nodes), r), nodes))
            if out:
                t, k, r, nodes = (np.concatenate(x) for x in zip(*out, strict=True))
                yield batch_of(schema, tile=t, blk=k, role=r, node=nodes)

    return dealt.mapInArrow(run, "tile long, blk long, role int, node long")


def candidates(spread: DataFrame, radius: int, similarity: float, block: int = BLOCK) -> DataFrame:
    """tile, blk, role, node: the documents of each block that are in a pair that may be similar, members (0) and probes (1)."""

    def sides(batch):
        f, n, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 6))
        f = f.astype(np.int64).view(np.uint64)
        sketch, low = _sketches(batch.column(5))
        return lambda i, j: _Side(n[i:j], np.bitwise_count(f[i:j]), fps=f[i:j], sizes=size[i:j], sketches=sketch[i:j], low=low[i:j])

    return _marked(_split_hot(spread, block), sides, lambda a, b, tile: _mark(a, b, tile, radius, similarity))


def common_hashes(docs: DataFrame, shingle: int) -> np.ndarray:
    """Hashes of shingles that FREQUENT different texts of a sample hold, the most frequent last."""
    ids = texts(docs).where("doc_id is not null")
    total, space = ids.count(), 1 << 40
    if total > SAMPLE:
        ids = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(space)) < int(space * SAMPLE / total))
    schema = pa.schema([("hash", pa.int64())])

    def run(batches):
        for (sets,) in rows_of(batches, "hashes"):
            yield batch_of(schema, hash=np.frombuffer(b"".join(sets), "<i8"))

    sets = shingle_sets(ids, shingle, "mark", "hashes").dropDuplicates(["mark"])
    counted = sets.select("hashes").mapInArrow(run, "hash long").groupBy("hash").count().where(F.col("count") >= FREQUENT)
    best = counted.orderBy(F.desc("count"), "hash").limit(MOST_FREQUENT).toArrow()
    return best.column("hash").to_numpy()[::-1].astype(np.int64).view(np.uint64)


def led(nodes: DataFrame) -> DataFrame:
    """tile, node, place, size, component: a row for each leading shingle of a document (tile) and its place among them."""
    schema = pa.schema([("tile", pa.int64()), ("node", pa.int64()), ("place", pa.int64()), ("size", pa.int64()), ("component", pa.int64())])

    def run(batches):
        forget_state()
        for nodes, sizes, groups, leads in rows_of(batches, "node", "size", "component", "lead"):
            n = np.array([len(x) // 8 for x in leads], np.int64)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            nodes, sizes, groups = (np.repeat(np.array(x, np.int64), n) for x in (nodes, sizes, groups))
            yield batch_of(schema, tile=np.frombuffer(b"".join(leads), "<i8"), node=nodes, place=place, size=sizes, component=groups)

    return nodes.select("node", "size", "component", "lead").mapInArrow(run, "tile long, node long, place long, size long, component long")


def _worth(tile, place, size, group, similarity: float, small: int) -> np.ndarray:
    """Which rows of whole tiles are in a pair of two groups that sizes and places allow to be similar; rows of tiles beyond `small` all count."""
    starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    length = np.diff(np.append(starts, len(tile)))
    mixed = np.minimum.reduceat(group, starts) != np.maximum.reduceat(group, starts)
    good = np.repeat(mixed & (length > small), length)
    at = np.flatnonzero(np.repeat(mixed & (length <= small), length))
    for step in range(1, small):
        at = at[at + step < len(tile)]
        at = at[tile[at] == tile[at + step]]
        if not len(at):
            break
        to = at + step
        need = (size[at] + size[to]) * (similarity / (1 + similarity)) - 1e-6
        fits = (group[at] != group[to]) & (size[at] - place[at] >= need) & (size[to] - place[to] >= need)
        good[at[fits]] = good[to[fits]] = True
    return good


def mixed_tiles(rows: DataFrame, similarity: float, parts: int, small: int = SMALL_TILE, most: int = LONG_TILE) -> DataFrame:
    """The rows of led(), dealt to `parts` tasks, that share their tile with one of another group that may be similar by sizes and places."""

    def run(batches):
        forget_state()
        held, long = None, None
        for batch in chain(batches, [None]):
            if batch is not None and not batch.num_rows:
                continue
            whole = batch if held is None else held if batch is None else pa.concat_batches([held, batch])
            if whole is None:
                continue
            tile, _, place, size, group = (x.to_numpy(zero_copy_only=False) for x in whole.columns)
            last = len(tile) if batch is None else int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
            if len(tile) - last > most:
                long, last = tile[-1], len(tile)
            held = whole.slice(last) if last < len(tile) else None
            if last:
                good = _worth(tile[:last], place[:last], size[:last], group[:last], similarity, small)
                if long is not None:
                    good |= tile[:last] == long
                yield whole.slice(0, last).filter(pa.array(good))

    return rows.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(run, rows.schema)


def possible(rows: DataFrame, signed: DataFrame, similarity: float, block: int = BLOCK) -> DataFrame:
    """tile, blk, role, node: the documents that are in a pair of two groups which signatures (node, bits, lead) do not rule out."""
    dealt = _split_hot(rows.select("tile", F.lit(0).alias("role"), F.col("node").alias("fp"), "node", "place", "size", "component"), block)
    dealt = dealt.join(signed.select("node", "bits", F.expr(f"substring(lead, 1, {8 * HEAD})").alias("head")), "node")

    def sides(batch):
        n, place, size, group = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5, 6))
        bits = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint64).reshape(len(n), -1)
        low = np.frombuffer(b"".join(x.ljust(8 * HEAD, b"\0") for x in batch.column(8).to_pylist()), "<u8").reshape(len(n), HEAD)
        return lambda i, j: _Side(n[i:j], size[i:j], sizes=size[i:j], places=place[i:j], groups=group[i:j], bits=bits[i:j], low=low[i:j])

    dealt = dealt.select("tile", "blk", "role", "node", "place", "size", "component", "bits", "head", F.col("tile").alias("base"))
    return _marked(dealt, sides, lambda a, b, tile: _mark_possible(a, b, tile, similarity))


def narrowed(found: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """What is left of possible() by wide parities (signed: node, size, component, wide)."""

    def sides(batch):
        n, size, group = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5))
        wide = np.empty(len(n), object)
        for i, x in enumerate(batch.column(6).to_pylist()):
            wide[i] = np.frombuffer(x, np.uint64)
        words = np.array([len(x) for x in wide], np.int64)
        return lambda i, j: _Side(n[i:j], size[i:j], sizes=size[i:j], groups=group[i:j], wide=wide[i:j], words=words[i:j])

    dealt = found.join(signed.select("node", "size", "component", "wide"), "node")
    dealt = dealt.select("tile", "blk", "role", "node", "size", "component", "wide", F.col("tile").alias("base"))
    return _marked(dealt, sides, lambda a, b, tile: _mark_wide(a, b, similarity))


class _Sets:
    """Some documents' whole shingle sets: their hashes end to end, whose each is, and how many each has."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray]) -> None:
        self.nodes, self.sizes = nodes, np.array([len(h) for h in sets], np.int64)
        self.hashes, self.owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        self.distinct = np.unique(self.hashes)

    def rows(self, shared: np.ndarray):
        """Row and column of each hash that is in `shared` (ascending), by column."""
        at = np.searchsorted(shared, self.hashes)
        inside = at < len(shared)
        inside[inside] = shared[at[inside]] == self.hashes[inside]
        row, column = self.owner[inside], at[inside]
        order = np.argsort(column, kind="stable")
        return row[order], column[order]


def similar_pairs(a: _Sets, b: _Sets, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose whole sets have a Jaccard similarity of at least `similarity`; common hashes are counted by matrix products."""
    shared = np.intersect1d(a.distinct, b.distinct, assume_unique=True)
    common = np.zeros((len(a.nodes), len(b.nodes)), np.int64)
    (ra, ca), (rb, cb) = a.rows(shared), b.rows(shared)
    for at in range(0, len(shared), COLUMNS):
        tables = []
        for row, column, n in ((ra, ca, len(a.nodes)), (rb, cb, len(b.nodes))):
            i, j = np.searchsorted(column, [at, at + COLUMNS])
            tables.append(np.zeros((n, min(COLUMNS, len(shared) - at)), np.float32))
            tables[-1][row[i:j], column[i:j] - at] = 1
        common += (tables[0] @ tables[1].T).astype(np.int64)
    either = a.sizes[:, None] + b.sizes[None, :] - common
    return np.nonzero(common >= similarity * either - 1e-9)


def exact_links(found: DataFrame, sets: DataFrame, similarity: float, set_rows: int = SET_ROWS) -> DataFrame:
    """Links (a, b) between the documents of a block whose whole shingle sets are similar: every pair not joined yet in the block is compared.

    A column component of `found` names groups that are joined already."""
    group = F.col("component") if "component" in found.columns else F.col("node")
    joined = found.join(sets, found.node == sets.doc_id).select("tile", "blk", "role", "node", "hashes", group.alias("component"))
    dealt = joined.repartition("tile", "blk").sortWithinPartitions("tile", "blk", "role")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        forget_state()
        key, held, nodes, sets, size, root = None, [], [], [], 0, {}

        def find(x):
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root[up]
            return x

        def judge(role):
            """Links of the documents at hand among themselves (members) and with the members before them."""
            new, links = _Sets(nodes, sets), []
            for side in held if role == 1 else [*held, new] if key[1] <= 0 else []:
                if len({find(x) for x in side.nodes} | {find(x) for x in new.nodes}) == 1:
                    continue
                for i, j in zip(*(x.tolist() for x in similar_pairs(side, new, similarity)), strict=True):
                    a, b = find(side.nodes[i]), find(new.nodes[j])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        links.append((side.nodes[i], new.nodes[j]))
            if role == 0:
                held.append(new)
            return links

        for batch in batches:
            out = []
            for tile, blk, role, node, data, group in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if nodes and (key != (tile, blk, role) or size >= SET_HASHES or len(nodes) >= set_rows):
                    out += judge(key[2])
                    nodes, sets, size = [], [], 0
                if key is None or key[:2] != (tile, blk):
                    held, root = [], {}
                key = (tile, blk, role)
                root.setdefault(node, root.setdefault(group, group))
                nodes.append(node)
                sets.append(np.frombuffer(data, "<u8"))
                size += len(sets[-1])
            if out:
                yield batch_of(schema, a=[x for x, _ in out], b=[x for _, x in out])
        out = judge(key[2]) if nodes else []
        if out:
            yield batch_of(schema, a=[x for x, _ in out], b=[x for _, x in out])

    return dealt.mapInArrow(run, "a long, b long")


def refined(nodes: DataFrame, block: int) -> DataFrame:
    """tile, role, fp, node, sketch, size, base: each document in the tiles of its smallest hashes (base).

    A hash that over `block` documents have among their smallest makes no tile by itself but one with each of the document's other smallest hashes, so
    a line that very many texts share gathers only those that share more.  (Sets of up to TILES hashes that are similar and not equal share two at least.)"""
    spread = nodes.select(F.explode("low").alias("tile"), F.lit(0).alias("role"), "fp", "node", "sketch", "size", "low")
    hot = cut(spread.groupBy("tile").count().where(F.col("count") > block).select("tile", F.lit(True).alias("hot")))
    others = F.filter("low", lambda x: x != F.col("tile"))
    tiles = F.when(F.col("hot"), F.transform(others, lambda x: F.xxhash64("tile", x))).otherwise(F.array("tile"))
    return _looked_up(spread, hot).select(F.explode(tiles).alias("_tile"), "role", "fp", "node", "sketch", "size", F.col("tile").alias("base")).withColumnRenamed("_tile", "tile")


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, block: int = BLOCK, set_rows: int = SET_ROWS) -> DataFrame:
    """doc_id, component_id: documents linked by a shingle overlap (Jaccard of the sets of distinct shingles) of at least `similarity`.

    Exact: every such link is found, in two steps.  Both decide each link by the whole shingle sets of the two documents.

    First, quickly, nearly all of them.  At the radius this needs (the expected distance at that overlap and DEVIATIONS deviations more) population
    counts alone rule out little, so a tile holds documents that have one of their TILES smallest shingle hashes in common (two of them where one is very common, see refined).
    Inside a tile the comparison is the same blocked exclusive-or with the same skipping rule; near pairs of fitting sizes whose sketches come within DEVIATIONS deviations of the
    similarity are candidates, in the first tile they share.  The whole shingle sets of a block's candidates are brought to
    it and compared, all pairs not joined there yet.

    Then what that may miss: links between two of the groups so formed.  A tile holds all documents that have a leading shingle in common (see leading: two
    similar documents always do), whatever their number; tiles of one group alone are left out.  Pairs of two groups are ruled out only by what proves them less similar: their sizes, the
    places of the shingle they share, and the exclusive-or of their PARITIES, then of their wide ones.  All others are compared as before.

    Documents with equal shingle sets (exact copies are) are one node.  A text without words is alone.
    """
    angle = math.acos(2 * similarity / (1 + similarity)) / math.pi
    radius = min(64, math.ceil(64 * angle + DEVIATIONS * math.sqrt(64 * angle * (1 - angle))))
    facts = ("mark", "fp", "low", "sketch", "size", "lead", "bits", "wide")
    marked = shingle_sets(docs, shingle, *facts, similarity=similarity, common=common_hashes(docs, shingle))
    nodes = marked.where("size > 0").groupBy(*facts).agg(F.min("doc_id").alias("node")).where("node is not null")
    nodes = cut(nodes)

    def links(found):
        chosen = cut(found.select(F.col("node").alias("doc_id")).distinct())
        wanted = texts(docs).join(F.broadcast(chosen) if is_small(chosen) else chosen, "doc_id", "left_semi")
        return exact_links(found, shingle_sets(wanted, shingle, "hashes").dropDuplicates(["doc_id"]), similarity, set_rows)

    groups = cut(components(links(cut(candidates(refined(nodes, block), radius, similarity, block)))))
    grouped = nodes.join(F.broadcast(groups) if is_small(groups) else groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    n_led = nodes.agg(F.coalesce(F.sum(F.length("lead")), F.lit(0))).first()[0] // 8
    rows = cut(mixed_tiles(led(grouped), similarity, max(n_led // LED_ROWS + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    found = cut(narrowed(cut(possible(rows, nodes, similarity, block)), grouped, similarity))
    more = cut(links(found.join(grouped.select("node", "component"), "node")))
    if not more.isEmpty():
        groups = components(more.union(groups.select("node", "component")))
    named = nodes.join(groups, "node", "left").select("mark", F.coalesce("component", "node").alias("component_id"))
    return shingle_sets(docs, shingle, "mark").join(named, "mark", "left").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))
