"""Near-duplicate, substring and suffix-array operators against brute force."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tidewise.llm import anchors, common, simhash, substring, sufarray


def frame(spark, rows):
    data = [(i, t, "a", t, 1.0) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, h string, hs string, component double").repartition(3)


def corpus(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(400)]
    passage = [" ".join(r.choices(words, k=k)) for k in (25, 40, 70)]
    rows = []
    for i in range(n):
        parts = [" ".join(r.choices(words, k=r.randint(0, 60)))]
        for p in r.sample(passage, r.randint(0, 2)):
            cut = r.randint(0, 30)
            parts += [p[cut:], " ".join(r.choices(words, k=r.randint(0, 20)))]
        if r.random() < 0.1:
            parts.append("la " * r.randint(10, 120))
        rows.append((i * 3, r.choice(["\n", " ", "\t "]).join(parts)))
    rows += [(1000 + i, rows[i][1]) for i in range(6)]
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "x"), (2004, "漢字 " * 300)]
    return rows


def brute_substring(rows, w):
    seen, out = {}, {}
    split = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(split):
        ws = split[i]
        gone = set()
        for s in range(len(ws) - w + 1):
            key = tuple(ws[s : s + w])
            if key in seen:
                gone.update(range(s, s + w))
            else:
                seen[key] = (i, s)
        kept = b" ".join(x for j, x in enumerate(ws) if j not in gone)
        out[i] = (len(ws), len(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("window", [20, 7])
def test_substring_matches_brute_force(spark, window):
    rows = corpus(1)
    for hot, run in ((3, 4096), (20_000, 7)):
        got = substring.dedup(frame(spark, rows), window=window, gram=5, hot=hot, run_windows=run, piece=1 << 19 if hot == 3 else 40).collect()
        assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_substring(rows, window)
    got = substring.dedup(frame(spark, rows), window=window, gram=5, detail=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_substring(rows, window)
    text = {i: (t or "").split() for i, t in rows}
    for r in got:
        for f in r.factors:
            assert f.words >= window and (f.ref_doc, f.ref_start) < (r.doc_id, f.start)
            assert text[r.doc_id][f.start : f.start + f.words] == text[f.ref_doc][f.ref_start : f.ref_start + f.words]


def test_substring_odd_rows(spark):
    long = " ".join(str(i % 977) for i in range(30_000))
    rows = [(None, long), (None, None), (7, long), (7, long), (8, long)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring.dedup(frame(spark, rows)).collect())
    inner = 30_000 - 977  # all but the first period repeat within the text
    assert got == [(-1, 0, 0), (-1, 30_000, 0), (7, 30_000, inner), (7, 30_000, inner), (8, 30_000, 30_000)]
    assert substring.dedup(frame(spark, [])).count() == 0


def test_a_text_longer_than_a_piece(spark):
    r = random.Random(20)
    long = [r.choice("abcdefghij") * r.randint(1, 3) + str(r.randint(0, 9000)) for _ in range((1 << 19) + 4000)]
    middle = (1 << 19) - 30  # the passage lies across the first piece's end
    rows = [(1, " ".join(long)), (2, "one two " + " ".join(long[middle : middle + 60])), (3, "x " * 5)]
    got = {x.doc_id: x for x in substring.dedup(frame(spark, rows)).collect()}
    assert [got[i].n_removed for i in (1, 2, 3)] == [0, 60, 0]
    cut = {x.doc_id: x for x in sufarray.dedup(frame(spark, rows), detail=True).collect()}
    size = len(" ".join(long[middle : middle + 60]))
    assert size <= cut[1].n_removed <= size + 2 and cut[2].n_removed == cut[1].n_removed


def test_substring_equals_its_sql(spark):
    import duckdb

    from tidewise.llm import queries

    path = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = connection.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({queries.SQL['op4_substring']})").fetchall()
    got = queries.op4_substring(spark, path).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def brute_bytes(rows, k):
    where = {}
    data = {n: (t or "").encode() for n, (_, t) in enumerate(rows)}
    for n, d in data.items():
        for s in range(len(d) - k + 1):
            where.setdefault(d[s : s + k], []).append((n, s))
    gone = {n: np.zeros(len(d), bool) for n, d in data.items()}
    for places in where.values():
        if len(places) > 1:
            for n, s in places:
                gone[n][s : s + k] = True
    out = []
    for n, d in data.items():
        g = gone[n]
        spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~g])
        out.append((rows[n][0], len(d), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("hot", "block", "run"), [(20_000, 1 << 20, 1024), (3, 1 << 10, 1024), (1, 300, 9), (50, 2000, 3)])
def test_suffix_array_matches_brute_force(spark, hot, block, run):
    rows = corpus(2)
    got = sufarray.dedup(frame(spark, rows), length=100, gram=16, hot=hot, block=block, run_windows=run, piece=1 << 19 if run > 9 else 150)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()) == brute_bytes(rows, 100)


def test_suffix_array_odd_rows(spark):
    rows = [(None, "q" * 900), (3, "q" * 250), (4, None), (5, "z" * 199), (6, "z" * 200), (9, "ab" * 150), (9, "ab" * 150)]
    got = sufarray.dedup(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_removed, r.n_spans) for r in got) == [(-1, 0, 0), (3, 250, 1), (4, 0, 0), (5, 0, 0), (6, 0, 0), (9, 300, 1), (9, 300, 1)]
    assert sufarray.dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_interval_expansion_finds_the_repeated_strings(seed):
    r = np.random.default_rng(seed)
    base = r.integers(1, 4, 300)
    text = np.concatenate([base, r.integers(1, 5, 200), base[50:200], np.full(40, 2), base[:30]]).astype(np.int32)
    for k in (1, 3, 12, 40):
        padded = [tuple(text[i : i + k]) + ("end",) * (k - len(text[i : i + k])) for i in range(len(text))]
        want = [padded.count(x) > 1 for x in padded]
        assert sufarray.repeated_starts(text, k).tolist() == want


@pytest.mark.parametrize("hot", [3, 20_000])
def test_anchor_filter_keeps_every_repeated_anchor(spark, hot):
    rows = corpus(3)
    scheme = anchors.Scheme(20, 5, words=True)
    docs = common.texts(frame(spark, rows))
    totals, held = {}, {}
    for i, t in rows:
        for pack in anchors.packs(scheme, [(t or "").encode()]):
            g, m = anchors.minima(scheme, pack)
            chosen = {p for s in range(len(m)) if m[s] for p in range(s, s + scheme.span) if g[p] == m[s]}
            for p in chosen:
                totals[int(g[p])] = totals.get(int(g[p]), 0) + 1
                held.setdefault(i, set()).add(int(g[p]))
    want = {i: {h for h in hs if totals[h] > 1} for i, hs in held.items()}
    got = anchors.with_repeated(docs, scheme, hot).collect()
    assert {r.doc_id: {h & (1 << 64) - 1 for h in r.hs} for r in got if r.hs} == {i: hs for i, hs in want.items() if hs}
    many = {h for h in totals if sum(h in hs for hs in want.values()) > hot}
    assert {h & (1 << 64) - 1 for r in got for h in r.hot or ()} == many


def test_settled_rows_pass_and_pending_ones_wait():
    import pyarrow as pa

    def batch(*rows):
        return pa.RecordBatch.from_pydict({k: [r[i] for r in rows] for i, k in enumerate(("h", "doc_id", "c"))}, schema=anchors._ANCHOR)

    batches = [batch((1, 10, 1), (2, 11, 1)), batch((2, 12, 1), (2, 13, 0), (3, 14, 2)), batch((4, 15, 0)), batch((5, 16, 1)), batch((5, 17, 1), (6, 18, 1))]
    got = [(d, h) for b in anchors._keep_repeated(iter(batches)) for d, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert sorted(got) == [(11, 2), (12, 2), (13, 2), (14, 3), (15, 4), (16, 5), (17, 5)]


def brute_fp(text, k):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps, radius):
    root = {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= radius:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in fps}


def test_simhash_matches_brute_force(spark):
    rows = corpus(4)
    r = random.Random(9)
    rows += [(3000 + i, rows[i][1].replace("a", "a", 1) + r.choice(["", " zz"])) for i in range(20)]
    got = simhash.near_duplicates(frame(spark, rows), 3, 2).collect()
    assert sorted(got) == sorted(simhash.near_duplicates(frame(spark, rows), 3, 2, block=3, step=2).collect())
    fps = {i: brute_fp(t, 3) for i, t in rows}
    assert {x.doc_id: x.fp & (1 << 64) - 1 for x in got} == fps
    assert {x.doc_id: x.component_id for x in got} == brute_components(fps, 2)


@pytest.mark.parametrize(("block", "step"), [(4096, 1024), (5, 3)])
def test_tiles_lose_no_link(spark, block, step):
    r = random.Random(5)
    centres = [r.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centres for _ in range(50)} | {0, 1, (1 << 64) - 1}
    fps = dict(enumerate(sorted(fps)))
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in fps.items()], "fp long, node long")
    links = simhash.compare_tiles(simhash.tiles_by_counts(df, 2), 2, block, step)
    found = {x.node: x.component for x in common.components(links).collect()}
    assert {i: found.get(i, i) for i in fps} == brute_components(fps, 2)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


def test_similar_groups_join_near_copies_only(spark):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    rows = []
    for g in range(12):
        base = r.choices(words, k=300)
        for c in range(4):
            near = base.copy()
            for at in r.sample(range(300), c):
                near[at] = r.choice(words)
            rows.append((g * 10 + c, " ".join(near)))
    rows += [(900, None), (901, ""), (902, "one"), (903, "one")]
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(frame(spark, rows)).collect()}
    assert got == {i: (i // 10 * 10 if i < 900 else 902 if i > 901 else i) for i, _ in rows}


def test_simhash_odd_rows(spark):
    got = simhash.near_duplicates(frame(spark, [(None, "a b"), (None, "c d e f"), (4, "A  B"), (4, "a b"), (6, None)])).collect()
    assert sorted((x.doc_id or -1, x.component_id or -1) for x in got) == [(-1, -1), (-1, 4), (4, 4), (4, 4), (6, 6)]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
    long = " ".join(str(i * 7 % 1009) for i in range(60_000))
    got = {x.doc_id: (x.fp & (1 << 64) - 1, x.component_id) for x in simhash.near_duplicates(frame(spark, [(1, long), (2, long + " end")])).collect()}
    assert got == {1: (brute_fp(long, 3), 1), 2: (brute_fp(long + " end", 3), 1)}


@pytest.mark.parametrize("block", [4096, 7])
def test_similar_groups_equal_brute_force_around_the_threshold(spark, block):
    """Long texts at overlaps of 0.7 to 0.9, where an estimate from some of the shingles would be wrong for many."""
    r = random.Random(11)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    rows = []
    for g in range(60):
        base = r.choices(words, k=r.choice([90, 300, 1200]))
        share = 0.7 + 0.2 * g / 59
        new = round(len(base) * (1 - share) / (1 + share))  # so many words replaced at the end give about this overlap
        rows += [(g * 10, " ".join(base)), (g * 10 + 1, " ".join(base[: len(base) - new] + r.choices(words, k=new)))]
    rows += [(2000 + i, "one line that many texts share " + " ".join(r.choices(words, k=80))) for i in range(30)]
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {" ".join(w[k : k + 5]) for k in range(len(w) - 4)}
    near = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a, b in combinations(sets, 2)}
    assert sum(0.7 < x < 0.8 for x in near.values()) > 20 and sum(0.8 <= x < 0.9 for x in near.values()) > 20
    want = {i: i for i in sets} | {b: a for (a, b), x in near.items() if x >= 0.8}
    got = {x.doc_id: x.component_id for x in simhash.similar_groups(frame(spark, rows), block=block, set_rows=3).collect()}
    assert got == want


def spoilt(r, base, places, words):
    """base with other words at the given places."""
    out = base.copy()
    for at in places:
        out[at] = r.choice(words)
    return out


def test_similar_groups_link_texts_without_a_common_smallest_shingle(spark):
    """Similar texts that share none of their smallest shingle hashes, or just one that more texts than a block hold."""
    r = random.Random(17)
    words = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4000)]
    grams = lambda w: [" ".join(w[k : k + 5]) for k in range(len(w) - 4)]
    low = lambda w: sorted({xxhash.xxh64_intdigest(g, 42) for g in grams(w)})[: simhash.TILES]

    def pair(shared):
        while True:
            base = r.choices(words, k=400)
            at = {xxhash.xxh64_intdigest(g, 42): k for k, g in enumerate(grams(base))}
            other = spoilt(r, base, [at[h] + 2 for h in low(base)[shared:]], words)
            if len(set(low(base)) & set(low(other))) == shared:
                return base, other, at

    rows, want = [], {}
    for g in range(4):
        base, other, at = pair(g % 2)
        rows += [(g * 100, " ".join(base)), (g * 100 + 1, " ".join(other))]
        want |= {g * 100: g * 100, g * 100 + 1: g * 100}
        if g % 2:  # the one hash they share becomes a very common one for a block of 3
            line = base[at[low(base)[0]] :][:5]
            for i in range(8):
                rows.append((g * 100 + 10 + i, " ".join(line + r.choices(words, k=2))))
                want[g * 100 + 10 + i] = g * 100 + 10 + i
    for block in (4096, 3):
        got = {x.doc_id: x.component_id for x in simhash.similar_groups(frame(spark, rows), block=block, set_rows=3).collect()}
        assert got == want


@pytest.mark.parametrize(("block", "small", "most", "batch"), [(4096, 64, 1 << 16, 10_000), (5, 2, 6, 4)])
def test_leading_shingles_lose_no_link(spark, block, small, most, batch):
    """The second step alone, from every document as its own group, with frequent lines, equals brute force."""
    r = random.Random(23)
    words = ["".join(r.choice("abcd") for _ in range(3)) for _ in range(50)]
    lines = [r.choices(words, k=12) for _ in range(4)]
    sets = {}
    for g in range(70):
        base = r.choice(lines) + r.choices(words, k=r.choice([0, 3, 9, 40, 150])) + r.choice(lines)
        for c in range(3):
            w = spoilt(r, base, r.sample(range(len(base)), r.randint(0, 2)), words) + r.choices(words, k=r.randint(0, 3))
            sets[g * 10 + c] = np.unique(simhash.shingle_hashes([x.encode() for x in w], 5))
    want = {(a, b) for a, b in combinations(sets, 2) if len(np.intersect1d(sets[a], sets[b])) >= 0.8 * len(np.union1d(sets[a], sets[b])) - 1e-9}
    assert len(want) > 40
    count = dict(zip(*np.unique(np.concatenate(list(sets.values())), return_counts=True), strict=True))
    common = np.array(sorted((h for h, n in count.items() if n > 20), key=count.get), np.uint64)
    lead = {i: simhash.leading(h, 0.8, simhash.by_hash(common)) for i, h in sets.items()}
    assert all(set(lead[a].tolist()) & set(lead[b].tolist()) for a, b in want)
    wide = lambda h: simhash.parities(h, 512 if len(h) < 100 else 1024)
    data = [(i, len(h), i, lead[i].astype("<u8").tobytes(), simhash.parities(h, 512), wide(h)) for i, h in sets.items()]
    nodes = spark.createDataFrame(data, "node long, size long, component long, lead binary, bits binary, wide binary")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    found = {}
    try:
        rows = simhash.mixed_tiles(simhash.led(nodes), 0.8, 3, small, most)
        for x in simhash.narrowed(simhash.possible(rows, nodes, 0.8, block), nodes, 0.8).collect():
            found.setdefault((x.tile, x.blk), set()).add(x.node)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    met = {p for s in found.values() for p in combinations(sorted(s), 2)}
    assert want <= met


def test_exact_links_join_groups_whose_first_document_is_elsewhere(spark):
    sets = {i: np.arange(i, i + 100, dtype="<u8").tobytes() for i in (2, 3, 5, 60)}
    found = spark.createDataFrame([(7, 0, 0, i, g) for i, g in ((2, 1), (3, 1), (5, 4), (60, 60))], "tile long, blk long, role int, node long, component long")
    got = simhash.exact_links(found, spark.createDataFrame(list(sets.items()), "doc_id long, hashes binary"), 0.8, 1).collect()
    assert len(got) == 1 and got[0].b + got[0].a in (7, 8)  # one link of 2 or 3 with 5, none within a group
