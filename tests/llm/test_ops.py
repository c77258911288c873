"""Tokens, models, search, decontamination and the pipeline against libraries, brute force and held-out accuracy."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewise.llm import ann, bpe, decontam, lm, quality, queries, tokenids, toxicity

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n  x", "a" * 3000, "ab" * 900 + "!", "漢字😀" * 50, "don't  STOP\t now 12345 <|endoftext|> ñandú", "é" * 9, "x\x00y\x85z", "word, word. word., 's 't"]


def frame(spark, rows, more="a string, h long"):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], f"doc_id long, text string, {more}").repartition(2)


def test_merge_equals_the_library():
    coder = bpe.Codec.load(RANKS, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    r = random.Random(0)
    for text in [t for t in ODD if t] + ["".join(r.choice("ab  \n\tcé漢😀1.!aaAz'") for _ in range(r.randint(0, 70))) for _ in range(400)]:
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_cache_generations_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    coder, whole = bpe.Codec.load(RANKS, P.PATTERN), bpe.Codec.load(RANKS, P.PATTERN)
    text = "some words come again and some words do not come again"
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 1000)
    expected = whole.encode(text)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    assert coder.encode(text) == expected == coder.encode(text)


def test_encode_and_decode_documents(spark):
    rows = list(enumerate(ODD)) + [(None, "null id"), (3, ODD[3])]
    got = bpe.encode_documents(frame(spark, rows), RANKS, P.PATTERN)
    table = got.collect()
    assert len(table) == len(rows)
    for r in table:
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decode_documents(got, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "") for i, t in rows}


@pytest.mark.parametrize("cache", [400_000, 4])
def test_token_files(spark, monkeypatch, tmp_path, cache):
    r = random.Random(2)
    rows = list(enumerate(ODD)) + [(100 + i, " ".join(r.choice(["the", "Cat,", "sat.", "Über", "don't", "x9"]) for _ in range(r.randint(0, 30)))) for i in range(40)]
    path = str(tmp_path / "t")
    tokenids.write_tokens(frame(spark, rows), WORDS, path, block_docs=3, block_tokens=100_000 if cache > 4 else 20)
    assert spark.read.parquet(path).count() >= len(rows) // 3
    got = {x.doc_id: x for x in tokenids.read_tokens(spark, path, with_ids=True).collect()}
    library, at = Tokenizer.from_file(WORDS), 0
    for i, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[i].ids == ids and got[i].start == at and got[i].n_tokens == len(ids)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert tokenids.read_document(spark, path, 103) == [got[103].ids]
    encoder = tokenids.WordEncoder(WORDS)
    monkeypatch.setattr(tokenids, "WORD_CACHE", cache)
    texts = [t for _, t in rows]
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_dictionary_samples_come_from_whole_documents(spark, tmp_path):
    ids = np.arange(100_000, dtype="<u4").tobytes()
    parts = tokenids.spread_pieces(ids)
    assert len(parts) == tokenids.SAMPLE_PIECES and parts[0] == ids[: len(parts[0])] and parts[-1] == ids[-len(parts[-1]) :]
    assert b"".join(tokenids.spread_pieces(ids[:9000])) == ids[:9000]
    rows = [(i, " ".join(f"word{i * j % 97}" for j in range(120))) for i in range(300)]
    path = str(tmp_path / "t")
    tokenids.write_tokens(frame(spark, rows), WORDS, path)
    kept = spark.read.parquet(f"{path}-dictionary").first()
    assert 0 < len(kept.dictionary) <= tokenids.DICTIONARY_BYTES
    library = Tokenizer.from_file(WORDS)
    assert tokenids.read_document(spark, path, 299) == [[*library.encode(rows[299][1], add_special_tokens=False).ids, 2]]
    assert tokenids.read_document(spark, path, 999) == []


def test_token_files_of_nothing_and_of_repeats(spark):
    assert tokenids.tokenize_to_files(frame(spark, []), WORDS).count() == 0
    got = tokenids.tokenize_to_files(frame(spark, [(4, "a b"), (4, "a b"), (None, None)]), WORDS).collect()
    assert sorted((x.doc_id or -1, x.start, x.n_tokens) for x in got) == [(-1, 0, 1), (4, 1, 3), (4, 4, 3)]


def distance(a, b):
    """Least edits between a and any substring of b, by the plain recurrence."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers_equals_the_recurrence():
    r = random.Random(4)
    for _ in range(150):
        a, b = "".join(r.choice("abc") for _ in range(r.randint(1, 80))), "".join(r.choice("abc") for _ in range(r.randint(0, 90)))
        assert decontam.myers(a, b, len(a)) == distance(a, b)


def test_decontamination_equals_brute_force(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(r.randint(8, 30)))) for i in range(12)] + [(90, None), (91, ""), (92, "short"), (93, "a"), (94, "two words"), (3, "an item under a number that is used twice, for sure")]
    rows = []
    for d in range(40):
        text = " ".join(word() for _ in range(30))
        if d % 2:
            hurt = list(r.choice(items[:12])[1])
            for _ in range(r.randint(0, len(hurt) // 12)):
                hurt[r.randrange(len(hurt))] = r.choice(["", "x", "yz"])
            text = f"{text}\n{''.join(hurt).upper()} {text}"
        rows.append((d, text))
    rows += [(100, None), (101, ""), (102, items[2][1] + " and " + items[5][1]), (103, "it is Short. or SHORT two words"), (104, "shorter a1 xtwo words")]
    rows += [(105, " ".join([items[4][1][:-1]] * 400) + " tail")]
    want = set()
    for d, text in rows:
        for i, item in items:
            t, p = decontam.normal(text), decontam.normal(item)
            alone = len(p) >= decontam.CHARS_PER_ERROR or f" {p} " in f" {t} "
            if p and alone and (e := distance(p, t)) <= decontam.budget(p):
                want.add((d, i, e))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    got = {(x.doc_id, x.item_id, x.distance) for x in decontam.matches(docs, bench).collect()}
    assert got == want and len(want) > 10
    left = {x.doc_id for x in decontam.clean(docs, bench).collect()}
    assert left == {d for d, _ in rows} - {d for d, _, _ in want}
    assert decontam.matches(docs, bench.where("item_id > 500")).count() == 0


def test_items_in_many_blocks(spark):
    items = [(i, f"passage number {i} of the benchmark, word {i * 7919}") for i in range(5)]
    docs = frame(spark, [(i, f"before {t} after") for i, t in items])
    got = {(x.doc_id, x.item_id) for x in decontam.matches(docs, spark.createDataFrame(items, "item_id long, text string"), block_chars=60).where("distance = 0").collect()}
    assert got == {(i, i) for i in range(5)}
    more = spark.createDataFrame([(9, "nothing", "x", 1)], docs.schema).unionByName(docs)
    assert [r.doc_id for r in decontam.clean(more, spark.createDataFrame(items, "item_id long, text string"), block_chars=60).collect()] == [9]
    nothing = spark.createDataFrame([], docs.schema)
    assert decontam.matches(nothing, spark.createDataFrame(items, "item_id long, text string")).count() == decontam.clean(nothing, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_matches_keep_clear_of_other_columns(spark):
    items = spark.createDataFrame([(1, "the passage that is sought here", "t")], "item_id long, text string, doc_id string")
    docs = spark.createDataFrame([(5, "x " * 50_000 + "THE passage  that is sought\nhere", 3, "d")], "doc_id long, text string, item_id int, distance string")
    assert [tuple(r) for r in decontam.matches(docs, items).collect()] == [(5, 1, 0)]
    assert decontam.clean(docs, items).count() == 0


@pytest.fixture(scope="module")
def toxic(spark):
    r = random.Random(6)
    clean = "the quiet river ran past seven houses where people kept small gardens and read books in the evening light".split()
    bad = ["idiot", "moron", "scum"]
    disguise = {"idiot": ["1d10t", "i.d.i.o.t", "idiooot", "i d i o t"], "moron": ["m0r0n", "m o r o n", "mooooron"], "scum": ["$cum", "s.c.u.m", "s c u m"]}
    rows, labels = [], []
    for i in range(900):
        words, y = r.choices(clean, k=30), int(r.random() < 0.3)
        if y:
            w = r.choice(bad)
            hidden = zlib.crc32(str(i).encode()) % 3 == 1
            words.insert(r.randrange(30), r.choice(disguise[w]) if hidden else w)
        rows.append((i, " ".join(words)))
        labels.append((i, y))
    docs = frame(spark, rows)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, y, toxicity.fit(docs, y)


def test_disguised_words_are_restored_and_scored(spark, toxic):
    """Training rows spell the words plainly; held-out rows only in disguise."""
    docs, labels, model = toxic
    got = model.score(docs).join(labels, "doc_id").where(toxicity.held_out()).toPandas()
    assert ((got.score >= 0.7) == (got.toxic == 1)).mean() > 0.98
    reader = toxicity.Restorer(toxicity.CharModel(model.grams))
    assert [reader.token(w) for w in ("1d10t", "m0r0n,", "$cum", "river", "books...", "12345")] == [["idiot"], ["moron"], ["scum"], ["river"], ["books"], ["12345"]]
    assert reader.spaced("i d i o t") == reader.spaced("i  d \t i   o\nt") == ("idiot",)
    assert [reader.token(w) for w in ("--", "***", "river***", "0", "2024,", "$!$")] == [[], [], ["river"], ["0"], ["2024"], ["sis"]]
    assert ["".join(c for c in "".join(reader.token(w)) if c.isalnum()) for w in ("1.0.5.3.12", "100%", "$1,234.50", "10:30")] == ["105312", "100", "123450", "1030"]


def every_path(token, model):
    """The cost of the cheapest path of a token's lattice, all paths written out."""
    from itertools import product

    def cost(path):
        text, total = "", sum(c for _, c in path)
        h = "   "
        for c in "".join(x for x, _ in path) + " ":
            if c == " " and h == "   ":
                continue
            total += model.numeral(h, c) if toxicity.is_number(token) else model.cost(h, c)
            h, text = ("   " if c == " " else (h + c)[-3:]), text + c
        return round(total, 9), text.strip()

    return min(cost(p) for p in product(*toxicity.lattice(token)))[0], cost


def test_viterbi_finds_the_cheapest_of_all_paths(toxic):
    model = toxicity.CharModel(toxic[2].grams)
    r = random.Random(13)
    seen = 0
    for _ in range(600):
        token = "".join(r.choice(["idi", "o", "rr", "$", "1", "!", ".", "-", "ttt", "moron", " ", "0", "@@"]) for _ in range(r.randint(1, 6))).strip()
        if not token or toxicity.lattice(token) is None:
            continue
        seen += 1
        best, cost = every_path(token, model)
        got = toxicity.restore(token, model)
        # the restored text costs as little as the cheapest path: some path that spells it does
        from itertools import product

        assert best == min(c for c, text in map(cost, product(*toxicity.lattice(token))) if text == got)
    assert seen > 300


def test_words_broken_by_blanks_are_found(spark, toxic):
    _, _, model = toxic
    known = {f: i for i, f in enumerate(model.features)}
    found = toxicity.Features(toxicity.Restorer(toxicity.CharModel(model.grams)), known)
    assert known["idiot"] in found("the quiet id iot ran") and known["moron"] in found("m or on")
    assert not {known["idiot"], known["moron"]} & found("the quiet river ran past seven houses in the evening light")


def test_long_spelt_out_runs_are_decoded_whole(toxic):
    reader = toxicity.Restorer(toxicity.CharModel(toxic[2].grams))
    assert "idiot" in reader.spaced("x " * 120 + "i d i o t")[-1]
    words = "the quiet river ran past seven houses where people kept small gardens and read books in the evening light".split()
    spelt = " ".join("".join(words * 4 + ["moron"]))
    assert len(spelt) > 600 and "moron" in "".join(reader.spaced(spelt)) and len("".join(reader.spaced(spelt))) > 300


def test_doubled_letters_and_look_alikes_at_the_edges_are_choices(toxic):
    reader = toxicity.Restorer(toxicity.CharModel(toxic[2].grams))
    assert [reader.token(w) for w in ("iiddiioott", "moronn", "!diot", "$$cum", "(!diot)", "sccuum!")] == [["idiot"], ["moron"], ["idiot"], ["scum"], ["idiot"], ["scum"]]
    assert [reader.token(w) for w in ("(river", "books!", "**small**", "kept!?", "100!", "!!!")] == [["river"], ["books"], ["small"], ["kept"], ["100"], []]


def test_tokens_of_any_length_are_decoded_and_counted(toxic):
    reader = toxicity.Restorer(toxicity.CharModel(toxic[2].grams))
    assert reader.token("".join(c * 14 for c in "idiot")) == ["idiot"]
    dotted = ".".join("".join("the quiet people read books in the evening idiot kept small gardens".split()))
    assert len(dotted) > 100 and "idiot" in "".join(reader.token(dotted))
    assert "idiot" in reader.token(".".join("thequietriverranpastsevenhousesidiot"))
    long = "abcd" * 30
    grams, counts = toxicity.count_grams({long: 2})
    assert dict(zip(grams, counts, strict=True))["abcd"] == 60


def test_toxicity_odd_rows(spark, toxic):
    docs, labels, model = toxic
    odd = frame(spark, [(None, "idiot"), (1, None), (2, ""), (2, ""), (3, "z" * 5000), (4, "$ $ $ $ $")])
    scores = model.score(odd).collect()
    assert len(scores) == 6 and all(0 <= r.score <= 1 for r in scores)
    assert {r.text for r in model.flag(docs.join(labels, "doc_id"), 0.7).collect()} == {r.text for r in docs.join(model.score(docs), "doc_id").where("score < 0.7").collect()}
    assert toxicity.fit(docs, labels.where("false")).score(odd).count() == 6
    assert toxicity.fit(frame(spark, []), labels).score(frame(spark, [])).count() == 0


def test_gram_counts():
    words = {"abc": 2, "a": 5, "été": 1, "aaaaaa": 3, "😀b": 2}
    want = {}
    for w, n in words.items():
        for i in range(len(w) + 1):
            gram = ("   " + w + " ")[i : i + 4]
            want[gram] = want.get(gram, 0) + n
    grams, counts = toxicity.count_grams(words)
    assert dict(zip(grams, counts, strict=True)) == want


def test_ordinal_grades(spark):
    r = random.Random(8)
    signs = ["bad", "poor", "fair", "good"]
    rows, grades = [], []
    for i in range(900):
        g = r.randrange(4)
        rows.append((i, " ".join(r.choices(["and", "so", "it", "goes"], k=20) + [signs[g]] * 4)))
        grades.append((i, g))
    docs, rated = frame(spark, rows), spark.createDataFrame(grades, "doc_id long, grade int")
    w, cuts = model = quality.fit(docs, rated, 4)
    assert (np.diff(cuts) > 0).all() and len(w) == 1 << quality.BITS
    got = quality.grade(docs, model, tail=2).join(rated, "doc_id").where(quality.held_out()).toPandas()
    assert (got.expected_grade.round() == got.grade).mean() > 0.95
    assert ((got.tail_probability >= 0.5) == (got.grade >= 2)).mean() > 0.97
    odd = quality.grade(frame(spark, [(None, None), (1, ""), (2, "x" * 9000)]), model).collect()
    assert len(odd) == 3 and all(0 <= x.tail_probability <= 1 for x in odd)
    none = quality.grade(docs, quality.fit(docs, rated.where("false"), 4)).first()
    assert none.tail_probability == 0.5


@pytest.mark.parametrize(("budgets", "recall"), [({}, 0.95), ({"scored": 300}, 0.85), ({"trees": 4, "window": 4000, "wanted": 4000, "scored": 4000}, 1.0), ({"trees": 8, "window": 16, "wanted": 20, "scored": 10}, 0.0)])
def test_neighbours(spark, monkeypatch, budgets, recall):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 700)  # both are read on the driver
    monkeypatch.setattr(ann, "ENTRIES", 10_000_000 if recall == 1.0 else 50_000)
    x = np.random.default_rng(1).normal(size=(2000, 48)).astype(np.float32)
    x[100:130] = x[50]
    x[200] *= 1e-30
    rows = [(i, v.tolist(), "y") for i, v in enumerate(x)]
    rows += [(5000, None, "n"), (5001, [0.0] * 48, "n"), (5002, [float("nan")] + [1.0] * 47, "n"), (5003, [None] + [1.0] * 47, "n"), (5004, [], "n"), (5005, [float("inf")] * 48, "n"), (None, x[0].tolist(), "n"), (7, x[7].tolist(), "y"), (5006, [1.0], "n")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, block string")
    got = ann.search(df, df.where("vec_id % 50 = 0"), 5, **budgets).toPandas()
    assert set(got.query_id) == set(range(0, 2000, 50))
    y = x.astype(np.float64)
    y /= np.sqrt((y * y).sum(axis=1))[:, None]
    found = 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        s = y @ y[q]
        assert np.allclose(part.score, s[part.vec_id], rtol=1e-12) and list(part["rank"]) == [1, 2, 3, 4, 5] and q not in set(part.vec_id)
        s[q] = -9
        best = np.lexsort((np.arange(len(s)), -s.round(12)))[:5]
        found += len(set(best) & set(part.vec_id))
        if q in (50, 100) and recall:
            assert list(part.vec_id) == best.tolist()  # equal vectors: the smallest ids
    assert found / (5 * got.query_id.nunique()) >= recall
    few = ann.search(df.where("vec_id < 3"), df.where("vec_id = 0"), 5).collect()
    assert [(r["rank"], r.query_id) for r in few] == [(1, 0), (2, 0)]
    assert ann.search(df.where("false"), df.where("false")).count() == 0


def test_gradients_of_the_cumulative_link():
    r = np.random.default_rng(4)
    scores, grades, steps = r.normal(size=30), r.integers(0, 4, 30), np.array([-0.7, 0.2, -0.4])
    _, by_score, by_step = quality.loss_and_gradients(scores, grades, steps)
    h = 1e-6
    for x, g in ((scores, by_score), (steps, by_step)):
        for i in range(len(x)):
            x[i] += h
            up = quality.loss_and_gradients(scores, grades, steps)[0]
            x[i] -= 2 * h
            down = quality.loss_and_gradients(scores, grades, steps)[0]
            x[i] += h
            assert abs((up - down) / (2 * h) - g[i]) < 1e-6


def test_grades_of_nothing_of_repeats_and_of_any_layout(spark):
    rated = spark.createDataFrame([(i, i % 3) for i in range(60)], "doc_id long, grade int")
    rows = [(i, ["bad", "so so", "fine"][i % 3] + f" text {i}") for i in range(60)] + [(4, "bad twice"), (4, "bad twice")]
    data = lambda n: spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, expected_grade double, grade int").repartition(n)
    (w, cuts), (w2, cuts2) = (quality.fit(data(n), rated, 3) for n in (1, 5))
    assert (w == w2).all() and (cuts == cuts2).all()
    assert quality.grade(data(2), (w, cuts)).count() == 62
    nothing = frame(spark, [])
    assert quality.grade(nothing, quality.fit(nothing, rated, 3)).count() == 0
    assert quality.shape(b"Ab" + b"x" * 90 + b"9#") == b"Aa9#"
    assert quality.Features().word(b"x" * 70 + b"!") != quality.Features().word(b"x" * 70)


def test_budgets_bound_what_is_scored(spark):
    """Unclustered vectors, the hardest case: a fixed number of candidates a query, and recall with them."""
    x = np.random.default_rng(5).normal(size=(6000, 64))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "node long, v array<double>")
    pairs = ann.candidates(nodes, nodes.where("node % 100 = 0").withColumnRenamed("node", "vec_id"), 64).toPandas()
    assert (pairs.groupby("query").size() == ann.SCORED).all() and not pairs.duplicated().any()
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    found = 0
    for q, part in pairs.groupby("query"):
        s = x @ x[q]
        s[q] = -9
        found += len(set(np.argsort(-s)[:5]) & set(part.node))
    assert found / (5 * pairs["query"].nunique()) >= 0.9


def test_very_large_and_very_small_vectors(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e-170, 2e-170]), (2, [2.0, 1.0]), (3, [-1e300, -2e300]), (3, [-1e300, -2e300]), (4, [3.0, 1.0]), (4, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in ann.search(df, df.where("vec_id = 0"), 5).collect()}
    assert got.keys() == {1, 2, 3, 4} and [round(got[i], 9) for i in (1, 2, 3)] == [1.0, 0.8, -1.0] and round(got[4], 6) == round(1 / 5**0.5, 6)


def lm_rows():
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["New york", "san Diego", "new", f"w{r.randint(0, 90)}"]) for _ in range(r.randint(1, 60)))) for i in range(250)]
    return rows + [(900, None), (901, ""), (None, "new york"), (902, "new york"), (902, "new york"), (903, "strange things " * 4000)]


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(lm, "TABLE", 12)  # read on the driver
    rows = lm_rows()
    docs = frame(spark, rows, "n_tokens string, word long")
    counts = {}
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 7 != 2:
            for w in lm.tokens(t):
                counts[w] = counts.get(w, 0) + 1
    total, types = sum(counts.values()), len(counts)
    want = sorted((i or -1, len(lm.tokens(t)), sum(w in counts for w in lm.tokens(t)), round(sum(math.log10((counts.get(w, 0) + 1) / (total + types + 1)) for w in lm.tokens(t)), 7)) for i, t in rows)
    model = lm.count(docs)
    coded = lm.coded(docs, model).persist()
    model.parameters = lm.train(coded, model, shard_tokens=3000, batch=256)
    got = lm.score_coded(coded, model).collect()
    assert sorted((x.doc_id or -1, x.n_tokens, x.n_known, round(x.base_score, 7)) for x in got) == want
    assert all(x.train_tokens == total for x in got)
    # every score is the plain sum of the model's log-probabilities
    p = lm.Parameters(model.parameters)
    own = {w: i for i, w in enumerate(list(model.table)[: lm.COMMON])}
    rest: dict[int, list[int]] = {}
    for w, c in counts.items():
        if w not in own:
            rest.setdefault(lm.shared_unit(w), []).append(c)

    def softmax(x):
        x = np.exp(x.astype(np.float64) - x.max())
        return x / x.sum()

    memo = {}

    def plain(text):
        first, second, out = lm._START, lm._START, 0.0
        for w in lm.tokens(text):
            u = own.get(w, lm.shared_unit(w))
            if (first, second, u) not in memo:
                r = p.context[first] @ p.maps[0] + p.context[second] @ p.maps[1]
                k = u // lm.MEMBERS
                block = slice(k * lm.MEMBERS, (k + 1) * lm.MEMBERS)
                memo[first, second, u] = math.log10(softmax(p.klass @ r + p.class_bias)[k] * softmax(p.unit[block] @ r + p.bias[block])[u % lm.MEMBERS])
            out += memo[first, second, u]
            if w not in own:
                inside = rest.get(u, [])
                out += math.log10((counts.get(w, 0) + 1) / (sum(inside) + len(inside) + 1))
            first, second = second, u
        return out

    expected = sorted((i or -1, plain(t)) for i, t in rows)
    assert [i for i, _ in expected] == sorted(x.doc_id or -1 for x in got)
    assert np.allclose([x for _, x in expected], [s for _, s in sorted((x.doc_id or -1, x.score) for x in got)], rtol=1e-4, atol=1e-3)
    held = [x for x in got if zlib.crc32(str(x.doc_id).encode()) % 7 == 2 and x.n_tokens > 3]
    assert sum(x.score for x in held) > sum(x.base_score for x in held)
    assert lm.score(frame(spark, [])).count() == 0


def test_texts_split_into_the_same_words():
    texts = [*ODD, " A\x0bB\x1cc\u00a0D\u2003e ", "\t", "ÄÉ Zz"]
    flat, sizes = lm.split(pa.array(texts, pa.string()))
    words = [lm.tokens(t)[:-1] for t in texts]
    assert flat.to_pylist() == [w for ws in words for w in ws] and sizes.tolist() == [len(w) for w in words]


def test_scores_do_not_hang_on_the_layout(spark):
    rows = lm_rows()
    one, many = ({(x.doc_id, x.n_tokens): x.score for x in lm.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys() and all(abs(one[k] - many[k]) < 1e-6 * (1 + abs(one[k])) for k in one)


def test_probabilities_sum_to_one():
    shares = np.random.default_rng(2).random(lm.UNITS)
    shares[500 : lm.COMMON] = 0
    p = lm.Parameters.start(shares / shares.sum())
    contexts = np.array([[lm._START, lm._START], [3, 40], [lm.COMMON + 5, 0]])
    for context in contexts:
        used = np.flatnonzero(shares)
        total = np.exp(p.log_probabilities(np.tile(context, (len(used), 1)), used)).sum()
        assert abs(total - 1) < 1e-4
    assert np.isfinite(p.log_probabilities(contexts, np.array([0, 7, lm.COMMON]))).all()


def test_noise_contrastive_steps_learn_a_succession():
    shares = np.zeros(lm.UNITS)
    shares[:300] = 1 / 300
    shares[lm.COMMON :] = 1e-9
    shares /= shares.sum()
    trainer = lm.Trainer(lm.Parameters.start(shares), shares, 0.1, 1)
    r = np.random.default_rng(3)
    before = after = None
    for _ in range(200):
        second = r.integers(0, 300, 2000)
        contexts, targets = np.stack([r.integers(0, 300, 2000), second], axis=1), (second + 7) % 300
        if before is None:
            before = trainer.p.log_probabilities(contexts, targets).mean()
        trainer.step(contexts, targets)
        after = trainer.p.log_probabilities(contexts, targets).mean()
    assert abs(before + math.log(300)) < 0.3 and after > before + 1.5


def test_coded_rows_are_one_a_document_and_hold_its_rare_words(spark, monkeypatch):
    monkeypatch.setattr(lm, "TABLE", 12)  # read on the driver
    rows = [(i, t) for i, t in lm_rows() if i is not None and i != 902] + [(1000, "Rare rare rarer"), (1001, "")]
    docs = frame(spark, rows)
    model = lm.count(docs)
    got = {r.doc_id: r for r in lm.coded(docs, model).collect()}
    assert len(got) == len(rows) == lm.coded(docs, model).count()
    for i, t in rows:
        words = lm.tokens(t)
        want = {w: words.count(w) for w in set(words) if w not in model.table}
        assert len(got[i].words) == len(want) and dict(zip(map(bytes, got[i].words), got[i].times, strict=True)) == want
        assert got[i].n == len(words) and len(got[i].units) == 2 * len(words)


def test_steps_do_not_hang_on_tiles(monkeypatch):
    r = np.random.default_rng(4)
    shares = np.zeros(lm.UNITS)
    shares[: 3 * lm.MEMBERS] = r.random(3 * lm.MEMBERS)
    shares /= shares.sum()
    targets = np.concatenate([r.integers(0, lm.MEMBERS, 65), [lm.MEMBERS], r.integers(2 * lm.MEMBERS, 3 * lm.MEMBERS, 32)])
    contexts, found = r.integers(0, 3 * lm.MEMBERS, (len(targets), 2)), []
    for tile in (1, 7, 32, 1000):
        monkeypatch.setattr(lm, "TILE", tile)
        trainer = lm.Trainer(lm.Parameters.start(shares), shares, 0.1, 1)
        for _ in range(3):
            trainer.step(contexts, targets)
        found.append(trainer.p.rows)
    assert all(np.allclose(found[0], x, atol=1e-4) for x in found) and not np.allclose(found[0], lm.Parameters.start(shares).rows, atol=1e-2)


def test_sums_and_softmax_by_blocks():
    r = np.random.default_rng(6)
    for index in (r.integers(0, 9, 50), np.arange(50)[::-1].copy(), np.full(50, 3)):
        rows = r.normal(0, 1, (50, lm.WIDTH)).astype(np.float32)
        want = np.zeros((50, lm.WIDTH))
        np.add.at(want, index, rows)
        at, sums = lm.summed(index, rows)
        assert at.tolist() == sorted(set(index.tolist())) and np.allclose(sums, want[at], atol=1e-4)
    table, chosen = r.normal(0, 1, (9, lm.WIDTH)).astype(np.float32), r.integers(0, 9, 20)
    for far, bias in ((1, np.zeros(9)), (200, np.zeros(9)), (1, np.linspace(-300, 0, 9)), (30, np.linspace(-100, 5, 9)), (1, np.where(np.arange(9) < 4, lm.UNUSED, -1))):
        x, bias = r.normal(0, far, (20, lm.WIDTH)).astype(np.float32), bias.astype(np.float32)
        scores = x.astype(np.float64) @ table.T.astype(np.float64) + bias
        want = scores - scores.max(axis=1, keepdims=True)
        want -= np.log(np.exp(want).sum(axis=1, keepdims=True))
        with np.errstate(over="ignore", invalid="ignore"):
            got = lm._normalised(x, table, bias, chosen)
        assert np.allclose(got, want[np.arange(20), chosen], rtol=1e-3, atol=1e-3)


def test_contexts_do_not_cross_texts():
    ids, ends = np.array([5, 6, 7, 8, 9, 4]), np.array([False, False, True, True, False, True])
    s = lm._START
    assert lm.contexts_of(ids, ends).tolist() == [[s, s], [s, 5], [5, 6], [s, s], [s, s], [s, 9]]


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline as cp

    r = random.Random(12)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(2500)]
    prose = lambda n: " ".join(r.choices(vocabulary, k=n))
    bench = [(i, prose(30)) for i in range(5)]
    rows, labels, expect = [], [], {}
    shared = prose(60)
    for i in range(400):
        words, y = prose(120).split(), int(i % 4 == 0)
        if y:
            words.insert(60, "idiot")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, y))
    near = rows[1][1].split()
    near[50] = "changed"
    rows += [(500, rows[3][1]), (501, " ".join(near)), (502, prose(50) + " " + bench[2][1] + " " + prose(50)), (503, prose(40) + " " + shared + " " + prose(40)), (504, prose(40) + " " + shared + " " + prose(30)), (505, "1d10t " + prose(80)), (506, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, step = {}, spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in cp.STAGES:
        stage(spark, step, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        step = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = {x.doc_id: x for x in step.collect()}
    clean = {i for i, _, y in labels if not y}
    assert set(kept["toxicity"]) == clean | {500, 501, 502, 503, 504, 506}
    assert set(kept["simhash_near_dedup"]) == clean | {502, 503, 504, 506}
    cut = kept["suffix_array_dedup"]
    assert shared[20:-20] not in cut[503].text and len(cut[503].text) == cut[503].n_chars < len(dict(rows)[503])
    assert all(cut[i].text == dict(rows)[i] for i in clean)
    assert set(kept["benchmark_decontamination"]) == clean | {503, 504, 506}
    assert set(kept["byte_level_bpe"]) == set(kept["benchmark_decontamination"])
    assert {x.doc_id: x.ids_sha256 for x in cp.run(spark, str(tmp_path)).collect()} == {i: x.ids_sha256 for i, x in kept["byte_level_bpe"].items()}


def test_texts_pass_the_near_copies_stage_without_a_shuffle(spark, tmp_path, monkeypatch):
    import corpus_pipeline as cp

    texts = [" ".join(f"w{(i * 7 + j * j) % 997}x{i % 3}" for j in range(90)) for i in range(3)]
    rows = [(i, texts[i % 3], "en", "s", 1) for i in range(9)] + [(0, texts[0], "en", "s", 1), (20, None, "en", "s", 1), (20, None, "en", "s", 1), (21, "alone", "en", "s", 1), (None, "x", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = cp.drop_near_copies(spark, docs, str(tmp_path))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        few = sorted(kept.collect(), key=str)
        monkeypatch.setattr(cp, "is_small", lambda df: False)
        assert sorted(cp.drop_near_copies(spark, docs, str(tmp_path)).collect(), key=str) == few
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sorted((r.doc_id, r.text) for r in few if r.doc_id is not None) == [(0, texts[0]), (1, texts[1]), (2, texts[2]), (20, None), (21, "alone")]
    assert [r.text for r in few if r.doc_id is None] == ["x"]


CLASHES = "score double, gram string, word string, units string, row long, n string, ids string, part int, block string, start string, f string, tile string, spans string, hs string, factors string, component_id string"


def clashing(spark, rows):
    """Rows with extra columns under the names that the operators use inside."""
    extra = (0.5, "g", "w", "u", 7, "n", "i", 1, "b", "s", "f", "t", "x", "h", "y", "c")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], f"doc_id long, text string, {CLASHES}").repartition(3)


def test_other_columns_nulls_and_empty_tables_change_nothing(spark, toxic):
    from tidewise.llm import simhash, substring, sufarray

    docs, labels, detector = toxic
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, ODD[3]), (50, "some words " * 30), (51, "some words " * 30)]
    plain, loaded, empty = frame(spark, rows), clashing(spark, rows), clashing(spark, [])
    operators = {
        "op1": lambda d: detector.score(d).select("doc_id", "score"),
        "op2": simhash.near_duplicates,
        "op4": lambda d: substring.dedup(d).drop("kept", "factors"),
        "op5": lambda d: quality.grade(d, (np.zeros(1 << quality.BITS), np.zeros(2))),
        "op6": lambda d: bpe.encode_documents(d, RANKS, P.PATTERN, with_ids=False),
        "op7": lm.score,
        "op9": lambda d: sufarray.dedup(d),
        "op10": lambda d: tokenids.tokenize_to_files(d, WORDS),
    }
    for name, run in operators.items():
        a, b = (sorted(map(str, run(d).collect())) for d in (plain, loaded))
        assert len(a) == len(rows) and (a == b or name == "op7" and len(a) == len(b)), name
        assert run(empty).count() == 0, name
    assert toxicity.fit(clashing(spark, rows), labels).score(loaded).count() == len(rows)


def test_pipeline_of_repeats_and_of_nothing(spark, tmp_path):
    import corpus_pipeline as cp

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"w{i * i % 211}" for i in range(120))
    rows = [(1, text, "en", "a", 600), (1, text, "en", "a", 600), (2, text + " more", "en", None, 605), (3, None, None, "a", None), (None, "without an id " * 20, "en", "a", 280), (4, "", "en", "a", 0)]
    for name, data in (("some", rows), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(9, 1, 0)] if data else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([(1, "an item of the benchmark that is nowhere")] if data else [], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = [r.doc_id for r in cp.run(spark, folder).collect()]
        assert sorted(i or 0 for i in got) == ([0, 1, 3, 4] if data else [])


def test_every_query_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]


def test_pieces_and_samples_are_bounded(spark):
    from tidewise.llm import common

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 40, None, "b" * 100, "", "c", "d" * 30, "e" * 31]})
    got = [p.column(0).to_pylist() for p in common.pieces(iter([batch]), "text", 60)]
    assert [x for p in got for x in p] == batch.column(0).to_pylist()
    assert all(len(p) == 1 or sum(len(x or "") for x in p) <= 60 for p in got)
    assert common.bounded_sample(spark.range(50), 100, "id").count() == 50
    assert 500 < common.bounded_sample(spark.range(20_000), 1000, "id").count() <= 2000
