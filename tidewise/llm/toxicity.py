"""Toxicity by noisy-channel deobfuscation.

An obfuscated word is a clean word sent through a channel that swaps letters for look-alikes, stretches them, puts
separators between them and blanks inside them.  Each token is spread into a lattice of what each symbol may have been; a
Viterbi search under a character language model (4-grams with interpolated lower orders, counted over all training
texts) finds the likeliest original; a logistic model scores the restored text.  A token whose lattice has one path (plain letters, none of
them doubled) is its own restoration and skips the search; tokens without letters are searched like all others (a number's digits cost
nothing to keep).  Runs of single characters, whatever the blanks between them, are one lattice with the blanks as choices, and so are
two or three neighbouring tokens that together spell a word of the fitted model.

Labels are read only from rows that are not held out.  lang, source, doc_id and labels are no inputs of a score.
Null and empty texts get the score of a text without features.  Repeated rows are scored alike; null doc_ids
are never training rows.  Unlabelled rows and null labels are ignored in fitting; with fewer than two classes all scores are
the class share.  Tokens of any length are decoded and counted; the search is linear in their length.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, bounded_sample, cut, forget_state, kept_rows, rows_of, texts, worker_state

#: What a symbol may stand for in obfuscated spelling.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "§": "s", "#": "h", "%": "x"}
SEPARATORS = ".-_*~/\\'"
SWAP, COLLAPSE, JOIN, DROP, NUMERAL = 1.0, 1.0, 0.3, 1.5, 3.0  # channel costs in nats; a number is seldom a word in disguise
ORDER = 4
LAMBDA = 4.0
#: Sizes of the model, not of the data: so many 4-grams and features are kept, the most frequent and the most telling.
MAX_GRAMS = 200_000
MAX_FEATURES = 4_096
#: The classifier (its features and weights) is fitted on about so many labelled rows, those with the smallest hash, or all if there
#: are no more; the language model's counts cover all training texts.
SAMPLE_ROWS = 30_000
CACHE = 200_000
MEMO = 300_000
ALL = " "  # counts the texts; no feature is a blank
SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
EDGE = ".,;:!?\"'()[]{}<>«»„“”…"
PREFIXES = (4, 5, 6)


_NONE: dict[str, int] = {}


class CharModel:
    """Interpolated character 4-gram model over words; a blank stands for both ends of a word."""

    def __init__(self, grams: dict[str, int]) -> None:
        self.levels: list[dict[str, dict[str, int]]] = [{} for _ in range(ORDER)]
        self.totals: list[dict[str, int]] = [{} for _ in range(ORDER)]
        for gram, n in grams.items():
            for k in range(ORDER):
                context, c = gram[ORDER - 1 - k : ORDER - 1], gram[-1]
                row = self.levels[k].setdefault(context, {})
                row[c] = row.get(c, 0) + n
                self.totals[k][context] = self.totals[k].get(context, 0) + n
        self.memo: dict[str, float] = {}  # recent costs, and those before them
        self.old: dict[str, float] = {}

    def cost(self, context: str, c: str) -> float:
        """Negative log-probability of c after the three characters of context."""
        gram = context + c
        got = self.memo.get(gram)
        if got is None:
            got = self.old.get(gram)
            if got is None:
                p = 1e-4
                for k in range(ORDER):
                    tail = context[len(context) - k :] if k else ""
                    p = (self.levels[k].get(tail, _NONE).get(c, 0) + LAMBDA * p) / (self.totals[k].get(tail, 0) + LAMBDA)
                got = -math.log(p)
            if len(self.memo) >= MEMO:
                self.memo, self.old = {}, self.memo
            self.memo[gram] = got
        return got

    def numeral(self, context: str, c: str) -> float:
        """The same for a number, whose digits and marks are all alike to it."""
        return self.cost(context, c) if c.isalpha() or c == " " else math.log(10)


_RUN = re.compile(r"(.)\1+", re.DOTALL)
_NUMBER = re.compile(r"[$€£+-]?\d[\d.,:/-]*%?")


def is_number(token: str) -> bool:
    return _NUMBER.fullmatch(token.strip(EDGE)) is not None


def lattice(token: str) -> list[list[tuple[str, float]]] | None:
    """For each stretch of the token what it may have been, with channel costs; None if there is one path only.

    Around a token (not around a run of single characters) marks may be punctuation: plain ones go, look-alikes go or are letters."""
    out: list[list[tuple[str, float]]] = []
    if token.isalpha():
        at = 0
        for m in _RUN.finditer(token):
            c, run = m[1], m.end() - m.start()
            if m.start() > at:
                out.append([(token[at : m.start()], 0.0)])
            out.append([(c * run, 0.0), (c, 2 * COLLAPSE)] if run == 2 else [(c * run, 0.0), (c, COLLAPSE), (c * 2, COLLAPSE)])
            at = m.end()
        return [*out, [(token[at:], 0.0)]] if out else None
    open_choice, plain = False, ""
    spaced = len(token) > 4 and all(not x.isalnum() or not y.isalnum() for x, y in zip(token, token[1:], strict=False))
    i, n = 0, len(token)
    first, last = (0, n) if " " in token else _inner(token)
    own, mask = (0.0, NUMERAL) if is_number(token) else (2.0, SWAP)  # of a digit or mark that is itself, or a letter
    while i < n:
        c, j = token[i], i + 1
        while j < n and token[j] == c:
            j += 1
        run = j - i
        outside = (j <= first or i >= last) and (c in EDGE or run > 1 and c != "_")
        if outside and c not in LOOKALIKES:
            i, open_choice = j, True
            continue
        if run == 1 and c.isalpha():
            plain += c
            i = j
            continue
        options = [(c * run, 0.0 if c.isalpha() else own * run)]
        if c == " ":
            options = [(" ", 0.0), ("", JOIN)]
        elif c in SEPARATORS:
            options = [("", JOIN if spaced else DROP), (c * run, own)]
            if spaced:
                options.append((" ", JOIN))  # words spelt out may follow one another
        else:
            letters = c if c.isalpha() else LOOKALIKES.get(c, "")
            swap = 0.0 if c.isalpha() else mask
            for letter in letters:
                if run > 2 or not c.isalpha():
                    options.append((letter, swap + (COLLAPSE if run > 1 else 0)))
                if run == 2 and not c.isalpha() or run > 2:
                    options.append((letter * 2, swap + COLLAPSE))
        if run == 2 and c.isalpha():
            options.append((c, 2 * COLLAPSE))
        if outside:
            options[0] = ("", 0.0 if c in EDGE else DROP * run)
        open_choice |= len(options) > 1
        if len(options) == 1:
            plain += options[0][0]
        else:
            if plain:
                out.append([(plain, 0.0)])
                plain = ""
            out.append(options)
        i = j
    if plain:
        out.append([(plain, 0.0)])
    return out if open_choice else None


_SIGN = re.compile("|".join(re.escape(c) for c in LOOKALIKES if c not in EDGE and not c.isalnum()))


def _inner(token: str) -> tuple[int, int]:
    """Where the letters, digits and lone signs that may be letters begin and end."""
    inside = [i for i, c in enumerate(token) if c.isalnum() or _SIGN.match(c) and c not in (token[i - 1 : i], token[i + 1 : i + 2])]
    return (inside[0], inside[-1] + 1) if inside else (len(token), len(token))


_BLANK = " " * (ORDER - 1)


def restore(token: str, model: CharModel) -> str:
    """The likeliest original of a token (or of a run of tokens with blanks) under channel and language model.

    What costs the same on every path is not added up: a stretch without choices that all paths share counts only as far as their
    histories reach into it, ORDER - 1 characters; behind that they are one."""
    if token.isalpha():
        runs = [m.span() for m in _RUN.finditer(token)]
        if all(b - a == 2 for a, b in runs) and all(c - b >= ORDER - 1 for (_, b), (c, _) in zip(runs, runs[1:], strict=False)):
            for a, _ in reversed(runs):  # so far apart that none is in another's history
                token = _one_double(token, a, model)
            return token
    steps = lattice(token)
    if steps is None:
        return token
    states: dict[str, tuple[float, tuple | None]] = {_BLANK: (0.0, None)}  # cost, and the pieces as a chain from the last to the first
    cost, memo = (model.numeral, {}) if is_number(token) else (model.cost, model.memo)
    for options in [*steps, [(" ", 0.0)]]:
        if len(options) == 1 and len(options[0][0]) >= ORDER - 1:
            piece = options[0][0]
            if len(states) > 1:
                head, best = piece[: ORDER - 1], None
                for history, (total, chain) in states.items():
                    h = history
                    for c in head:
                        gram = h + c
                        x = memo.get(gram)
                        total += cost(h, c) if x is None else x
                        h = gram[1:]
                    if best is None or total < best[0]:
                        best = (total, chain)
            else:
                (best,) = states.values()
            states = {piece[1 - ORDER :]: (best[0], (best[1], piece))}
            continue
        after: dict[str, tuple[float, tuple | None]] = {}
        for history, (so_far, chain) in states.items():
            for piece, channel in options:
                total, h = so_far + channel, history
                for c in piece:
                    if c == " " and h == _BLANK:
                        continue  # no word, no end of one
                    gram = h + c
                    x = memo.get(gram)
                    total += cost(h, c) if x is None else x
                    h = _BLANK if c == " " else gram[1:]
                if h not in after or total < after[h][0]:
                    after[h] = (total, (chain, piece))
        states = after
    chain, pieces = states[_BLANK][1], []  # the last step leads all states here
    while chain is not None:
        chain, piece = chain
        pieces.append(piece)
    return "".join(reversed(pieces)).strip()


def _one_double(token: str, at: int, model: CharModel) -> str:
    """The same for letters of which one is doubled: two paths, which differ only where their histories hold the doubled letter."""
    kept, single = f"{_BLANK}{token} ", f"{_BLANK}{token[:at]}{token[at + 1 :]} "
    cost, memo, first = model.cost, model.memo, at + ORDER
    of_kept, of_single = 0.0, 2 * COLLAPSE
    for i in range(first, min(first + ORDER, len(kept))):
        gram = kept[i + 1 - ORDER : i + 1]
        x = memo.get(gram)
        of_kept += cost(gram[:-1], gram[-1]) if x is None else x
    for i in range(first, min(first + ORDER - 1, len(single))):
        gram = single[i + 1 - ORDER : i + 1]
        x = memo.get(gram)
        of_single += cost(gram[:-1], gram[-1]) if x is None else x
    return token if of_kept <= of_single else token[:at] + token[at + 1 :]


_DOUBLE = re.compile(r"(.)\1", re.DOTALL)
_PLAIN = "".join(c for c in EDGE if c not in LOOKALIKES)


class Restorer:
    """Restored words of texts; restorations, the costly part, are remembered."""

    def __init__(self, model: CharModel) -> None:
        self.model, self.cache = model, {}

    def token(self, token: str) -> list[str]:
        """Restored words of a token without the plain punctuation around it; on look-alikes the lattice decides."""
        if token.isalpha():
            if _DOUBLE.search(token) is None:
                return [token]
        else:
            token = token.strip(_PLAIN)
            if not token:
                return []
        got = self.cache.get(token)
        if got is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            got = self.cache[token] = restore(token, self.model).split()
        return got

    def spaced(self, run: str) -> tuple[str, ...]:
        return tuple(w for w in restore(" ".join(run.split()), self.model).split() if len(w) > 1)

    def words(self, text: str | None) -> set[str]:
        """The distinct restored words of a text, but for those that blanks break."""
        low = (text or "").lower()
        words = low.split()
        out = {x for w in set(words) for x in self.token(w)}
        return out.union(*map(self.spaced, spelt_out(low, words)))


def spelt_out(low: str, words: list[str]) -> list[str]:
    """Runs of three or more single characters."""
    return SPACED.findall(low) if list(map(len, words)).count(1) > 2 else []


def word_features(word: str) -> list[str]:
    """A word, and its beginnings behind a line break, which no word holds."""
    return [word, *["\n" + word[:k] for k in PREFIXES if len(word) > k]]


class Features:
    """Numbers of the known features in texts whose words are restored.

    Recent tokens are remembered in two generations: those without features as sets, so that most of a text is one set difference."""

    def __init__(self, restorer: Restorer, known: dict[str, int]) -> None:
        self.restorer, self.known = restorer, known
        self.words = {f for f in known if f[0] != "\n"}
        self.heads = {f.lstrip("\n")[: PREFIXES[0]] for f in known}
        self.found: tuple[dict[str, tuple], dict[str, tuple]] = ({}, {})
        self.bare: tuple[set[str], set[str]] = (set(), set())

    def numbers(self, words) -> tuple:
        """Of words that are restored already."""
        heads, head, known = self.heads, PREFIXES[0], self.known
        return tuple([known[f] for w in words if w[:head] in heads for f in word_features(w) if f in known])

    def _learn(self, w: str) -> tuple:
        got = self.numbers(self.restorer.token(w))
        if not got:
            if len(self.bare[0]) >= CACHE:
                self.bare = (set(), self.bare[0])
            self.bare[0].add(w)
            return got
        if len(self.found[0]) >= CACHE:
            self.found = ({}, self.found[0])
        self.found[0][w] = got
        return got

    def __call__(self, text: str | None) -> set:
        low = (text or "").lower()
        words = low.split()
        out: set = set()
        young, old = self.found
        for w in set(words).difference(*self.bare):
            got = young.get(w) or old.get(w) or self._learn(w)
            if got:
                out.update(got)
        for run in spelt_out(low, words):
            out.update(self.numbers(self.restorer.spaced(run)))
        return out | self.broken(words)

    def broken(self, words: list[str]) -> set:
        """Of words that blanks break in the tokens of a text."""
        return {x for run in self._broken(words) for x in self.numbers(restore(run, self.restorer.model).split())} if self.words else set()

    def _broken(self, words: list[str]) -> set[str]:
        """Two or three neighbouring tokens that together spell a word the model knows."""
        pairs = list(map(add, words, words[1:]))
        runs: set[str] = set()
        if not self.words.isdisjoint(pairs):
            runs = {f"{words[i]} {words[i + 1]}" for i, w in enumerate(pairs) if w in self.words}
        triples = list(map(add, pairs, words[2:]))
        if not self.words.isdisjoint(triples):
            runs |= {" ".join(words[i : i + 3]) for i, w in enumerate(triples) if w in self.words}
        return runs


def held_out(doc_id="doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def count_grams(words: dict[str, int]) -> tuple[list[str], list[int]]:
    """4-grams of words (blanks stand before and behind), each counted as often as its word; in numpy over all words at once."""
    if not words:
        return [], []
    edge = " " * (ORDER - 1)
    points = np.frombuffer("".join([edge + w + " " for w in words]).encode("utf-32-le", "replace"), "<u4")
    weight = np.repeat(np.fromiter(words.values(), np.int64), [len(w) + ORDER for w in words])
    alphabet, ids = np.unique(points, return_inverse=True)
    width, n = int(len(alphabet)).bit_length(), len(points) - ORDER + 1
    keys = np.zeros(n, np.int64)
    for i in range(ORDER):
        keys = keys << width | ids[i : i + n]
    inside = (points[ORDER - 1 :] != 32) | (points[ORDER - 2 : -1] != 32)  # not across words
    found, where = np.unique(keys[inside], return_inverse=True)
    counts = np.bincount(where, weight[:n][inside]).astype(np.int64)
    letters, mask = [chr(p) for p in alphabet.tolist()], (1 << width) - 1
    return ["".join([letters[k >> width * j & mask] for j in range(ORDER - 1, -1, -1)]) for k in found.tolist()], counts.tolist()


def _counts(batches):
    schema = pa.schema([("gram", pa.string()), ("n", pa.int64())])
    forget_state()
    words: Counter = Counter()
    size = 0
    for (rows,) in rows_of(batches, "text"):
        for t in rows:
            if t:
                words.update(t.lower().split())
                size += len(t)
        if len(words) > 300_000 or size > 1 << 25:
            grams, counts = count_grams(words)
            yield batch_of(schema, gram=grams, n=counts)
            words.clear()
            size = 0
    grams, counts = count_grams(words)
    if grams:
        yield batch_of(schema, gram=grams, n=counts)


def char_model(docs: DataFrame) -> dict[str, int]:
    """4-gram counts over all of the given texts; the MAX_GRAMS most frequent make the model."""
    counted = docs.select("text").mapInArrow(_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    best = counted.orderBy(F.desc("n"), "gram").limit(MAX_GRAMS).toArrow()  # as columns: far smaller on the driver than rows
    return dict(zip(best.column("gram").to_pylist(), best.column("n").to_pylist(), strict=True))


def fit_logistic(rows: list[list[int]], labels: np.ndarray, size: int, l2: float = 2e-4, rounds: int = 400) -> np.ndarray:
    """Weights and, last, the bias; full-batch Adam on a sparse 0/1 matrix."""
    w = np.zeros(size + 1)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([f for r in rows for f in r], np.int64)
    share = labels.mean() if len(labels) else 0.0
    w[-1] = np.log((share + 1e-3) / (1 - share + 1e-3))
    if share in (0.0, 1.0):
        return w
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(rows)  # both classes weigh the same
    w[-1] = 0.0
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(owner, w[column], len(rows)) + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * weight
        grad = np.append(np.bincount(column, g[owner], size), g.sum())
        grad[:-1] += l2 * w[:-1] / max(1, np.sqrt(len(rows)))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.15 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


class Detector:
    """A fitted model: character 4-grams, features, weights.  Its size is bounded by the constants above."""

    def __init__(self, grams: dict[str, int], features: list[str], weights: np.ndarray) -> None:
        self.grams, self.features, self.weights = grams, features, weights

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, text's score (double); null doc_ids kept."""
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, self.grams, self.features, self.weights))
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

        def run(batches):
            scorer = _scorer(shared)
            for keys, rows in rows_of(batches, "doc_id", "text"):
                yield batch_of(schema, doc_id=keys, score=[scorer(t) for t in rows])

        return texts(docs).mapInArrow(run, "doc_id long, score double")

    def flag(self, docs: DataFrame, threshold: float) -> DataFrame:
        """The rows of docs, all columns, whose text scores under the threshold."""
        shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, self.grams, self.features, self.weights))

        def judge():
            scorer = _scorer(shared)
            return lambda text: scorer(text) < threshold

        return kept_rows(docs, "text", judge)


def _scorer(shared):
    """One scorer, with its caches, a worker process and model."""
    uid, grams, features, weights = shared.value

    def make():
        w = weights.tolist()
        found = Features(Restorer(CharModel(grams)), {f: i for i, f in enumerate(features)})

        def scorer(text):
            z = w[-1] + sum([w[i] for i in sorted(found(text))])
            return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))

        return scorer

    return worker_state(uid, make)


def fit(docs: DataFrame, labels: DataFrame) -> Detector:
    """Fit on the rows of docs that are not held out."""
    train = texts(docs).where(F.col("doc_id").isNotNull() & ~held_out())
    grams = char_model(train)
    toxic = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    sample = bounded_sample(toxic.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), SAMPLE_ROWS, "doc_id")
    # the sample's size is bounded, so it goes to the texts, not the texts to it; of equal texts one is used
    found = train.join(F.broadcast(sample), "doc_id").groupBy(F.xxhash64("text")).agg(F.min_by(F.struct("text", "toxic"), F.struct("doc_id", "text")).alias("r"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, grams))
    plain = pa.schema([("text", pa.string()), ("toxic", pa.int32()), ("words", pa.list_(pa.string()))])

    def restored(batches):
        reader = worker_state(shared.value[0], lambda: Restorer(CharModel(shared.value[1])))
        for rows, ys in rows_of(batches, "text", "toxic"):
            yield batch_of(plain, text=rows, toxic=ys, words=[sorted(reader.words(t)) for t in rows])

    marked = cut(found.select("r.text", "r.toxic").mapInArrow(restored, "text string, toxic int, words array<string>"))  # restored once, read twice
    schema = pa.schema([("f", pa.string()), ("a", pa.int64()), ("b", pa.int64())])

    def count(batches):
        seen: dict[str, list[int]] = {}

        def out():
            return batch_of(schema, f=list(seen), a=[x[1] for x in seen.values()], b=[x[0] for x in seen.values()])

        for rows, ys in rows_of(batches, "words", "toxic"):
            for words, y in zip(rows, ys, strict=True):
                for f in {ALL, *[f for w in words for f in word_features(w)]}:
                    got = seen.get(f)
                    if got is None:
                        got = seen[f] = [0, 0]
                    got[y] += 1
            if len(seen) > 300_000:
                yield out()
                seen.clear()
        yield out()

    stats = cut(marked.mapInArrow(count, "f string, a long, b long").groupBy("f").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    total = stats.where(F.col("f") == ALL).first()
    if total is None:
        return Detector(grams, [], fit_logistic([], np.empty(0), 0))
    odds = F.log((F.col("a") + 0.5) / (total.a - F.col("a") + 0.5)) - F.log((F.col("b") + 0.5) / (total.b - F.col("b") + 0.5))
    z = odds / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = stats.where((F.col("f") != ALL) & (F.col("a") >= 3)).select("f", z.alias("z")).where("z > 2").orderBy(F.desc("z"), "f").limit(MAX_FEATURES).collect()
    features = [r.f for r in best]
    known = spark.sparkContext.broadcast((uuid.uuid4().hex, grams, features))
    pairs = pa.schema([("toxic", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def sparse(batches):
        uid, grams, features = known.value
        found = worker_state(uid, lambda: Features(Restorer(CharModel(grams)), {f: i for i, f in enumerate(features)}))
        for rows, lists, ys in rows_of(batches, "text", "words", "toxic"):
            yield batch_of(pairs, toxic=ys, ids=[sorted({*found.numbers(words), *found.broken((t or "").lower().split())}) for t, words in zip(rows, lists, strict=True)])

    got = sorted((list(r.ids), r.toxic) for r in marked.mapInArrow(sparse, "toxic int, ids array<int>").collect())  # so the fit does not hang on the layout
    weights = fit_logistic([ids for ids, _ in got], np.array([y for _, y in got], float), len(features))
    return Detector(grams, features, weights)
