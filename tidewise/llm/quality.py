"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= j) = sigmoid(threshold_j - score): one weight vector over hashed text features is shared by all grades, and
ordered thresholds (the first is free, the others are positive steps) cut its score into grades.  Each document gets its
expected grade and the tail probability P(grade >= `tail`), by which it is selected.

Features are hashed words and hashed shapes of words (letters, digits and symbols as classes, doubled symbols kept), each weighted
by the square root of its share, and a few hashed counts of how often the commonest word returns.  Null and empty texts have none and get the score of the
thresholds alone.  Repeated rows are scored alike.  Labels that are null are ignored; with no label at all the tail
probability is 0.5.  The model is fitted on about SAMPLE_ROWS labelled rows, those with the smallest hash of doc_id, in order of doc_id,
so it does not hang on the layout of the input.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, bounded_sample, raw, rows_of, texts

BITS = 16
SAMPLE_ROWS = 12_000
CACHE = 200_000
EPOCHS, STEPS = 12, 600  # at least so many of both
_LOWER, _UPPER, _DIGIT = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[A-Z]+"), re.compile(rb"[0-9]+")


def shape(word: bytes) -> bytes:
    return _DIGIT.sub(b"9", _UPPER.sub(b"A", _LOWER.sub(b"a", word)))


class Features:
    """Hashed features of texts: indices and values."""

    def __init__(self) -> None:
        self.cache: dict[bytes, tuple[int, int]] = {}

    def word(self, word: bytes) -> tuple[int, int]:
        got = self.cache.get(word)
        if got is None:
            h = xxhash.xxh64_intdigest
            got = (h(b"w" + word.lower()) >> 64 - BITS, h(b"s" + shape(word)) >> 64 - BITS)
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = got
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = Counter(raw(text).split())
        n = sum(words.values())
        if not n:
            return np.empty(0, np.int64), np.empty(0)
        index, value = [], []
        for w, c in words.items():
            a, b = self.word(w)
            index += (a, b)
            value += (c, c)
        index, where = np.unique(index, return_inverse=True)
        value = np.sqrt(np.bincount(where, value) / n)
        top = max(words.values()) / n
        extra = [xxhash.xxh64_intdigest(f"top{int(10 * top)}") >> 64 - BITS, xxhash.xxh64_intdigest(f"kinds{int(10 * len(words) / n)}") >> 64 - BITS]
        return np.append(index, extra), np.append(value, [0.5, 0.5])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def thresholds(steps: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free numbers: the first, then the logarithms of what each adds."""
    return np.cumsum(np.concatenate([steps[:1], np.exp(steps[1:])]))


def loss_and_gradients(scores: np.ndarray, grades: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of grades, with its gradients by the scores and by the thresholds' free numbers."""
    cuts = np.concatenate([[-np.inf], thresholds(steps), [np.inf]])
    hi, lo = cuts[grades + 1] - scores, cuts[grades] - scores
    ph, pl = np.where(np.isinf(hi), 1.0, _sigmoid(np.where(np.isinf(hi), 0, hi))), np.where(np.isinf(lo), 0.0, _sigmoid(np.where(np.isinf(lo), 0, lo)))
    p = np.maximum(ph - pl, 1e-9)
    dh, dl = ph * (1 - ph) / p, pl * (1 - pl) / p  # of log p by the upper and (negated) lower cut
    by_cut = np.array([(-(dh * (grades == j)) + dl * (grades == j + 1)).sum() for j in range(len(steps))]) / len(grades)
    tail = np.cumsum(by_cut[::-1])[::-1]
    return float(-np.log(p).mean()), (dh - dl) / len(grades), np.concatenate([tail[:1], tail[1:] * np.exp(steps[1:])])


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, l2: float = 1e-5, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by mini-batch Adam on the cumulative-link likelihood."""
    w, m, v = np.zeros(1 << BITS), np.zeros(1 << BITS), np.zeros(1 << BITS)
    share = np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / max(1, len(grades))
    share = np.clip(share, 0.01, 0.99)
    first = np.log(share / (1 - share))
    free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 0.05))]) if len(first) else np.zeros(0)
    mt, vt = np.zeros_like(free), np.zeros_like(free)
    rng, step = np.random.default_rng(seed), 0
    for _ in range(max(EPOCHS, -(-STEPS * 256 // max(1, len(rows))))):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            part = order[at : at + 256]
            step += 1
            owner = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            column = np.concatenate([rows[i][0] for i in part]).astype(np.int64)
            value = np.concatenate([rows[i][1] for i in part])
            _, g, gt = loss_and_gradients(np.bincount(owner, w[column] * value, len(part)), grades[part], free)
            touched = np.unique(column)
            grad = np.bincount(np.searchsorted(touched, column), g[owner] * value, len(touched)) + l2 * w[touched]
            m[touched] = 0.9 * m[touched] + 0.1 * grad
            v[touched] = 0.999 * v[touched] + 0.001 * grad**2
            w[touched] -= 0.05 * (m[touched] / (1 - 0.9**step)) / (np.sqrt(v[touched] / (1 - 0.999**step)) + 1e-8)
            mt, vt = 0.9 * mt + 0.1 * gt, 0.999 * vt + 0.001 * gt**2
            free = free - 0.02 * (mt / (1 - 0.9**step)) / (np.sqrt(vt / (1 - 0.999**step)) + 1e-8)
    return w, thresholds(free)


def held_out(doc_id="doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Fit on rows of docs that are not held out; ratings has doc_id and grade (0 .. n_grades - 1)."""
    graded = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("grade").cast("int").alias("grade")).where(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1))
    graded = graded.where(~held_out()).groupBy("doc_id").agg(F.max("grade").alias("grade"))
    graded = F.broadcast(bounded_sample(graded, sample_rows, "doc_id"))  # bounded: it goes to the texts, not the texts to it
    schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("i", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def run(batches):
        features = Features()
        for keys, rows, ys in rows_of(batches, "doc_id", "text", "grade"):
            got = [features(t) for t in rows]
            yield batch_of(schema, doc_id=keys, grade=ys, i=[i.astype(np.int32) for i, _ in got], x=[x for _, x in got])

    found = []
    chosen = texts(docs).join(graded, "doc_id").select("doc_id", "text", "grade").dropDuplicates(["doc_id", "text"])
    for r in chosen.mapInArrow(run, "doc_id long, grade int, i array<int>, x array<double>").toLocalIterator():
        found.append((r.doc_id, r.grade, np.array(r.i, np.int32), np.array(r.x)))
    if not found:
        return np.zeros(1 << BITS), np.zeros(n_grades - 1)
    found.sort(key=lambda r: (r[0], r[2].tobytes()))
    return fit_ordinal([(i, x) for _, _, i, x in found], np.array([y for _, y, _, _ in found]), n_grades)


def grade(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], tail: int = 1) -> DataFrame:
    """doc_id, expected_grade, tail_probability of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())])

    def run(batches):
        w, cuts = shared.value
        features = Features()
        for keys, rows in rows_of(batches, "doc_id", "text"):
            scores = np.array([float(w[i] @ x) if len(i) else 0.0 for i, x in map(features, rows)])
            above = 1 - 1 / (1 + np.exp(-np.clip(cuts[None, :] - scores[:, None], -30, 30)))  # P(grade > j)
            yield batch_of(schema, doc_id=keys, expected_grade=above.sum(axis=1), tail_probability=above[:, tail - 1])

    return texts(docs).mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
