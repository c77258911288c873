"""Language-model scoring with a log-bilinear model trained by noise-contrastive estimation.

The model predicts the next token from the CONTEXT tokens before it: a linear map of their vectors is compared with the vectors of what
may follow.  It knows UNITS units: the COMMON commonest training tokens have one each, all others share RARE units by hash.  A
unit belongs to one of CLASSES classes of MEMBERS units (neighbours in frequency), and its probability is that of its class given the context
times its own given class and context, both normalised over blocks of units by batched matrix products.  Within a shared unit a token has
the share (c + 1) / (the unit's training tokens + its types + 1), so every token of any text has a normalised probability.

Training is numpy on shards of the training documents: a shard is a fixed share of doc_ids by hash, about SHARD_TOKENS tokens of
the corpus, whatever the layout of the input.  In each of ROUNDS rounds every shard starts from the same parameters, takes its next share of
documents in order of doc_id, and steps by AdaGrad on the noise-contrastive objective, with noise drawn from the class frequencies and, within the
target's class, from its units' frequencies; what the shards changed is averaged, row by row, weighted by how often each used the row.

Token counts cover all training rows and stay distributed; the TABLE commonest tokens are sent to the workers, all others
are looked up by a join in which documents without such tokens take no part, so hot tokens never meet in one task and nothing unbounded is gathered.

Null texts are empty and hold the end token alone.  Repeated rows are scored each; a null doc_id is scored, but not trained on.
Without training rows all counts are zero and the model is uniform over the shared units.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewise.llm.common import batch_of, cut, pieces, raw, texts, worker_state

END = b"\n"  # no word holds white space
CLASSES, MEMBERS = 128, 256
UNITS = CLASSES * MEMBERS
RARE = 4_096
COMMON = UNITS - RARE
CONTEXT = 2
WIDTH = 16
CLASS_NOISE, UNIT_NOISE = 32, 16
BATCH = 8_192
RATE, DECAY = 0.07, 0.7
ROUNDS = 3
SHARD_TOKENS = 2_000_000
MAX_SHARDS = 4_096
TABLE = 250_000
SEED = 42
PIECE_BYTES = 1 << 22
CHUNK = 128  # rows of WIDTH parameters that travel together
SLICE = 1_024  # rows of a product that stays in a cache
TILE = 32  # targets of one class in a batched product
UNUSED = -1e4  # the bias of what never occurs
_START = UNITS  # stands before a text


def tokens(text: str | None) -> list[bytes]:
    words = raw(text).lower().split()
    words.append(END)
    return words


def held_out(doc_id="doc_id") -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))


def shared_unit(word: bytes) -> int:
    """The unit of a token that has none of its own."""
    return COMMON + (xxhash.xxh64_intdigest(word, SEED) & RARE - 1)


def split(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of a column of texts, end to end as binary, and how many each text has; what tokens() gives, but for the ends."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    flat, sizes = lists.flatten().cast(pa.binary()), lists.value_lengths().to_numpy().astype(np.int64)
    empty = pc.equal(pc.binary_length(flat), 0)
    if pc.any(empty).as_py():  # white space around a text
        owner = np.repeat(np.arange(len(sizes)), sizes)[empty.to_numpy(zero_copy_only=False)]
        sizes = sizes - np.bincount(owner, minlength=len(sizes))
        flat = flat.filter(pc.invert(empty))
    return flat, sizes


def plain(column: pa.Array) -> list[bytes]:
    """What to_pylist() gives of a binary column without nulls, several times as fast."""
    if not len(column):
        return []
    edges, data = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].tolist(), column.buffers()[2]
    data = data.to_pybytes() if data else b""
    return [data[a:b] for a, b in pairwise(edges)]


def _count(batches):
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    for part in pieces(batches, "text", PIECE_BYTES):
        flat, sizes = split(part.column(0))
        counts = flat.value_counts()
        yield batch_of(schema, word=counts.field(0), n=counts.field(1))
        yield batch_of(schema, word=[END], n=[len(sizes)])


class Parameters:
    """The trainable arrays, as views of rows of WIDTH numbers: vectors of contexts, of units, of classes, the maps, the biases."""

    ROWS = (UNITS + 1) + UNITS + CLASSES + CONTEXT * WIDTH + (UNITS + CLASSES) // WIDTH

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, at = rows, 0

        def take(n: int) -> np.ndarray:
            nonlocal at
            at += n
            return rows[at - n : at]

        self.context, self.unit, self.klass = take(UNITS + 1), take(UNITS), take(CLASSES)
        self.maps = take(CONTEXT * WIDTH).reshape(CONTEXT, WIDTH, WIDTH)
        self.bias, self.class_bias = take(UNITS // WIDTH).reshape(-1), take(CLASSES // WIDTH).reshape(-1)

    @classmethod
    def start(cls, shares: np.ndarray) -> Parameters:
        """Small random vectors; the biases are the shares of units (0: not in use) in their classes and of classes in all."""
        p = cls(np.random.default_rng(5).normal(0, 0.1, (cls.ROWS, WIDTH)).astype(np.float32))
        p.maps[:] = np.eye(WIDTH, dtype=np.float32) / CONTEXT
        by_class = shares.reshape(CLASSES, MEMBERS).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            p.class_bias[:] = np.log(by_class)
            p.bias[:] = np.log(shares) - np.repeat(np.log(by_class), MEMBERS)
        p.bias[shares == 0] = p.class_bias[by_class == 0] = UNUSED
        return p

    def predicted(self, contexts: np.ndarray) -> np.ndarray:
        return self.context.take(contexts.reshape(-1), axis=0).reshape(-1, CONTEXT * WIDTH) @ self.maps.reshape(-1, WIDTH)

    def log_probabilities(self, contexts: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Normalised natural log-probability of each unit after its context, by blocks of matrix products."""
        order = np.argsort((units // MEMBERS).astype(np.uint16), kind="stable")
        units, r = units[order], self.predicted(contexts.take(order, axis=0))
        classes, logs = units // MEMBERS, np.empty(len(units), np.float32)
        edges = np.searchsorted(classes, np.arange(CLASSES + 1)).tolist()
        members = units - classes * MEMBERS
        with np.errstate(over="ignore", under="ignore", invalid="ignore"):
            for c in range(CLASSES):
                block = slice(c * MEMBERS, (c + 1) * MEMBERS)
                for at in range(edges[c], edges[c + 1], SLICE):
                    part = slice(at, min(at + SLICE, edges[c + 1]))
                    logs[part] = _normalised(r[part], self.unit[block], self.bias[block], members[part])
            for at in range(0, len(units), SLICE):
                part = slice(at, at + SLICE)
                logs[part] += _normalised(r[part], self.klass, self.class_bias, classes[part])
        out = np.empty(len(units), np.float64)
        out[order] = logs
        return out


def _normalised(r: np.ndarray, table: np.ndarray, bias: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Log-softmax of r @ table.T + bias in each row at its chosen column."""
    scores, rows = r @ table.T, np.arange(len(r))
    picked = scores[rows, chosen] + bias[chosen]
    np.exp(scores, out=scores)
    total = scores @ np.exp(bias)
    if not (np.isfinite(total) & (total > 0)).all() or ((bias > UNUSED) & (bias < -60)).any():  # seldom: too far out for exponentials as they are
        scores = r @ table.T + bias
        scores -= scores.max(axis=1, keepdims=True)
        picked = scores[rows, chosen]
        total = np.exp(scores).sum(axis=1)
    return picked - np.log(total)


class Trainer:
    """Sparse AdaGrad on the noise-contrastive objective, from given parameters."""

    def __init__(self, p: Parameters, shares: np.ndarray, rate: float, seed: int) -> None:
        self.p, self.rate, self.rng = p, rate, np.random.default_rng(seed)
        self.squares = Parameters(np.full((Parameters.ROWS, WIDTH), 1e-10, np.float32))
        self.used = np.zeros(Parameters.ROWS, np.float32)
        by_class = shares.reshape(CLASSES, MEMBERS).sum(axis=1)
        inside = shares.reshape(CLASSES, MEMBERS) / np.maximum(by_class, 1e-300)[:, None]
        with np.errstate(divide="ignore"):
            self.log_class = np.log(CLASS_NOISE * by_class).astype(np.float32)
            self.log_unit = np.log(UNIT_NOISE * inside).reshape(-1).astype(np.float32)
        self.class_steps = np.cumsum(by_class)
        self.unit_steps = (np.minimum(np.cumsum(inside, axis=1), 1.0) + np.arange(CLASSES)[:, None]).reshape(-1)

    def _move(self, array: np.ndarray, squares: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
        """Overwrites g."""
        s = g * g
        s += squares.take(at, axis=0)
        squares[at] = s
        np.sqrt(s, out=s)
        s += 1e-6
        g *= self.rate
        g /= s
        array[at] = array.take(at, axis=0) - g

    def step(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        p, n = self.p, len(targets)
        order = np.argsort((targets // MEMBERS).astype(np.uint16), kind="stable")
        targets, words = targets[order], contexts.take(order, axis=0).reshape(-1)
        classes = targets // MEMBERS
        first = np.flatnonzero(np.concatenate([[True], classes[1:] != classes[:-1]]))
        present, sizes = classes[first], np.diff(first, append=n)
        maps = p.maps.reshape(CONTEXT * WIDTH, WIDTH)  # of all vectors of a context end to end
        before = p.context.take(words, axis=0).reshape(n, CONTEXT * WIDTH)
        r = before @ maps
        # classes: noise that the whole batch shares
        noise, times = np.unique(np.minimum(np.searchsorted(self.class_steps, self.rng.random(CLASS_NOISE) * self.class_steps[-1], side="right"), CLASSES - 1), return_counts=True)
        own = p.klass.take(classes, axis=0)
        g_hit = (_sigmoid(np.einsum("ij,ij->i", r, own) + (p.class_bias - self.log_class)[classes]) - 1) / n
        g_miss = r @ p.klass[noise].T
        g_miss += p.class_bias[noise] - self.log_class[noise]
        _sigmoid(g_miss)
        g_miss *= (times / n).astype(np.float32)
        back = g_miss @ p.klass[noise]
        own *= g_hit[:, None]
        back += own
        g_klass, g_class_bias = np.zeros_like(p.klass), np.zeros_like(p.class_bias)
        g_klass[present] = sums_of(g_hit[:, None] * r, first)
        g_class_bias[present] = np.add.reduceat(g_hit, first)
        g_klass[noise] += g_miss.T @ r
        g_class_bias[noise] += np.ones(n, np.float32) @ g_miss
        # units: noise that the targets of a class share
        draws = np.searchsorted(self.unit_steps, (self.rng.random((len(present), UNIT_NOISE)) + present[:, None]).reshape(-1), side="right")
        draws = np.minimum(draws.reshape(len(present), UNIT_NOISE), present[:, None] * MEMBERS + MEMBERS - 1)
        own, offset = p.unit.take(targets, axis=0), p.bias - self.log_unit
        g_own = (_sigmoid(np.einsum("ij,ij->i", r, own) + offset[targets]) - 1) / n
        own *= g_own[:, None]
        back += own
        # the targets of a class fill whole tiles, the last with zeros, so that one batched product serves all classes
        tiles = -(-sizes // TILE)
        of, tile = np.repeat(np.arange(len(present)), tiles), np.cumsum(tiles) - tiles
        at = np.arange(n) + np.repeat(tile * TILE - first, sizes)
        part, live = np.zeros((len(of) * TILE, WIDTH), np.float32), np.zeros(len(of) * TILE, np.float32)
        part[at], live[at] = r, 1 / n
        part, drawn = part.reshape(-1, TILE, WIDTH), p.unit[draws[of]]
        g = part @ drawn.transpose(0, 2, 1)
        g += offset[draws[of]][:, None, :]
        _sigmoid(g)
        g *= live.reshape(-1, TILE, 1)
        back += (g @ drawn).reshape(-1, WIDTH).take(at, axis=0)
        g_drawn = sums_of((g.transpose(0, 2, 1) @ part).reshape(len(of), -1), tile).reshape(-1, WIDTH)
        g_drawn_bias = sums_of(g.reshape(-1, UNIT_NOISE), tile * TILE).reshape(-1)
        draws = draws.reshape(-1)
        r *= g_own[:, None]
        rows, sums = summed(np.concatenate([targets, draws]), np.concatenate([r, g_drawn]))
        bias_g = (np.bincount(targets, g_own, UNITS) + np.bincount(draws, g_drawn_bias, UNITS))[rows]
        seen, to_context = summed(words, (back @ maps.T).reshape(-1, WIDTH))
        g_maps = (before.T @ back).reshape(p.maps.shape)
        s = self.squares
        self._move(p.unit, s.unit, rows, sums)
        self._move(p.bias, s.bias, rows, bias_g.astype(np.float32))
        self._move(p.klass, s.klass, np.arange(CLASSES), g_klass)
        self._move(p.class_bias, s.class_bias, np.arange(CLASSES), g_class_bias)
        self._move(p.context, s.context, seen, to_context)
        self._move(p.maps, s.maps, np.arange(CONTEXT), g_maps)
        self.used[: UNITS + 1] += np.bincount(words, minlength=UNITS + 1)
        self.used[UNITS + 1 : 2 * UNITS + 1] += np.bincount(targets, minlength=UNITS)
        self.used[UNITS + 1 + rows] += 1
        self.used[2 * UNITS + 1 :] += n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """Overwrites x, which stays far from where float32 overflows."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def summed(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices and the sums of the rows that share one."""
    order = np.argsort(index.astype(np.uint16 if UNITS < 1 << 16 else np.int64), kind="stable")
    index = index[order]
    new = np.concatenate([[True], index[1:] != index[:-1], [True]])
    first = np.flatnonzero(new[:-1])
    sums, alone = rows.take(order[first], axis=0), new[first + 1]
    if not alone.all():  # most are alone and need no sum
        shared = ~(new[:-1] & new[1:])
        sums[~alone] = sums_of(rows.take(order[shared], axis=0), np.flatnonzero(new[:-1][shared]))
    return index[first], sums


def sums_of(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sums of runs of neighbouring rows of float32; numbers are added in pairs, which takes half the loops."""
    return np.add.reduceat(rows.view(np.complex64), first, axis=0).view(np.float32)


def contexts_of(units: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The two units before each token; texts are laid end to end and `ends` marks their last tokens."""
    first, second = np.roll(units, 2), np.roll(units, 1)
    new = np.flatnonzero(np.concatenate([[True], ends[:-1]]))
    second[new] = _START
    first[new] = _START
    after = new[new + 1 < len(units)] + 1
    first[after[~np.isin(after, new, assume_unique=True)]] = _START
    return np.stack([first, second], axis=1)


@dataclass
class Model:
    counts: DataFrame  # word, n: all training tokens
    total: int
    types: int
    table: dict[bytes, int]  # the commonest tokens' counts, in falling order
    shared: np.ndarray  # of each shared unit: training tokens and types
    parameters: np.ndarray = field(default_factory=lambda: np.empty(0))

    @property
    def shares(self) -> np.ndarray:
        """Each unit's share of the training tokens, one token added to each that is in use."""
        own = np.array(list(self.table.values())[:COMMON], np.float64) + 1
        mass = np.concatenate([own, np.zeros(COMMON - len(own)), self.shared[0] + 1.0])
        return mass / mass.sum()


def commonest(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The commonest words, at most so many, in falling order (words as frequent as the first left out are left out too).

    How many words have a count is asked first, so only the words that are wanted go to the driver."""
    least, have = None, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        if have + r.words > most:
            break
        least, have = r.n, have + r.words
    if least is None:
        return {}
    rows = [(bytes(r.word), r.n) for r in counts.where(F.col("n") >= least).toLocalIterator()]
    return dict(sorted(rows, key=lambda x: (-x[1], x[0])))


_CODED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("units", pa.binary()), ("n", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("own", pa.float64()), ("words", pa.list_(pa.binary())), ("times", pa.list_(pa.int64()))])
_CODED_DDL = "row long, doc_id long, units binary, n long, n_known long, base double, own double, words array<binary>, times array<long>"


def count(docs: DataFrame) -> Model:
    """Counts of the training rows, without trained parameters."""
    train = texts(docs).where(F.col("doc_id").isNotNull() & ~held_out())
    counts = cut(train.select("text").mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    total, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    table = commonest(counts, TABLE)
    place = F.xxhash64("word").bitwiseAND(F.lit(RARE - 1).cast("long")).alias("place")
    shared = np.zeros((2, RARE), np.int64)
    for r in counts.groupBy(place).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():  # RARE rows at the most
        shared[:, r.place] = r.n, r.types
    for w, n in list(table.items())[:COMMON]:  # these have units of their own
        shared[:, shared_unit(w) - COMMON] -= n, 1
    return Model(counts, total, types, table, shared)


def coded(docs: DataFrame, model: Model) -> DataFrame:
    """One row a document: units of its tokens; what its tokens in the table add to n_known, to the base score and to the shares in shared units; its distinct
    tokens that are not in the table, and how often each occurs (side by side in the row, so that what only trains does not read millions of rows past)."""
    sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model.table))
    base_log = math.log10(model.total + model.types + 1)

    def run(batches):
        from pyspark import TaskContext

        uid, table = sent.value

        def make():
            units = np.arange(len(table) + 1, dtype=np.int64)
            units[COMMON:-1] = [shared_unit(w) for w in list(table)[COMMON:]]
            return pa.array(list(table), pa.binary()), units, np.log10(np.array([*table.values(), 0], np.float64) + 1)

        known, unit_of, own = worker_state(uid, make)
        row, unknown, end = TaskContext.get().partitionId() << 33, len(known), known.index(END).as_py() % (len(known) + 1)
        for part in pieces(batches, "text", PIECE_BYTES):
            flat, counts = split(part.column(1))
            found = pc.index_in(flat, value_set=known)
            sizes = counts + 1
            stops, n = np.cumsum(sizes), len(sizes)
            first, at, inner = stops - sizes, np.full(int(stops[-1]), end, np.int64), np.ones(int(stops[-1]), bool)
            inner[stops - 1] = False
            at[inner] = pc.fill_null(found, unknown).to_numpy()
            here, units = at < unknown, unit_of[at]
            rare = np.flatnonzero(~here)
            strange = flat.filter(pc.is_null(found)).dictionary_encode()
            words = [*plain(strange.dictionary), END]
            kind = np.full(len(rare), len(words) - 1)  # the end
            kind[inner[rare]] = strange.indices.to_numpy()
            units[rare] = np.array([shared_unit(w) for w in words])[kind]
            base, inside = np.where(here, own[at] - base_log, 0.0), np.where(here & (units >= COMMON), own[at], 0.0)
            pairs, times = np.unique(kind + (np.searchsorted(first, rare, side="right") - 1) * len(words), return_counts=True)
            of, word = np.divmod(pairs, len(words))
            starts = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
            lists = pa.ListArray.from_arrays(starts, pa.array(words, pa.binary()).take(pa.array(word))), pa.ListArray.from_arrays(starts, pa.array(times, pa.int64()))
            data, edges = units.astype("<u2").tobytes(), (2 * np.concatenate([[0], stops])).tolist()
            yield batch_of(_CODED, row=row + 1 + np.arange(n), doc_id=part.column(0), units=[data[a:b] for a, b in pairwise(edges)], n=sizes, n_known=np.add.reduceat(here.astype(np.int64), first), base=np.add.reduceat(base, first), own=np.add.reduceat(inside, first), words=lists[0], times=lists[1])
            row += n

    return texts(docs).mapInArrow(run, _CODED_DDL)


_CHANGE = pa.schema([("chunk", pa.int32()), ("change", pa.binary()), ("used", pa.binary())])


def train(rows: DataFrame, model: Model, shard_tokens: int = SHARD_TOKENS, rounds: int = ROUNDS, batch: int = BATCH) -> np.ndarray:
    """The parameters after all rounds over the coded training documents."""
    spark, shares = rows.sparkSession, model.shares
    current = Parameters.start(shares).rows
    shards = min(MAX_SHARDS, -(-model.total // shard_tokens))
    if not shards:
        return current
    learn = rows.where(F.col("doc_id").isNotNull() & ~held_out())
    learn = learn.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(rounds)).alias("turn"), "doc_id", "units")
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((current, shares))

        def run(batches, sent=sent, turn=turn):
            start, shares = sent.value
            shard, held, size, trainer = None, [], 0, None

            def study():
                ids = np.frombuffer(b"".join(held), "<u2").astype(np.int64)
                ends = np.zeros(len(ids), bool)
                ends[np.cumsum([len(x) // 2 for x in held]) - 1] = True
                contexts, order = contexts_of(ids, ends), trainer.rng.permutation(len(ids))
                for at in range(0, len(order), batch):
                    part = order[at : at + batch]
                    trainer.step(contexts[part], ids[part])

            def changes():
                delta = (trainer.p.rows - start).astype(np.float16)
                starts = range(0, len(delta), CHUNK)
                yield batch_of(_CHANGE, chunk=[at // CHUNK for at in starts], change=[delta[at : at + CHUNK].tobytes() for at in starts], used=[trainer.used[at : at + CHUNK].tobytes() for at in starts])

            for part in batches:
                for s, units in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if s != shard or size >= 16 * batch:
                        if held:
                            study()
                        held, size = [], 0
                    if s != shard:
                        if trainer:
                            yield from changes()
                        shard, trainer = s, Trainer(Parameters(start.copy()), shares, RATE * DECAY**turn, s * rounds + turn)
                    held.append(units)
                    size += len(units) // 2
            if held:
                study()
            if trainer:
                yield from changes()

        def mean(batches):
            chunk, total, weight = None, None, None

            def out():
                return batch_of(_CHANGE, chunk=[chunk], change=[(total / np.maximum(weight, 1e-9)[:, None]).astype(np.float32).tobytes()], used=[None])

            for part in batches:
                for c, change, used in zip(*(x.to_pylist() for x in part.columns), strict=True):
                    if c != chunk:
                        if chunk is not None:
                            yield out()
                        chunk, total, weight = c, 0.0, 0.0
                    w = np.frombuffer(used, np.float32).astype(np.float64)
                    total = total + np.frombuffer(change, np.float16).astype(np.float64).reshape(-1, WIDTH) * w[:, None]
                    weight = weight + w
            if chunk is not None:
                yield out()

        ddl = "chunk int, change binary, used binary"
        dealt = learn.where(F.col("turn") == turn).repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "units").select("shard", "units")
        # sorted by what the rows hold, so that the sum's order, and so its last digits, do not hang on the layout
        changed = dealt.mapInArrow(run, ddl).repartition("chunk").sortWithinPartitions("chunk", "change").mapInArrow(mean, ddl)
        current = current.copy()
        for r in changed.select("chunk", "change").collect():  # as many numbers as the model has parameters
            part = np.frombuffer(r.change, np.float32).reshape(-1, WIDTH)
            current[r.chunk * CHUNK : r.chunk * CHUNK + len(part)] += part
        sent.unpersist()
    return current


def score(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row (log10); the model is trained on the rows that are not held out."""
    model = count(docs)
    rows = cut(coded(docs, model))
    model.parameters = train(rows, model)
    return score_coded(rows, model)


def score_coded(rows: DataFrame, model: Model) -> DataFrame:
    inside = np.concatenate([np.zeros(COMMON), -np.log10(model.shared.sum(axis=0) + 1.0)])
    sent = rows.sparkSession.sparkContext.broadcast((model.parameters, inside))
    base_log = math.log10(model.total + model.types + 1)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])

    def run(batches):
        flat, inside = sent.value
        p = Parameters(flat)
        for batch in batches:
            column = batch.column(2)
            at = 0
            sizes = column.value_lengths().to_numpy() if hasattr(column, "value_lengths") else np.array([len(x) for x in column.to_pylist()])
            sizes = sizes // 2
            upto = np.cumsum(sizes)
            while at < batch.num_rows:  # about so many tokens at a time
                stop = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + 16 * BATCH, side="right")))
                part, mine = batch.slice(at, stop - at), sizes[at:stop]
                units = np.frombuffer(b"".join(part.column(2).to_pylist()), "<u2").astype(np.int64)
                first, ends = np.cumsum(mine) - mine, np.zeros(len(units), bool)
                ends[np.cumsum(mine) - 1] = True
                logs = p.log_probabilities(contexts_of(units, ends), units) / math.log(10) + inside[units]
                yield batch_of(schema, row=part.column(0), doc_id=part.column(1), n_tokens=mine, n_known=part.column(4), base=part.column(5), score=np.add.reduceat(logs, first) + part.column(6).to_numpy())
                at = stop

    by_text = rows.select("row", "doc_id", "units", "n", "n_known", "base", "own").mapInArrow(run, "row long, doc_id long, n_tokens long, n_known long, base double, score double")
    c = F.coalesce(F.col("c"), F.lit(0))
    rare = rows.select("row", F.inline(F.arrays_zip("words", "times"))).select("row", F.col("words").alias("word"), F.col("times").alias("n")).join(model.counts.withColumnRenamed("n", "c"), "word", "left")
    rare = rare.select("row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_tokens"), F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * (F.log10(c + 1) - base_log)).alias("base"), (F.col("n") * F.log10(c + 1)).alias("score"))
    out = by_text.unionByName(rare).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")
