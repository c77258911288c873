"""Token-id output: documents compressed one by one against a shared zstandard dictionary.

A dictionary is trained on serialized id arrays of a bounded sample of documents (of each up to SAMPLE_PIECES pieces of PIECE_IDS ids, spread
evenly from its beginning to its end); where the samples are too few to train on, they are the dictionary as they stand.  Ids are then written
as blocks: rows of a Parquet table, each holding up to BLOCK_TOKENS ids of consecutive documents as
independent zstandard frames (`payload`), the byte offset of each frame (`offsets`), the documents' ids
and token counts, the first and last doc_id (on which a look-up is pruned), the SHA-256 of the dictionary, and `start`, the number of ids in the earlier blocks of its part.
Blocks are in ascending doc_id order across and within files.  One document is read by finding its
block, taking its slice of `payload`, and decompressing that frame alone.

Null texts count as empty (the end id alone).  Repeated rows are separate documents, kept in a stable order
by text; a null doc_id sorts first.  An empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewise.llm.common import batch_of, bounded_sample, pieces, shared_path, texts, worker_state

BLOCK_TOKENS = 262_144
BLOCK_DOCS = 2_048
DICTIONARY_BYTES = 65_536
#: The dictionary is fitted on about so many documents, those with the smallest hash of doc_id.
SAMPLE_DOCS = 1_000
SAMPLE_PIECES, PIECE_IDS = 8, 1_024
#: Fewer samples, or less than four dictionaries of them, are not trained on.
LEAST_SAMPLES = 64
LEVEL = 3
WORD_CACHE = 600_000
PIECE_BYTES = 1 << 23

_BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int32())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary()), ("dictionary_sha256", pa.string()), ("start", pa.int64()), ("block_tokens", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64())])
_BLOCK_DDL = "part int, block int, doc_ids array<long>, n_tokens array<int>, offsets array<long>, payload binary, dictionary_sha256 string, start long, block_tokens long, first_doc long, last_doc long"


#: A full stop or comma between a letter (ASCII or Latin-1) and white space is a pre-token of its own; it is set apart, which
#: leaves fewer forms of words.
_STOP = "([a-zß-öø-ÿÀ-ÖØ-Þ])([.,])([ \\t\\n\\r\\f])"


class WordEncoder:
    """Whole-text encoding through tables of white-space separated words.

    Valid for tokenizers that drop white space, lower-case letters and never join text across white space (word_bpe_49k is one): the
    ids of a text are then the ids of its words in order.  Texts are split and their distinct words found by Arrow; words
    not in the tables go to the library in bulk; ids are put together by one numpy gather.
    """

    def __init__(self, path: str) -> None:
        pa.set_memory_pool(pa.system_memory_pool())  # gives large buffers back to the system at once
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words that are not in the young table, which gets them."""
        old, fresh = self.old, []
        known: dict[str, bytes] = {}
        for w in words:
            ids = old.get(w)
            if ids is None:
                fresh.append(w)
            else:
                known[w] = ids
        self._encode(fresh, known)
        if len(self.young) + len(known) > WORD_CACHE:
            self.old, self.young = self.young, {}
        self.young.update(known)
        return [known[w] for w in words]

    def _encode(self, words: list[str], into: dict[str, bytes]) -> None:
        """Words of letters alone are one pre-token, so many go to the library as one text and are told apart by the ends of words."""
        plain, other = [], []
        for w in words:
            (plain if len(w) < 100 and w.isalpha() else other).append(w)
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                other += part
                continue
            data, last = ids.tobytes(), 0
            for w, stop in zip(part, (stops * 4).tolist(), strict=True):
                into[w] = data[last:stop]
                last = stop
        if other:
            for w, got in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False), strict=True):
                into[w] = array("I", got.ids).tobytes()

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of each text of a string column (null: none) as little-endian unsigned 32-bit integers."""
        column = column.fill_null("")
        low = pc.replace_substring_regex(pc.ascii_lower(column), pattern=_STOP, replacement=r"\1 \2\3")
        special = pc.match_substring(column, "<|")  # may spell a special token: these stay as they are
        if pc.any(special).as_py():
            low = pc.if_else(special, column, low)
        split = pc.ascii_split_whitespace(low)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        ids = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(ids) if x is None]
        for i, x in zip(missing, self._learn([words[i] for i in missing]), strict=True):
            ids[i] = x
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        counts = sizes[at]
        upto = np.concatenate([[0], np.cumsum(counts)])
        tokens = pool[np.arange(upto[-1]) - np.repeat(upto[:-1] - first[at], counts)].tobytes()
        edges = (4 * upto[split.offsets.to_numpy() - split.offsets[0].as_py()]).tolist()
        return [tokens[a:b] for a, b in pairwise(edges)]


def encoder(path: str) -> WordEncoder:
    return worker_state(("words", path), lambda: WordEncoder(path))


def spread_pieces(ids: bytes) -> list[bytes]:
    """Up to SAMPLE_PIECES pieces of serialized ids, from the first to the last at equal distances; all of them, if they are few."""
    size = 4 * PIECE_IDS
    if len(ids) <= SAMPLE_PIECES * size:
        return [ids[i : i + size] for i in range(0, len(ids), size)]
    last = len(ids) // 4 - PIECE_IDS
    return [ids[4 * at : 4 * at + size] for at in (last * i // (SAMPLE_PIECES - 1) for i in range(SAMPLE_PIECES))]


def train_dictionary(docs: DataFrame, tokenizer_path: str, end_id: int, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A zstandard dictionary of id arrays (empty only if no document is)."""
    picked = bounded_sample(texts(docs), sample_docs, "doc_id", "text")
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        coder = encoder(tokenizer_path)
        for part in pieces(batches, "text", PIECE_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([p for x in coder.encode(part.column(0)) for p in spread_pieces(x + end)], pa.binary())], ["ids"])

    samples = sorted(bytes(r.ids) for r in picked.select("text").mapInArrow(run, "ids binary").collect())
    if len(samples) >= LEAST_SAMPLES and sum(map(len, samples)) >= 4 * DICTIONARY_BYTES:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    return b"".join(samples)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = _shared(dictionary)
    if shared:
        shared.precompute_compress(level=LEVEL)  # digested once, not for each document
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def _shared(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 2, block_docs: int = BLOCK_DOCS, block_tokens: int = BLOCK_TOKENS) -> None:
    """Encode every document and write the block table to `path`; a block ends with `block_docs` documents or so many bytes as `block_tokens` ids take."""
    dictionary = train_dictionary(docs, tokenizer_path, end_id)
    digest, end = hashlib.sha256(dictionary).hexdigest(), int(end_id).to_bytes(4, "little")

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        coder = encoder(tokenizer_path)
        squeeze = _compressor(dictionary)
        block, start, ids, counts, offsets, frames = 0, 0, [], [], [0], []

        def full():
            known = [k for k in ids if k is not None] or [None]  # ascending
            return batch_of(_BLOCK, part=[part], block=[block], doc_ids=[ids], n_tokens=[counts], offsets=[offsets], payload=[b"".join(frames)], dictionary_sha256=[digest], start=[start], block_tokens=[sum(counts)], first_doc=[known[0]], last_doc=[known[-1]])

        for part_of in pieces(batches, "text", PIECE_BYTES):
            for key, data in zip(part_of.column(0).to_pylist(), coder.encode(part_of.column(1)), strict=True):
                frame = squeeze.compress(data + end)
                ids.append(key)
                counts.append(len(data) // 4 + 1)
                frames.append(frame)
                offsets.append(offsets[-1] + len(frame))
                if len(ids) >= block_docs or offsets[-1] >= 4 * block_tokens:
                    yield full()
                    start += sum(counts)
                    block, ids, counts, offsets, frames = block + 1, [], [], [0], []
        if ids:
            yield full()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(run, _BLOCK_DDL)
    blocks.write.parquet(path)
    spark = docs.sparkSession
    if dictionary:
        spark.createDataFrame([(digest, dictionary)], "dictionary_sha256 string, dictionary binary").write.parquet(f"{path}-dictionary")


def starts(blocks: DataFrame) -> DataFrame:
    """part, before: ids in all earlier parts.  The window runs over one row a part, that is one a writing task."""
    totals = blocks.groupBy("part").agg(F.sum("block_tokens").alias("total"))
    return totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))


def read_tokens(spark, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) for each document, read back from the blocks."""
    blocks = spark.read.parquet(path)
    first = blocks.select("dictionary_sha256").first()
    dictionary = b""
    if first is not None and first[0] != hashlib.sha256(b"").hexdigest():
        dictionary = bytes(spark.read.parquet(f"{path}-dictionary").where(F.col("dictionary_sha256") == first[0]).first().dictionary)
    digest = hashlib.sha256(dictionary).hexdigest()
    fields = [("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)

    def run(batches):
        expand = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))
        for batch in batches:
            for row in range(batch.num_rows):
                x = batch.slice(row, 1).to_pylist()[0]
                if x["dictionary_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                payload, out = x["payload"], {f.name: [] for f in schema}
                at = x["start"]
                for key, n, (a, b) in zip(x["doc_ids"], x["n_tokens"], pairwise(x["offsets"]), strict=True):
                    data = expand.decompress(payload[a:b])
                    if len(data) != 4 * n:
                        raise ValueError(f"document {key}: {len(data)} bytes for {n} ids")
                    out["part"].append(x["part"])
                    out["doc_id"].append(key)
                    out["start"].append(at)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(data))
                    if with_ids:
                        out["ids"].append(np.frombuffer(data, "<u4").astype(np.int32))
                    at += n
                yield batch_of(schema, **out)

    ddl = "part int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    read = blocks.drop("block", "block_tokens", "first_doc", "last_doc").mapInArrow(run, ddl)
    more = ["ids"] * with_ids
    return read.join(starts(blocks.select("part", "block_tokens")), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", *more)


def read_document(spark, path: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (one list for each row of that doc_id), touching its block alone."""
    blocks = spark.read.parquet(path)
    # statistics of the files prune on first_doc and last_doc; of what is left, one block and its neighbours hold the document
    mine = blocks.where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    out = []
    for x in mine.select("doc_ids", "offsets", "payload", "dictionary_sha256").toLocalIterator():
        found = spark.read.parquet(f"{path}-dictionary").first() if x.dictionary_sha256 != hashlib.sha256(b"").hexdigest() else None
        expand = zstandard.ZstdDecompressor(dict_data=_shared(bytes(found.dictionary)) if found else None)
        for key, (a, b) in zip(x.doc_ids, pairwise(x.offsets), strict=True):
            if key == doc_id:
                out.append(np.frombuffer(expand.decompress(bytes(x.payload[a:b])), "<u4").tolist())
    return out


def tokenize_to_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write, then read back: what the files hold of every document."""
    path = path or shared_path(docs.sparkSession, "token-ids")
    write_tokens(docs, tokenizer_path, path, end_id)
    return read_tokens(docs.sparkSession, path)
