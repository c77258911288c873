"""A training-data pipeline over `documents`: five stages, each a filter or transform by one llm operator.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame that is written as
Parquet and reread as the next one's docs.  All but the last return the columns of documents: doc_id, text, lang, source,
n_chars.  Rows with a null doc_id pass the filters that cannot judge them.  No stage can be expressed in SQL as a
whole, so ORACLE_SQL is None and the stages are tested against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.llm import bpe, decontam, simhash, sufarray, toxicity
from tidewise.llm.common import cut, is_small, remove, shared_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOXIC_AT = 0.7
SHINGLE_WORDS, SIMILARITY = 5, 0.8
REPEAT_BYTES = 200
BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores under TOXIC_AT stay."""
    detector = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return detector.flag(docs, TOXIC_AT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id stays (once, if its row is repeated).

    Which ones stay is known before a text is read, so while they are few texts are filtered as they pass, by a broadcast, instead of being shuffled."""
    groups = simhash.similar_groups(docs, SHINGLE_WORDS, SIMILARITY)
    first = cut(groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n_rows")))

    def rows(chosen):
        return docs.select(*COLUMNS).join(F.broadcast(chosen) if is_small(chosen) else chosen, "doc_id", "left_semi")

    once, often = rows(first.where("n_rows = 1").select("doc_id")), rows(first.where("n_rows > 1").select("doc_id")).dropDuplicates(["doc_id"])
    return once.unionByName(often).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by strings of REPEAT_BYTES bytes that occur elsewhere are cut out of the texts; documents left empty go."""
    left = sufarray.dedup(docs, REPEAT_BYTES, detail=True).where("doc_id is not null").select("doc_id", F.col("kept_text").alias("text"), F.col("n_removed") > 0)
    left = left.toDF("doc_id", "text", "was_cut")
    rest = docs.where("doc_id is not null").select("doc_id", "lang", "source", "n_chars").dropDuplicates(["doc_id"])
    n_chars = F.when(F.col("was_cut"), F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    kept = left.join(rest, "doc_id").where("not was_cut or length(trim(text)) > 0").select("doc_id", "text", "lang", "source", n_chars)
    return kept.unionByName(docs.where("doc_id is null").select(*COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and digests of what is left."""
    return bpe.encode_documents(docs, BPE_RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each written and read again; what the next stage has read is removed."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
