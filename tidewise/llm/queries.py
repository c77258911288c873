"""The llm subpackage's registered queries: (spark, sf_dir) -> DataFrame, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.llm import ann, bpe, decontam, lm, quality, simhash, substring, sufarray, tokenids, toxicity

BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOXIC_AT = 0.7


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup(table(spark, sf_dir, "documents"), window=20)


#: Grades: 0 poor text, 1 good text that is toxic, 2 good text.  Selection is by P(grade >= 1).
GRADES, KEEP_TAIL, KEEP_AT = 3, 1, 0.5


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratings = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    graded = quality.grade(docs, quality.fit(docs, ratings, GRADES), KEEP_TAIL)
    return graded.select("doc_id", quality.held_out().alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= KEEP_AT).alias("keep"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN, with_ids=False)


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", lm.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sufarray.dedup(table(spark, sf_dir, "documents"), length=200)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.tokenize_to_files(table(spark, sf_dir, "documents"), WORD_TOKENIZER, END_ID)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_decontamination": op3_decontamination,
    "op4_substring": op4_substring,
    "op5_quality": op5_quality,
    "op6_bpe": op6_bpe,
    "op7_lm": op7_lm,
    "op8_neighbours": op8_neighbours,
    "op9_suffix_array": op9_suffix_array,
    "op10_token_ids": op10_token_ids,
}
#: The other nine have no SQL: hashes, tokenizers, models, edit distances and byte windows are beyond it, or too slow on whole tables.
SQL: dict[str, str] = {
    "op4_substring": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM d),
  k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i : i + 19], ' ') ORDER BY doc_id, i) AS n FROM p),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM k WHERE n > 1),
  words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
  kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
}
