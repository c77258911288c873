"""Data quality of merged histories: validation against what was observed, audits, repair (survey 2.14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def validated(raw: DataFrame, merged: DataFrame, key: str, ts: str) -> DataFrame:
    """A row for each key of raw or merged (both: key, ts): times in each, times in one and not in the other, first and last merged.

    The sides meet on (key, ts), so a long history is many rows and never one array."""
    a = raw.select(key, ts).distinct().withColumn("_raw", F.lit(True))
    b = merged.select(key, ts).distinct().withColumn("_merged", F.lit(True))
    both = a.join(b, [key, ts], "full_outer")
    inside, outside = F.col("_raw").isNotNull(), F.col("_merged").isNotNull()
    return both.groupBy(key).agg(
        F.count_if(inside).alias("raw"), F.count_if(outside).alias("merged"), F.count_if(inside & ~outside).alias("missing"), F.count_if(outside & ~inside).alias("extra"),
        F.min(F.when(outside, F.col(ts))).alias("first"), F.max(F.when(outside, F.col(ts))).alias("last"),
    )


def null_marks(history: Column, deleted: Column) -> Column:
    """A value that is null marks a deletion; in a history that is not deleted it is an error."""
    return F.exists(history, lambda e: e["value"].isNull()) & ~deleted


def repaired(history: Column, deleted: Column) -> Column:
    return F.when(null_marks(history, deleted), F.filter(history, lambda e: e["value"].isNotNull())).otherwise(history)
