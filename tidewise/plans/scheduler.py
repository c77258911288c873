"""Scheduling plans over per-item gains: recent rate, temperature, interval, queue, retirement (survey A23, M2-M7, M14, T8, T9, W10, W11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewise.functions import models
from tidewise.operators import sequences


def states(gains: DataFrame, k: int = 5) -> DataFrame:
    """One row an item: rate and volatility of its last k gains (hours between their days), last day seen and last day with a gain, zero streak."""
    w = Window.partitionBy("item").orderBy("day")
    last = sequences.last_k(["item"], ["day"], k)
    zeros = sequences.streak(gains, ["item"], ["day"], F.col("delta") == 0, "zero_streak")
    hours = F.coalesce(F.nullif((F.col("day") - F.min("day").over(last)) * 24.0, F.lit(0.0)), F.lit(1e-6))
    n = F.count("*").over(last)
    with_stats = zeros.select(
        "item", "day", "delta", "zero_streak",
        F.when(n >= 2, F.sum("delta").over(last) / hours).otherwise(F.col("delta")).alias("rate"),
        F.coalesce(F.stddev_samp("delta").over(last), F.lit(0.0)).alias("volatility"),
        F.last(F.when(F.col("delta") > 0, F.col("day")), ignorenulls=True).over(w).alias("last_gain_day"),
        F.max("delta").over(last).alias("recent_top"),
        F.count("*").over(w).alias("scrapes"),
    )
    picked = F.max_by(F.struct("day", "rate", "volatility", "last_gain_day", "zero_streak", "recent_top", "scrapes"), "day")
    return with_stats.groupBy("item").agg(picked.alias("s")).select("item", "s.*")


def temperatures(state: DataFrame, today: int, lam: float = 0.15) -> DataFrame:
    """state with temperature; the cohort's maxima are one row, joined to all."""
    tops = state.agg(F.max("rate").alias("top_rate"), F.max("volatility").alias("top_volatility"))
    idle = F.greatest((today - F.coalesce("last_gain_day", "day")) * 24.0, F.lit(0.0))
    t = models.temperature(F.col("rate"), F.col("top_rate"), F.lit(lam), idle, F.col("volatility"), F.col("top_volatility"))
    return state.join(F.broadcast(tops)).withColumn("temperature", t)  # tops is one row


def queue(warm: DataFrame, today: int, lam: float = 0.15, stagger: bool = False) -> DataFrame:
    """warm with interval, due (hours since day 0), lateness and priority; `stagger` moves due by up to 15 % by a hash of the item."""
    dt = models.young_or_idle_interval(models.interval_hours(F.col("temperature")), F.col("scrapes"), F.col("zero_streak"))
    drawn = F.conv(F.substring(F.md5(F.col("item").cast("string").cast("binary")), 1, 8), 16, 10).cast("long")
    shift = (drawn % 3001 / 10_000.0 - 0.15) if stagger else F.lit(0.0)
    q = warm.withColumn("interval", dt).withColumn("due", F.col("day") * 24.0 + F.col("interval") * (1 + shift))
    late = F.greatest((today * 24.0 - F.col("due")) / F.col("interval"), F.lit(0.0))
    fresh = F.col("last_gain_day").isNotNull() & ((today - F.col("last_gain_day")) * 24.0 < F.col("interval"))
    phi = F.when(fresh, F.least(late, F.lit(0.25))).otherwise(late)
    return q.withColumn("lateness", phi).withColumn("priority", models.priority(F.col("temperature"), F.lit(lam), phi, F.col("interval")))
