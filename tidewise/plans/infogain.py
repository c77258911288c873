"""Snapshot merge and information-gain plans (survey J1-J5, A7, A12-A18, W3, W4, W6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(observed: DataFrame) -> DataFrame:
    """The last score and kind of each item."""
    order = F.struct("sec", "seq")
    return observed.groupBy("item").agg(F.max_by("score", order).alias("score"), F.max_by("kind", order).alias("kind"))


def merge_snapshots(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row an item of either snapshot, with what became of it (a full outer join on the item)."""
    a = old.select("item", F.col("score").alias("old_score"), F.col("kind").alias("old_kind"), F.lit(True).alias("_a"))
    b = new.select("item", F.col("score").alias("new_score"), F.col("kind").alias("new_kind"), F.lit(True).alias("_b"))
    j = a.join(b, "item", "full_outer")
    rescored, edited = F.col("old_score") != F.col("new_score"), F.col("old_kind") != F.col("new_kind")
    return j.select(
        "item",
        F.col("_a").isNull().alias("is_new"),
        F.col("_b").isNull().alias("is_absent"),
        (F.col("_a").isNotNull() & F.col("_b").isNotNull() & (rescored | edited)).alias("is_updated"),
        F.coalesce(F.col("new_score") - F.col("old_score"), F.lit(0.0)).alias("score_delta"),
        F.abs(F.coalesce(F.length("new_kind"), F.length("old_kind")) - F.coalesce(F.length("old_kind"), F.lit(0))).alias("chars"),
        rescored.alias("rescored"),
        edited.alias("edited"),
    )


def absences(present: DataFrame) -> DataFrame:
    """item, day, present, absent: the grid of every item and snapshot day since its first, with the run of absences so far.

    The grid is each item's range of days met with the known snapshot days by an equi-join, never a cross join."""
    span = present.agg(F.max("day").alias("last_day"))
    firsts = present.groupBy("item").agg(F.min("day").alias("first_day"))
    grid = firsts.join(F.broadcast(span)).select("item", F.explode(F.sequence("first_day", "last_day")).alias("day"))  # span is one row
    snaps = present.select("day").distinct()
    marked = grid.join(snaps, "day", "left_semi").join(present.withColumn("_p", F.lit(True)), ["item", "day"], "left").select("item", "day", F.coalesce("_p", F.lit(False)).alias("present"))
    island = F.sum(F.col("present").cast("int")).over(Window.partitionBy("item").orderBy("day"))
    run = F.sum((~F.col("present")).cast("int")).over(Window.partitionBy("item", "_island").orderBy("day"))
    return marked.withColumn("_island", island).withColumn("absent", run.cast("long")).drop("_island")


def curve_metrics(gains: DataFrame, dormant_run: int = 2, eps: float = 1e-6) -> DataFrame:
    """Half-life, time to dormancy, waste and decay rate of each item's gain curve (item, day, delta); one shuffle by item."""
    w = Window.partitionBy("item")
    ordered = w.orderBy("day")
    run = ordered.rowsBetween(0, dormant_run - 1)
    c = (
        gains.withColumn("t", (F.col("day") - F.min("day").over(w)) * 24.0)
        .withColumn("cum", F.sum("delta").over(ordered))
        .withColumn("total", F.sum("delta").over(w))
        .withColumn("top", F.max("delta").over(w))
        .withColumn("quiet", (F.max("delta").over(run) == 0) & (F.count("*").over(run) == dormant_run))
    )
    log_share = F.ln(F.least(F.greatest(F.col("delta") / (F.col("top") + eps), F.lit(eps)), F.lit(1.0)))
    m = c.groupBy("item").agg(
        F.count("*").alias("snapshots"),
        F.max("total").alias("total"),
        F.max("t").alias("duration"),
        F.min(F.when((F.col("total") > 0) & (F.col("cum") >= F.col("total") / 2 - 1e-9), F.col("t"))).alias("half_life"),
        F.min(F.when(F.col("quiet"), F.col("t"))).alias("dormancy"),
        (1 - F.avg(F.when(F.col("delta") > 0, 1.0).otherwise(0.0))).alias("waste"),
        F.regr_slope(log_share, F.col("t")).alias("slope"),
    )
    lam = F.when((F.col("snapshots") >= 3) & (F.col("total") > 0), F.greatest(-F.col("slope"), F.lit(0.0)))
    return m.select("item", "snapshots", *[F.round(x, 6).alias(x) for x in ("total", "duration", "half_life", "dormancy", "waste")], F.round(lam, 6).alias("lambda_hat"))


def velocities(observed: DataFrame, least_minutes: float = 10) -> DataFrame:
    """Score change a minute between an item's first and last observation; 0 if they are too near."""
    order = F.struct("sec", "seq")
    v = observed.groupBy("item").agg(F.min_by("score", order).alias("a"), F.max_by("score", order).alias("b"), ((F.max("sec") - F.min("sec")) / 60).alias("minutes"), F.count("*").alias("n"))
    return v.withColumn("velocity", F.when(F.col("minutes") > least_minutes, (F.col("b") - F.col("a")) / F.col("minutes")).otherwise(0.0))
