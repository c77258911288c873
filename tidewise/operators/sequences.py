"""Ordered-sequence operators: change histories, streaks, last-k windows, folds (survey W1-W23, A23, A33-A36)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewise.operators import relational


def by(keys: list[str], *order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def changes(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows whose value differs from the one before (the first row too): append-on-change history."""
    before = F.lag(value).over(by(keys, *order))
    first = F.row_number().over(by(keys, *order)) == 1
    return df.withColumn("_keep", first | ~F.col(value).eqNullSafe(before)).where("_keep").drop("_keep")


def streak(df: DataFrame, keys: list[str], order: list[str], hit: Column, name: str) -> DataFrame:
    """Length of the run of hits that ends at each row (0 on a miss)."""
    w = by(keys, *order).rowsBetween(Window.unboundedPreceding, 0)
    misses = F.sum(F.when(hit, 0).otherwise(1)).over(w)
    marked = df.withColumn("_island", misses).withColumn("_hit", hit)
    inside = by([*keys, "_island"], *order).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn(name, F.sum(F.col("_hit").cast("int")).over(inside).cast("long")).drop("_island", "_hit")


def last_k(keys: list[str], order: list[str], k: int) -> Window:
    return by(keys, *order).rowsBetween(-(k - 1), 0)


def sorted_steps(df: DataFrame, keys: list[str], order: list[str], *fields: str) -> DataFrame:
    """One row a key with its steps as a sorted array of structs, for folds; meant for keys with bounded histories."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("steps"))


def fold_ema(steps: Column, start: float, alpha: float, target: float, eta: float, low: float, high: float) -> Column:
    """The rate controller: struct of ema and gain after the last `rps`, of the highest gain and the number of steps; the ema has a floor at a
    fifth of the target."""
    zero = F.struct(F.lit(start).alias("ema"), F.lit(1.0).alias("gain"), F.lit(0.0).alias("top_gain"), F.lit(0).cast("long").alias("steps"))

    def step(last: Column, x: Column) -> Column:
        ema = F.greatest(alpha * x["rps"] + (1 - alpha) * last["ema"], F.lit(0.2 * target))
        gain = F.least(F.greatest(last["gain"] * F.exp(eta * (ema / target - 1.0)), F.lit(low)), F.lit(high))
        return F.struct(ema.alias("ema"), gain.alias("gain"), F.greatest(last["top_gain"], gain).alias("top_gain"), (last["steps"] + 1).alias("steps"))

    return F.aggregate(steps, zero, step)


def fold_cooldown(steps: Column, seconds: float) -> Column:
    """Alerts that fire, each suppressing those within `seconds` after it (greedy, from the left): struct of their number and the last one's time."""
    zero = F.struct(F.lit(None).cast("double").alias("fired"), F.lit(0).cast("long").alias("alerts"))

    def step(last: Column, x: Column) -> Column:
        quiet = F.coalesce(x["sec"] - last["fired"] < seconds, F.lit(False))
        return F.when(quiet, last).otherwise(F.struct(x["sec"].cast("double").alias("fired"), (last["alerts"] + 1).alias("alerts")))

    return F.aggregate(F.filter(steps, lambda x: x["sec"].isNotNull()), zero, step)


def fold_bucket(steps: Column, capacity: float, per_second: float) -> Column:
    """A token bucket over requests in order, each of which takes a token if there is one: struct of the last time, the tokens left, requests and grants."""
    zero = F.struct(F.element_at(steps, 1)["sec"].alias("sec"), F.lit(capacity).alias("tokens"), F.lit(0).cast("long").alias("requests"), F.lit(0).cast("long").alias("granted"))

    def step(last: Column, x: Column) -> Column:
        have = F.least(F.lit(capacity), last["tokens"] + (x["sec"] - last["sec"]) * per_second)
        can = (have >= 1).cast("long")
        return F.struct(x["sec"].alias("sec"), (have - can).alias("tokens"), (last["requests"] + 1).alias("requests"), (last["granted"] + can).alias("granted"))

    return F.aggregate(steps, zero, step)


def fold_backoff(steps: Column, start: float = 2.0, cap: float = 256.0) -> Column:
    """The shared wait between requests (survey M13): doubled by a refusal up to the cap, halved by a success down to the start; struct of
    the last wait and the longest."""

    def step(last: Column, x: Column) -> Column:
        wait = F.when(x["refused"], F.least(last["wait"] * 2, F.lit(cap))).otherwise(F.greatest(last["wait"] / 2, F.lit(start)))
        return F.struct(wait.alias("wait"), F.greatest(last["longest"], wait).alias("longest"))

    return F.aggregate(steps, F.struct(F.lit(start).alias("wait"), F.lit(start).alias("longest")), step)


def requests_in_window(df: DataFrame, keys: list[str], seconds: str, width: int, name: str, stretch: int = 86_400) -> DataFrame:
    """For each row the rows of its key in the `width` seconds up to it (seconds is a column of whole numbers).

    Windows are partitioned by stretches of time, so a busy key is many tasks."""
    cut = relational.in_stretches(df, F.col(seconds), stretch, width)
    w = Window.partitionBy(*keys, "_stretch").orderBy(seconds).rangeBetween(-width, 0)
    return cut.withColumn(name, F.count("*").over(w)).where("_own").drop("_own", "_stretch")


def mean_of_last(df: DataFrame, keys: list[str], order: list, value: str, k: int, name: str, stretch: int = 10_000) -> DataFrame:
    """For each row the mean of the k rows of its key before it; rows are numbered over ranges and windows partitioned by stretches of numbers."""
    placed = relational.running(df, keys, order, F.lit(1), "_place")
    cut = relational.in_stretches(placed, F.col("_place"), stretch, k)
    w = Window.partitionBy(*keys, "_stretch").orderBy("_place").rowsBetween(-k, -1)
    return cut.withColumn(name, F.avg(value).over(w)).where("_own").drop("_own", "_stretch", "_place")
