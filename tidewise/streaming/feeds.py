"""Structured Streaming over the observation feed: windows, dedup, stateful histories, control ticks (survey R1-R14, W1, W3, W16).

Late data: rows more than an hour behind the newest are dropped by the watermark."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DELAY = "1 hour"
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def shared(spark: SparkSession, name: str) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or "/tmp/checkpoints"
    return f"{base.rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"


def feed(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    """The table as a file stream, with ts as an event time."""
    raw = spark.readStream.schema(EVENTS).option("pathGlobFilter", f"{table}.parquet").parquet(sf_dir)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", DELAY)


def drained(stream: DataFrame, name: str, mode: str = "append", path: str | None = None) -> DataFrame:
    """Run a stream over all that is there, into Parquet in the shared folder, and read that; with a path used before, from where it stopped."""
    spark, path = stream.sparkSession, path or shared(stream.sparkSession, name)
    query = stream.writeStream.format("parquet").option("path", f"{path}/data").option("checkpointLocation", f"{path}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/data")


def tumbling(stream: DataFrame, width: str = "6 hours") -> DataFrame:
    counted = stream.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(stream: DataFrame, width: str = "12 hours", step: str = "6 hours") -> DataFrame:
    counted = stream.groupBy(F.window("ts", width, step).alias("w")).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), "n")


def first_seen(stream: DataFrame, *keys: str) -> DataFrame:
    """Each key once within the watermark's reach."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


HISTORY = "item long, changes long, observations long, last_kind string"


def _history(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, changes, seen = state.get if state.exists else (None, 0, 0)
    rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
    for kind in rows["event_type"]:
        changes += kind != last
        last, seen = kind, seen + 1
    state.update((last, int(changes), int(seen)))
    yield pd.DataFrame({"item": [key[0]], "changes": [changes], "observations": [seen], "last_kind": [last]})


def change_history(stream: DataFrame) -> DataFrame:
    """Append-on-change state of each item; a row for each item and micro-batch with its history's length so far."""
    return stream.groupBy("user_id").applyInPandasWithState(_history, HISTORY, "last string, changes long, seen long", "append", GroupStateTimeout.NoTimeout)


ALERTS = "item long, fired timestamp"


def _alerts(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last = state.get[0] if state.exists else None
    fired = []
    for ts in pd.concat(list(batches))["ts"].sort_values():
        second = ts.timestamp()
        if last is None or second - last >= 86_400:
            fired.append(ts)
            last = second
    state.update((last,))
    yield pd.DataFrame({"item": [key[0]] * len(fired), "fired": fired})


def alerts(stream: DataFrame) -> DataFrame:
    """Errors raise alerts, each item's silenced for a day after one (greedy, so kept in state)."""
    return stream.where("event_type = 'error'").groupBy("user_id").applyInPandasWithState(_alerts, ALERTS, "last double", "append", GroupStateTimeout.NoTimeout)


def run_control_ticks(stream: DataFrame, tick, name: str) -> str:
    """foreachBatch: `tick(batch)` sees each micro-batch as a whole (cohort maxima need that) and its result is appended; returns the path."""
    path = shared(stream.sparkSession, name)

    def on_batch(batch: DataFrame, number: int) -> None:
        tick(batch).withColumn("tick", F.lit(number)).write.mode("overwrite").parquet(f"{path}/data/tick={number}")

    stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return f"{path}/data"


LIMITS = "item long, learned double, observations long, resets long"


def _limits(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    last, seen, resets = state.get if state.exists else ([], 0, 0)
    last = list(last)
    rows = pd.concat(list(batches)).sort_values(["ts", "event_id"])
    for value in rows["value"]:
        resets += bool(last) and value < last[-1] - 5
        last = [*last, float(value)][-10:]
        seen += 1
    state.update((last, int(seen), int(resets)))
    yield pd.DataFrame({"item": [key[0]], "learned": [sorted(last)[len(last) // 2] if len(last) >= 3 else None], "observations": [seen], "resets": [resets]})


def learned_limits(stream: DataFrame) -> DataFrame:
    """The limit learned from each item's observations (survey R10): the middle one of the last ten, from three on, and how often the count fell back;
    a row for each item and micro-batch."""
    return stream.groupBy("user_id").applyInPandasWithState(_limits, LIMITS, "last array<double>, seen long, resets long", "append", GroupStateTimeout.NoTimeout)


def json_appended(stream: DataFrame, name: str) -> DataFrame:
    """The stream appended as JSON lines in the shared folder (survey K6), and read back."""
    spark, path = stream.sparkSession, shared(stream.sparkSession, name)
    stream.writeStream.format("json").option("path", f"{path}/data").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).json(f"{path}/data")


def run_cohort(stream: DataFrame, gains, plan, name: str) -> str:
    """Control ticks over a cohort (survey R2, R3, R5): each micro-batch's gains (item, day, delta) join the state, the whole cohort is planned anew
    (`plan` gives a dictionary of DataFrames of the state), and every result is written for the tick; returns the folder.

    The state is the gains seen so far, a table that is only appended to, so a tick that is run again after a failure overwrites its own part alone."""
    spark, path = stream.sparkSession, shared(stream.sparkSession, name)

    def on_batch(batch: DataFrame, number: int) -> None:
        gains(batch).write.mode("overwrite").parquet(f"{path}/state/batch={number}")
        state = spark.read.parquet(f"{path}/state").where(F.col("batch") <= number).groupBy("item", "day").agg(F.sum("delta").alias("delta"))
        for what, rows in plan(state).items():
            rows.write.mode("overwrite").parquet(f"{path}/{what}/tick={number}")

    stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{path}/offsets").trigger(availableNow=True).start().awaitTermination()
    return path
