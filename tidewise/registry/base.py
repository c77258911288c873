"""What the query modules share: table access, the domain reading of the tables, a registry with SQL beside each query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewise.functions import models, temporal

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations of items: item, seq, at (seconds), score, kind."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("item"), F.col("event_id").alias("seq"), temporal.epoch(F.col("ts")).alias("sec"), F.col("value").alias("score"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts")
    )


#: The same reading in SQL, to begin a WITH list.
OBS = "obs AS (SELECT user_id AS item, event_id AS seq, epoch_us(ts) / 1e6::DOUBLE AS sec, value AS score, event_type AS kind, ts FROM events)"


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deltas_of(table(spark, sf_dir, "events"))


def deltas_of(events: DataFrame) -> DataFrame:
    """Information gain of each item and day: signups are new items, purchases edits, clicks score changes, errors deletions, views nothing."""
    kinds = {"n_new": "signup", "n_edit": "purchase", "n_score": "click", "n_delete": "error"}
    days = events.withColumn("day", F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")))
    counted = days.groupBy(F.col("user_id").alias("item"), "day").agg(*[F.count_if(F.col("event_type") == k).alias(n) for n, k in kinds.items()])
    return counted.withColumn("delta", models.delta_info(F.col("n_new"), F.col("n_edit"), F.col("n_score"), F.col("n_delete")))


DELTAS = """days AS (SELECT user_id AS item, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
    count(*) FILTER (event_type = 'signup') AS n_new, count(*) FILTER (event_type = 'purchase') AS n_edit,
    count(*) FILTER (event_type = 'click') AS n_score, count(*) FILTER (event_type = 'error') AS n_delete
  FROM events GROUP BY ALL),
  deltas AS (SELECT *, 1.0::DOUBLE * n_new + 0.5::DOUBLE * n_edit + 0.2::DOUBLE * n_score + 0.1::DOUBLE * n_delete AS delta FROM days)"""


def thread_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as threads that branch: a turn answers the turn at half its number (turn 0 is the root)."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("thread"), F.col("turn").alias("node"), F.when(F.col("turn") > 0, F.floor((F.col("turn") - 1) / 2)).alias("parent"), F.col("role").alias("author"), F.coalesce("text", F.lit("")).alias("text")
    )


NODES = "nodes AS (SELECT conv_id AS thread, turn AS node, CASE WHEN turn > 0 THEN CAST(floor((turn - 1) / 2) AS BIGINT) END AS parent, role AS author, coalesce(text, '') AS text FROM conversations)"
CLOSURE = """closure AS (SELECT thread, node, node AS ancestor, 0 AS distance FROM nodes
  UNION ALL SELECT c.thread, c.node, n.parent, c.distance + 1 FROM closure c JOIN nodes n ON n.thread = c.thread AND n.node = c.ancestor
    WHERE n.parent IS NOT NULL AND EXISTS (SELECT 1 FROM nodes p WHERE p.thread = n.thread AND p.node = n.parent))"""


def r6(column, name: str):
    """Rounded to six places, for comparison with SQL."""
    return F.round(column, 6).alias(name)
