"""Streaming queries, each drained over the events table, with the batch SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewise.functions import models
from tidewise.plans import scheduler
from tidewise.registry.base import OBS, deltas_of, query, r6, table
from tidewise.registry.scheduling import STATE, TODAY
from tidewise.streaming import feeds


@query(
    """SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n, total FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL)
WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
)
def q_stream_tumbling(spark, sf_dir):
    done = feeds.drained(feeds.tumbling(feeds.feed(spark, sf_dir)), "tumbling")
    return done.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, count(*) AS n FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL (6 * k) HOUR AS start, ts FROM events, (VALUES (0), (1)) v(k))
WHERE start + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY start"""
)
def q_stream_sliding(spark, sf_dir):
    done = feeds.drained(feeds.sliding(feeds.feed(spark, sf_dir)), "sliding")
    return done.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n")


@query("SELECT DISTINCT user_id, event_type FROM events")
def q_stream_dedup(spark, sf_dir):
    return feeds.drained(feeds.first_seen(feeds.feed(spark, sf_dir), "user_id", "event_type"), "dedup").select("user_id", "event_type").distinct()


@query(
    """SELECT user_id AS item, count(*) FILTER (n = 1 OR event_type IS DISTINCT FROM before) AS changes, count(*) AS observations, arg_max(event_type, event_id) AS last_kind
FROM (SELECT *, lag(event_type) OVER w AS before, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id"""
)
def q_stream_history(spark, sf_dir):
    """The state after the last micro-batch, kept by a control tick."""
    path = feeds.run_control_ticks(feeds.change_history(feeds.feed(spark, sf_dir)), lambda batch: batch, "history")
    rows = spark.read.parquet(path)
    return rows.groupBy("item").agg(F.max_by(F.struct("changes", "observations", "last_kind"), "tick").alias("x")).select("item", "x.*")


@query(
    """WITH RECURSIVE e AS (SELECT user_id AS item, epoch_us(ts) / 1e6 AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'error'),
f AS (SELECT item, n, s AS fired, 1 AS alerts FROM e WHERE n = 1 UNION ALL SELECT e.item, e.n, CASE WHEN e.s - f.fired < 86400 THEN f.fired ELSE e.s END, CASE WHEN e.s - f.fired < 86400 THEN f.alerts ELSE f.alerts + 1 END FROM f JOIN e ON e.item = f.item AND e.n = f.n + 1)
SELECT item, CAST(max(alerts) AS BIGINT) AS alerts FROM f GROUP BY item"""
)
def q_stream_alerts(spark, sf_dir):
    return feeds.drained(feeds.alerts(feeds.feed(spark, sf_dir)), "alerts").groupBy("item").agg(F.count("*").alias("alerts"))


@query(f"WITH {OBS}, l AS (SELECT item, score, row_number() OVER (PARTITION BY item ORDER BY sec DESC, seq DESC) AS back, lag(score) OVER (PARTITION BY item ORDER BY sec, seq) AS before FROM obs), a AS (SELECT item, list_sort(list(score) FILTER (back <= 10)) AS x, count(*) AS observations, count(*) FILTER (score < before - 5) AS resets FROM l GROUP BY item) SELECT item, x[len(x) // 2 + 1] AS learned, observations, resets FROM a WHERE len(x) >= 3")
def q_stream_learned_limit(spark, sf_dir):
    path = feeds.run_control_ticks(feeds.learned_limits(feeds.feed(spark, sf_dir)), lambda batch: batch, "limits")
    last = spark.read.parquet(path).groupBy("item").agg(F.max_by(F.struct("learned", "observations", "resets"), "tick").alias("x"))
    return last.select("item", "x.*").where("learned is not null")


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events")
def q_stream_json_append(spark, sf_dir):
    rows = feeds.json_appended(feeds.feed(spark, sf_dir), "json")
    return rows.select("event_id", "user_id", "event_type", r6(F.col("value"), "value"))


def _cohort(spark, sf_dir):
    """Events landed in three files, one a tick, in no promised order: the last tick has seen all of them."""
    path = feeds.shared(spark, "landed")
    table(spark, sf_dir, "events").repartitionByRange(3, "ts").write.parquet(path)
    stream = spark.readStream.schema(feeds.EVENTS).option("maxFilesPerTrigger", 1).parquet(path)

    def plan(state):
        warm = scheduler.temperatures(scheduler.states(state), TODAY)
        reason = models.retirement_reason(F.col("scrapes"), F.col("zero_streak"), F.col("recent_top") == 0, (TODAY - F.col("last_gain_day")) * 24.0, (TODAY - F.col("day")) * 24.0, F.lit(False), 3, 4, 72.0)
        marked = scheduler.queue(warm, TODAY).withColumn("reason", reason)
        priors = marked.where("reason is not null").groupBy((F.col("item") % 25).cast("long").alias("sub")).agg(F.count("*").alias("retired"), F.avg("rate").alias("mean_rate"))
        return {"queue": marked.where("reason is null"), "priors": priors}

    path = feeds.run_cohort(stream, lambda batch: deltas_of(batch).select("item", "day", "delta"), plan, "cohort")
    ticks = spark.read.parquet(f"{path}/queue")
    last = ticks.agg(F.max("tick")).first()[0]
    return spark.read.parquet(f"{path}/queue/tick={last}"), spark.read.parquet(f"{path}/priors/tick={last}")


RETIRED = f"scrapes >= 3 AND (zero_streak >= 4 OR recent_top = 0 OR coalesce(({TODAY} - last_gain_day) * 24.0 >= 72, false) OR ({TODAY} - day) * 24.0 >= 108)"


@query(f"WITH {STATE} SELECT item, round(due, 6) AS due, round(lateness, 4) AS lateness, round(temperature / (1 + 0.15::DOUBLE * lateness * interval), 6) AS priority FROM queue WHERE NOT ({RETIRED})")
def q_stream_control_ticks(spark, sf_dir):
    """The queue after the last control tick: cohort maxima, temperatures, intervals and lateness of all items that are not retired."""
    queue, _ = _cohort(spark, sf_dir)
    return queue.select("item", r6(F.col("due"), "due"), F.round("lateness", 4).alias("lateness"), r6(F.col("priority"), "priority"))


@query(f"WITH {STATE} SELECT CAST(item % 25 AS BIGINT) AS sub, count(*) AS retired, round(avg(rate), 6) AS mean_rate FROM queue WHERE {RETIRED} GROUP BY item % 25")
def q_stream_retired_priors(spark, sf_dir):
    """What retired items leave to their group: their number and mean rate."""
    _, priors = _cohort(spark, sf_dir)
    return priors.select("sub", "retired", r6(F.col("mean_rate"), "mean_rate"))
