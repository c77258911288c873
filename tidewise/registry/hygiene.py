"""Validation and repair of histories, selects over telemetry as views, staggered schedules, resumed and late streams, policy simulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewise.operators import hygiene
from tidewise.plans import scheduler, simulation
from tidewise.registry.base import DELTAS, deltas, query, r6, table
from tidewise.registry.scheduling import STATE, TODAY
from tidewise.streaming import feeds


@query(
    f"""WITH {DELTAS}, raw AS (SELECT item, day FROM deltas WHERE n_new + n_edit + n_score + n_delete > 0), merged AS (SELECT item, day FROM deltas WHERE day < 25)
SELECT item, count(r.day) AS raw, count(m.day) AS merged, count(*) FILTER (m.day IS NULL) AS missing, count(*) FILTER (r.day IS NULL) AS extra, CAST(min(m.day) AS INT) AS first, CAST(max(m.day) AS INT) AS last FROM raw r FULL JOIN merged m USING (item, day) GROUP BY item"""
)
def q_history_validation(spark, sf_dir):
    d = deltas(spark, sf_dir)
    return hygiene.validated(d.where("n_new + n_edit + n_score + n_delete > 0"), d.where("day < 25"), "item", "day")


@query(
    """SELECT user_id AS item, count(*) AS before, CASE WHEN user_id % 3 = 0 THEN count(*) ELSE count(*) FILTER (event_type <> 'error') END AS after, user_id % 3 <> 0 AND count(*) FILTER (event_type = 'error') > 0 AS fixed FROM events GROUP BY user_id"""
)
def q_history_repair(spark, sf_dir):
    """Null marks in histories of what is not deleted are taken out."""
    entry = F.struct("event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))
    h = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("item")).agg(F.sort_array(F.collect_list(entry)).alias("h")).withColumn("deleted", F.col("item") % 3 == 0)
    return h.select("item", F.size("h").cast("long").alias("before"), F.size(hygiene.repaired(F.col("h"), F.col("deleted"))).cast("long").alias("after"), hygiene.null_marks(F.col("h"), F.col("deleted")).alias("fixed"))


TELEMETRY = "SELECT user_id % 25 AS community, event_id AS post_id, CAST(floor(value) AS BIGINT) AS requests_used, event_id % 7 AS delta_info FROM events"


def _telemetry(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 25).alias("community"), F.col("event_id").alias("post_id"), F.floor("value").cast("long").alias("requests_used"), (F.col("event_id") % 7).alias("delta_info"))
    rows.createOrReplaceTempView("scrape_telemetry")


@query(f"WITH scrape_telemetry AS ({TELEMETRY}) SELECT community, post_id, requests_used, delta_info FROM scrape_telemetry ORDER BY requests_used DESC, post_id LIMIT 50")
def q_costly_posts(spark, sf_dir):
    _telemetry(spark, sf_dir)
    return spark.sql("SELECT community, post_id, requests_used, delta_info FROM scrape_telemetry ORDER BY requests_used DESC, post_id LIMIT 50")


@query(f"WITH scrape_telemetry AS ({TELEMETRY}) SELECT post_id, community, round(delta_info / requests_used::DOUBLE, 6) AS vpr FROM scrape_telemetry WHERE requests_used > 50 ORDER BY vpr DESC, post_id")
def q_value_outliers(spark, sf_dir):
    _telemetry(spark, sf_dir)
    return spark.sql("SELECT post_id, community, round(delta_info / requests_used, 6) AS vpr FROM scrape_telemetry WHERE requests_used > 50 ORDER BY vpr DESC, post_id")


@query(f"WITH {STATE} SELECT item, round(day * 24.0::DOUBLE + interval * (1 + (CAST('0x' || substr(md5(CAST(item AS VARCHAR)), 1, 8) AS BIGINT) % 3001) / 10000.0::DOUBLE - 0.15::DOUBLE), 6) AS due FROM dt")
def q_staggered_due(spark, sf_dir):
    """Due times moved by up to 15 % either way, by a hash of the item, so that items that came together do not stay together."""
    warm = scheduler.temperatures(scheduler.states(deltas(spark, sf_dir).select("item", "day", "delta")), TODAY)
    return scheduler.queue(warm, TODAY, stagger=True).select("item", r6(F.col("due"), "due"))


@query("SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def q_stream_resume(spark, sf_dir):
    """A stream drained in two runs over one checkpoint: the second takes up where the first stopped, and nothing comes twice."""
    path, out = feeds.shared(spark, "landed"), feeds.shared(spark, "resumed")
    events = table(spark, sf_dir, "events")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(path)
        got = feeds.drained(spark.readStream.schema(feeds.EVENTS).parquet(path), "resumed", path=out)
    return got.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    """SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, event_type, n FROM (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS start, event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL)
WHERE start + INTERVAL 6 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
)
def q_stream_late(spark, sf_dir):
    """Windows after the newer half came first: the older half is behind the watermark by then and is dropped."""
    path, out = feeds.shared(spark, "landed"), feeds.shared(spark, "late")
    events, cut = table(spark, sf_dir, "events"), F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (F.col("ts") >= cut, F.col("ts") < cut):
        events.where(part).write.mode("append").parquet(path)
        stream = spark.readStream.schema(feeds.EVENTS).parquet(path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", feeds.DELAY)
        got = feeds.drained(feeds.tumbling(stream), "late", path=out)
    return got.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


@query()
def q_policy_simulation(spark, sf_dir):
    """Runs of the policy under random decay, bursts and stalls; no SQL gives the same draws, so its rows alone are checked."""
    return simulation.simulate(spark, table(spark, sf_dir, "nation").count()).select("seed", r6(F.col("gained"), "gained"), r6(F.col("waste"), "waste"))
