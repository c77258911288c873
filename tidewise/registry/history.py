"""Histories of observed items: change lists, absence, merges, information gain and its curve metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewise.functions import models
from tidewise.operators import relational, sequences
from tidewise.plans import infogain
from tidewise.registry.base import DELTAS, OBS, deltas, observations, query, r6
from tidewise.session import cut_lineage

CUT = "2024-01-15"


@query(f"WITH {OBS} SELECT item, seq, kind FROM (SELECT *, lag(kind) OVER w AS before, row_number() OVER w AS n FROM obs WINDOW w AS (PARTITION BY item ORDER BY sec, seq)) WHERE n = 1 OR kind IS DISTINCT FROM before")
def q_change_history(spark, sf_dir):
    return sequences.changes(observations(spark, sf_dir), ["item"], ["sec", "seq"], "kind").select("item", "seq", "kind")


@query(
    f"""WITH {OBS}, s AS (SELECT item, count(*) AS scores, count(DISTINCT kind) AS kinds FROM obs GROUP BY item),
  c AS (SELECT item, count(*) AS changes FROM (SELECT *, lag(kind) OVER w AS before, row_number() OVER w AS n FROM obs WINDOW w AS (PARTITION BY item ORDER BY sec, seq)) WHERE n = 1 OR kind IS DISTINCT FROM before GROUP BY item)
SELECT item, scores, changes, kinds FROM s JOIN c USING (item)"""
)
def q_merge_append_scores(spark, sf_dir):
    """Scores always, texts on change only: how long both histories get."""
    obs = observations(spark, sf_dir)
    texts = sequences.changes(obs, ["item"], ["sec", "seq"], "kind").groupBy("item").agg(F.count("*").alias("changes"))
    return obs.groupBy("item").agg(F.count("*").alias("scores"), F.count_distinct("kind").alias("kinds")).join(texts, "item").select("item", "scores", "changes", "kinds")


GRID = """d AS (SELECT DISTINCT user_id AS item, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day FROM events), snaps AS (SELECT DISTINCT day FROM d), firsts AS (SELECT item, min(day) AS first_day FROM d GROUP BY item),
grid AS (SELECT f.item, s.day, (d.day IS NOT NULL) AS present FROM firsts f JOIN snaps s ON s.day >= f.first_day LEFT JOIN d ON d.item = f.item AND d.day = s.day),
streaks AS (SELECT *, CAST(sum(CASE WHEN NOT present THEN 1 ELSE 0 END) OVER (PARTITION BY item, island ORDER BY day) AS BIGINT) AS absent FROM (SELECT *, sum(CASE WHEN present THEN 1 ELSE 0 END) OVER (PARTITION BY item ORDER BY day) AS island FROM grid))"""


def _streaks(spark, sf_dir):
    return infogain.absences(deltas(spark, sf_dir).select("item", F.col("day").cast("long").alias("day")).distinct())


@query(f"WITH {GRID} SELECT item, day, absent, absent = 3 AS marks_deleted FROM streaks WHERE absent > 0")
def q_absence_streak(spark, sf_dir):
    """Absent days in a row; the third marks the item deleted, once."""
    return _streaks(spark, sf_dir).where("absent > 0").select("item", "day", "absent", (F.col("absent") == 3).alias("marks_deleted"))


@query(f"WITH {GRID} SELECT item, day, CASE WHEN present THEN 'undelete' ELSE 'delete' END AS change FROM (SELECT *, lag(present) OVER (PARTITION BY item ORDER BY day) AS was FROM grid) WHERE was IS NOT NULL AND was <> present")
def q_presence_changes(spark, sf_dir):
    """Deleted at the first absence, back at the next appearance."""
    was = F.lag("present").over(Window.partitionBy("item").orderBy("day"))
    return _streaks(spark, sf_dir).withColumn("was", was).where("was is not null and was <> present").select("item", "day", F.when(F.col("present"), "undelete").otherwise("delete").alias("change"))


MERGE = f"""{OBS}, a AS (SELECT item, arg_max(score, (sec, seq)) AS score, arg_max(kind, (sec, seq)) AS kind FROM obs WHERE ts < TIMESTAMP '{CUT}' GROUP BY item),
  b AS (SELECT item, arg_max(score, (sec, seq)) AS score, arg_max(kind, (sec, seq)) AS kind FROM obs WHERE ts >= TIMESTAMP '{CUT}' GROUP BY item),
  m AS (SELECT coalesce(a.item, b.item) AS item, a.item IS NULL AS is_new, b.item IS NULL AS is_absent, a.item IS NOT NULL AND b.item IS NOT NULL AND (a.score <> b.score OR a.kind <> b.kind) AS is_updated,
    coalesce(b.score - a.score, 0) AS score_delta, abs(coalesce(length(b.kind), length(a.kind)) - coalesce(length(a.kind), 0)) AS chars, a.score <> b.score AS rescored, a.kind <> b.kind AS edited FROM a FULL JOIN b USING (item))"""


def _merged(spark, sf_dir):
    obs, cut = observations(spark, sf_dir), F.lit(CUT).cast("timestamp")
    return infogain.merge_snapshots(infogain.latest(obs.where(F.col("ts") < cut)), infogain.latest(obs.where(F.col("ts") >= cut)))


@query(
    f"""WITH {MERGE} SELECT count(*) FILTER (is_new) AS new_nodes, count(*) FILTER (is_updated) AS updated_nodes, count(*) FILTER (is_absent) AS absent_nodes, round(sum(score_delta), 6) AS score_delta, CAST(sum(chars) AS BIGINT) AS text_delta_chars FROM m"""
)
def q_merge_stats(spark, sf_dir):
    m = _merged(spark, sf_dir)
    return m.agg(F.count_if("is_new").alias("new_nodes"), F.count_if("is_updated").alias("updated_nodes"), F.count_if("is_absent").alias("absent_nodes"), r6(F.sum("score_delta"), "score_delta"), F.sum("chars").cast("long").alias("text_delta_chars"))


@query(
    f"""WITH {MERGE}, c AS (SELECT count(*) FILTER (is_new) AS n_new, count(*) FILTER (edited) AS n_edit, count(*) FILTER (rescored) AS n_score, count(*) FILTER (is_absent) AS n_delete FROM m)
SELECT *, round(1.0::DOUBLE * n_new + 0.5::DOUBLE * n_edit + 0.2::DOUBLE * n_score + 0.1::DOUBLE * n_delete, 6) AS delta FROM c"""
)
def q_scrape_delta(spark, sf_dir):
    c = _merged(spark, sf_dir).agg(F.count_if("is_new").alias("n_new"), F.count_if("edited").alias("n_edit"), F.count_if("rescored").alias("n_score"), F.count_if("is_absent").alias("n_delete"))
    return c.withColumn("delta", F.round(models.delta_info(F.col("n_new"), F.col("n_edit"), F.col("n_score"), F.col("n_delete")), 6))


@query(
    f"""WITH {OBS}, a AS (SELECT DISTINCT item FROM obs WHERE ts < TIMESTAMP '{CUT}'), b AS (SELECT DISTINCT item FROM obs WHERE ts >= TIMESTAMP '{CUT}')
SELECT *, only_old = 0 AS is_superset FROM (SELECT (SELECT count(*) FROM a JOIN b USING (item)) AS common, (SELECT count(*) FROM a WHERE item NOT IN (FROM b)) AS only_old, (SELECT count(*) FROM b WHERE item NOT IN (FROM a)) AS only_new)"""
)
def q_snapshot_compare(spark, sf_dir):
    obs, cut = observations(spark, sf_dir), F.lit(CUT).cast("timestamp")
    return relational.compare_keys(obs.where(F.col("ts") < cut), obs.where(F.col("ts") >= cut), "item")


@query(f"WITH {DELTAS} SELECT item, CAST(day AS BIGINT) AS day, n_new, n_edit, n_score, n_delete, round(delta, 6) AS delta FROM deltas")
def q_delta_info_timeline(spark, sf_dir):
    return deltas(spark, sf_dir).select("item", F.col("day").cast("long").alias("day"), "n_new", "n_edit", "n_score", "n_delete", r6(F.col("delta"), "delta"))


CURVES = f"""{DELTAS}, c AS (SELECT *, (day - min(day) OVER (PARTITION BY item)) * 24.0::DOUBLE AS t, sum(delta) OVER (PARTITION BY item ORDER BY day) AS cum, sum(delta) OVER (PARTITION BY item) AS total, max(delta) OVER (PARTITION BY item) AS top,
    count(*) OVER (PARTITION BY item) AS n, lead(delta) OVER (PARTITION BY item ORDER BY day) AS next_delta FROM deltas),
  half AS (SELECT item, min(t) AS half_life FROM c WHERE total > 0 AND cum >= total / 2 - 1e-9 GROUP BY item),
  dorm AS (SELECT item, min(t) AS dormancy FROM c WHERE delta = 0 AND next_delta = 0 GROUP BY item),
  lam AS (SELECT item, greatest(-regr_slope(ln(least(greatest(delta / (top + 1e-6), 1e-6), 1.0)), t), 0) AS lambda_hat FROM c WHERE n >= 3 AND total > 0 GROUP BY item),
  waste AS (SELECT item, 1 - avg(CASE WHEN delta > 0 THEN 1.0 ELSE 0.0 END) AS waste, max(total) AS total, max(t) AS duration, count(*) AS snapshots FROM c GROUP BY item),
  metrics AS (SELECT w.item, w.snapshots, round(w.total, 6) AS total, round(w.duration, 6) AS duration, round(h.half_life, 6) AS half_life, round(d.dormancy, 6) AS dormancy, round(w.waste, 6) AS waste, round(l.lambda_hat, 6) AS lambda_hat
    FROM waste w LEFT JOIN half h USING (item) LEFT JOIN dorm d USING (item) LEFT JOIN lam l USING (item))"""


def _metrics(spark, sf_dir):
    return infogain.curve_metrics(deltas(spark, sf_dir).select("item", "day", "delta"))


@query(f"WITH {CURVES} SELECT * FROM metrics")
def q_post_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query(f"WITH {CURVES} SELECT item, half_life FROM metrics WHERE half_life IS NOT NULL")
def q_half_life(spark, sf_dir):
    return _metrics(spark, sf_dir).where("half_life is not null").select("item", "half_life")


@query(f"WITH {CURVES} SELECT item, dormancy FROM metrics WHERE dormancy IS NOT NULL")
def q_dormancy(spark, sf_dir):
    return _metrics(spark, sf_dir).where("dormancy is not null").select("item", "dormancy")


@query(f"WITH {CURVES} SELECT item, waste FROM metrics")
def q_waste_rate(spark, sf_dir):
    return _metrics(spark, sf_dir).select("item", "waste")


@query(f"WITH {CURVES} SELECT item, lambda_hat FROM metrics WHERE lambda_hat IS NOT NULL")
def q_lambda_hat(spark, sf_dir):
    return _metrics(spark, sf_dir).where("lambda_hat is not null").select("item", "lambda_hat")


@query(
    f"""WITH {CURVES} SELECT count(*) AS posts, round(avg(total), 6) AS mean_total, round(quantile_cont(half_life, 0.5), 6) AS half_life_p50, round(quantile_cont(half_life, 0.8), 6) AS half_life_p80, round(avg(lambda_hat), 6) AS mean_lambda,
  count(*) FILTER (waste < 0.25) AS waste_low, count(*) FILTER (waste >= 0.25 AND waste < 0.5) AS waste_mid, count(*) FILTER (waste >= 0.5 AND waste < 0.75) AS waste_high, count(*) FILTER (waste >= 0.75) AS waste_top FROM metrics"""
)
def q_dataset_summary(spark, sf_dir):
    w, m = F.col("waste"), cut_lineage(_metrics(spark, sf_dir))  # read twice
    halves = relational.percentiles(m, [], "half_life", {"p50": 0.5, "p80": 0.8}).select(r6(F.col("p50"), "half_life_p50"), r6(F.col("p80"), "half_life_p80"))
    means = m.agg(
        F.count("*").alias("posts"), r6(F.avg("total"), "mean_total"), r6(F.avg("lambda_hat"), "mean_lambda"),
        F.count_if(w < 0.25).alias("waste_low"), F.count_if((w >= 0.25) & (w < 0.5)).alias("waste_mid"), F.count_if((w >= 0.5) & (w < 0.75)).alias("waste_high"), F.count_if(w >= 0.75).alias("waste_top"),
    )
    return means.join(F.broadcast(halves))  # one row each


@query(
    f"""WITH {OBS}, v AS (SELECT item, arg_min(score, (sec, seq)) AS first_score, arg_max(score, (sec, seq)) AS last_score, (max(sec) - min(sec)) / 60 AS minutes, count(*) AS n FROM obs GROUP BY item)
SELECT item, n, round(CASE WHEN minutes > 10 THEN (last_score - first_score) / minutes ELSE 0 END, 6) AS velocity FROM v"""
)
def q_velocity(spark, sf_dir):
    return infogain.velocities(observations(spark, sf_dir)).select("item", "n", r6(F.col("velocity"), "velocity"))


@query(
    f"""WITH {OBS} SELECT count(*) AS n_rows, count(*) FILTER (sec < before) AS backwards, count(*) FILTER (score IS NULL) AS null_marks, count(DISTINCT item) AS items FROM (SELECT *, lag(sec) OVER (PARTITION BY item ORDER BY seq) AS before FROM obs)"""
)
def q_history_audit(spark, sf_dir):
    """Data quality of histories: time going backwards, null marks."""
    before = F.lag("sec").over(Window.partitionBy("item").orderBy("seq"))
    return observations(spark, sf_dir).withColumn("before", before).agg(F.count("*").alias("n_rows"), F.count_if(F.col("sec") < F.col("before")).alias("backwards"), F.count_if(F.col("score").isNull()).alias("null_marks"), F.count_distinct("item").alias("items"))
