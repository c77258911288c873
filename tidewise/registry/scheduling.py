"""Scheduling: rates, temperature, intervals, priority, coverage, selection policy, budgets and controllers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewise.functions import models
from tidewise.operators import relational, sequences
from tidewise.plans import scheduler
from tidewise.registry.base import DELTAS, OBS, deltas, observations, query, r6, table

TODAY = 30
STATE = f"""{DELTAS}, z AS (SELECT item, day, delta, sum(CASE WHEN delta = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY item ORDER BY day) AS island FROM deltas),
s AS (SELECT item, day, delta, sum(CASE WHEN delta = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY item, island ORDER BY day) AS zero_streak,
    CASE WHEN count(*) OVER k >= 2 THEN sum(delta) OVER k / coalesce(nullif((day - min(day) OVER k) * 24.0::DOUBLE, 0), 1e-6) ELSE delta END AS rate, coalesce(stddev_samp(delta) OVER k, 0) AS volatility,
    max(CASE WHEN delta > 0 THEN day END) OVER w AS last_gain_day, max(delta) OVER k AS recent_top, count(*) OVER w AS scrapes, row_number() OVER (PARTITION BY item ORDER BY day DESC) AS back
  FROM z WINDOW w AS (PARTITION BY item ORDER BY day), k AS (PARTITION BY item ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
state AS (SELECT * FROM s WHERE back = 1),
warm AS (SELECT state.*, least(greatest(0.6::DOUBLE * rate / (SELECT max(rate) FROM state) + 0.3::DOUBLE * exp(-0.15::DOUBLE * greatest(({TODAY} - coalesce(last_gain_day, day)) * 24.0::DOUBLE, 0)) + 0.1::DOUBLE * volatility / (SELECT max(volatility) FROM state), 0), 1) AS temperature FROM state),
iv AS (SELECT *, least(greatest(0.008::DOUBLE * (1 + 3 * ln(1 + greatest(0, 1 - temperature))), 0.008::DOUBLE), 0.5::DOUBLE) AS base FROM warm),
dt AS (SELECT *, CASE WHEN scrapes = 0 THEN 1 / 60.0::DOUBLE WHEN scrapes = 1 THEN 3 / 60.0::DOUBLE WHEN zero_streak >= 2 THEN least(base * pow(1.5::DOUBLE, zero_streak - 1), 6) ELSE base END AS interval FROM iv),
due AS (SELECT *, day * 24.0::DOUBLE + interval AS due FROM dt),
late AS (SELECT *, greatest(({TODAY} * 24.0::DOUBLE - due) / interval, 0) AS raw FROM due),
queue AS (SELECT *, CASE WHEN last_gain_day IS NOT NULL AND ({TODAY} - last_gain_day) * 24.0::DOUBLE < interval THEN least(raw, 0.25::DOUBLE) ELSE raw END AS lateness FROM late)"""


def _states(spark, sf_dir):
    return scheduler.states(deltas(spark, sf_dir).select("item", "day", "delta"))


def _queue(spark, sf_dir):
    return scheduler.queue(scheduler.temperatures(_states(spark, sf_dir), TODAY), TODAY)


@query(f"WITH {STATE} SELECT item, round(rate, 6) AS rate, round(volatility, 6) AS volatility, CAST(last_gain_day AS INT) AS last_gain_day, CAST(zero_streak AS BIGINT) AS zero_streak FROM state")
def q_recent_rate_volatility(spark, sf_dir):
    return _states(spark, sf_dir).select("item", r6(F.col("rate"), "rate"), r6(F.col("volatility"), "volatility"), F.col("last_gain_day").cast("int").alias("last_gain_day"), "zero_streak")


@query(f"WITH {STATE} SELECT item, CAST(day AS INT) AS day, CAST(zero_streak AS BIGINT) AS zero_streak FROM s")
def q_zero_streak(spark, sf_dir):
    d = deltas(spark, sf_dir).select("item", F.col("day").cast("int").alias("day"), "delta")
    return sequences.streak(d, ["item"], ["day"], F.col("delta") == 0, "zero_streak").select("item", "day", "zero_streak")


@query(f"WITH {STATE} SELECT item, round(temperature, 6) AS temperature FROM warm")
def q_temperature(spark, sf_dir):
    return scheduler.temperatures(_states(spark, sf_dir), TODAY).select("item", r6(F.col("temperature"), "temperature"))


@query(f"WITH {STATE} SELECT item, round(interval, 6) AS interval_hours FROM dt")
def q_interval(spark, sf_dir):
    return _queue(spark, sf_dir).select("item", r6(F.col("interval"), "interval_hours"))


@query(f"WITH {STATE} SELECT item, round(due, 6) AS due, round(lateness, 4) AS lateness, round(temperature / (1 + 0.15::DOUBLE * lateness * interval), 6) AS priority FROM queue ORDER BY round(due, 6), priority DESC, item")
def q_priority_queue(spark, sf_dir):
    q = _queue(spark, sf_dir).select("item", r6(F.col("due"), "due"), F.round("lateness", 4).alias("lateness"), r6(F.col("priority"), "priority"))
    return q.orderBy("due", F.desc("priority"), "item")


@query(f"WITH {STATE} SELECT count(*) AS posts, round(avg(lateness), 4) AS mean_lateness, count(*) FILTER (raw > 0) AS late FROM queue")
def q_average_lateness(spark, sf_dir):
    late = (TODAY * 24.0 - F.col("due")) / F.col("interval")
    return _queue(spark, sf_dir).agg(F.count("*").alias("posts"), F.round(F.avg("lateness"), 4).alias("mean_lateness"), F.count_if(late > 0).alias("late"))


@query(
    f"""WITH {STATE} SELECT item, CASE WHEN zero_streak >= 4 THEN 'zero_streak' WHEN recent_top = 0 THEN 'recent_zero' WHEN ({TODAY} - last_gain_day) * 24.0 >= 72 THEN 'inactive' WHEN ({TODAY} - day) * 24.0 >= 108 THEN 'no_gain' END AS reason FROM state WHERE scrapes >= 3
  AND (zero_streak >= 4 OR recent_top = 0 OR ({TODAY} - last_gain_day) * 24.0 >= 72 OR ({TODAY} - day) * 24.0 >= 108)"""
)
def q_retirement(spark, sf_dir):
    reason = models.retirement_reason(F.col("scrapes"), F.col("zero_streak"), F.col("recent_top") == 0, (TODAY - F.col("last_gain_day")) * 24.0, (TODAY - F.col("day")) * 24.0, F.lit(False), 3, 4, 72.0)
    return _states(spark, sf_dir).select("item", reason.alias("reason")).where("reason is not null")


@query(f"WITH {STATE}, r AS (SELECT item, round(temperature, 6) AS t, row_number() OVER (ORDER BY round(temperature, 6) DESC, item) AS n, count(*) OVER () AS c FROM warm) SELECT item, t AS temperature FROM r WHERE n <= greatest(1, floor(c * 0.3))")
def q_temperature_keep(spark, sf_dir):
    """The hottest 30 %: a threshold from counts of distinct temperatures, ties by item."""
    warm = scheduler.temperatures(_states(spark, sf_dir), TODAY).select("item", r6(F.col("temperature"), "temperature"))
    total = warm.count()  # one number
    return warm.orderBy(F.desc("temperature"), "item").limit(max(1, int(total * 0.3 + 1e-9)))


PRIORS = f"""{DELTAS}, p AS (SELECT item % 25 AS sub, item, day, delta, row_number() OVER (PARTITION BY item % 25 ORDER BY day, item) AS n, avg(delta) OVER (PARTITION BY item % 25 ORDER BY day, item ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS prior FROM deltas)"""


@query(f"WITH {PRIORS} SELECT n_name AS sub, round(coalesce(arg_max(prior, n), 0.15), 6) AS prior, count(p.n) AS observations FROM nation LEFT JOIN p ON p.sub = n_nationkey GROUP BY n_name")
def q_priors_rolling(spark, sf_dir):
    w = Window.partitionBy("sub").orderBy("day", "item")
    p = deltas(spark, sf_dir).withColumn("sub", (F.col("item") % 25).cast("int")).withColumn("prior", F.avg("delta").over(w.rowsBetween(-199, 0)))
    last = p.groupBy("sub").agg(F.max_by("prior", F.struct("day", "item")).alias("prior"), F.count("*").alias("observations"))
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("sub"), "n_name")
    return names.join(last, "sub", "left").select(F.col("n_name").alias("sub"), F.round(F.coalesce("prior", F.lit(0.15)), 6).alias("prior"), F.coalesce("observations", F.lit(0)).cast("long").alias("observations"))


@query(f"WITH {DELTAS} SELECT CAST(item % 25 AS BIGINT) AS sub, round(avg(delta), 6) AS mean, round(median(delta), 6) AS median, round(quantile_cont(delta, 0.8), 6) AS p80, count(*) AS n FROM deltas GROUP BY item % 25")
def q_priors_summary(spark, sf_dir):
    d = deltas(spark, sf_dir).select((F.col("item") % 25).cast("long").alias("sub"), "delta")
    means = d.groupBy("sub").agg(r6(F.avg("delta"), "mean"), F.count("*").alias("n"))
    shares = relational.percentiles(d, ["sub"], "delta", {"median": 0.5, "p80": 0.8})
    return means.join(shares, "sub").select("sub", "mean", r6(F.col("median"), "median"), r6(F.col("p80"), "p80"), "n")


@query("SELECT n_name AS name, n_nationkey AS rank, round(1 / (1 + exp(0.3::DOUBLE * (n_nationkey - 10))), 6) AS coverage FROM nation")
def q_sigmoid_coverage(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("rank"), r6(models.sigmoid_coverage(F.col("n_nationkey"), 0.3, 10.0), "coverage"))


COVERAGE = """f AS (SELECT n_nationkey AS rank, n_name AS name, 1 / (1 + exp(0.3::DOUBLE * (n_nationkey - 10))) AS f, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS rate FROM nation),
  d AS (SELECT *, least(CASE WHEN sum(f * 25 * rate) OVER () > 0 THEN 60.0::DOUBLE * 0.9 / sum(f * 25 * rate) OVER () ELSE 1 END, 1) AS scale FROM f)"""


@query(f"WITH {COVERAGE} SELECT name, round(least(greatest(scale * f * rate * 1.1, 0), 1), 6) AS fraction FROM d")
def q_coverage_fractions(spark, sf_dir):
    """Under a tight budget: the sigmoid scaled so that the whole demand fits; the demand is one row, joined to all."""
    rate = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("rate"))
    f = table(spark, sf_dir, "nation").join(rate, "n_nationkey", "left").select(F.col("n_name").alias("name"), models.sigmoid_coverage(F.col("n_nationkey"), 0.3, 10.0).alias("f"), F.coalesce("rate", F.lit(0)).alias("rate"))
    demand = f.agg(F.sum(F.col("f") * 25 * F.col("rate")).alias("demand"))
    scale = F.least(F.when(F.col("demand") > 0, 60.0 * 0.9 / F.col("demand")).otherwise(1.0), F.lit(1.0))
    return f.join(F.broadcast(demand)).select("name", r6(models.clamp(scale * F.col("f") * F.col("rate") * 1.1, 0.0, 1.0), "fraction"))


@query(
    """SELECT o_orderkey, CASE WHEN c_nationkey BETWEEN 0 AND 4 THEN 'all' WHEN c_nationkey BETWEEN 5 AND 9 THEN 'hot_only' WHEN c_nationkey BETWEEN 10 AND 19 THEN 'sample' ELSE 'none' END AS method FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey BETWEEN 0 AND 4 OR (c_nationkey BETWEEN 5 AND 9 AND o_totalprice >= 250000) OR (c_nationkey BETWEEN 10 AND 19 AND o_orderkey % 10 < 3)"""
)
def q_selection_policy(spark, sf_dir):
    """The first rule whose rank range holds an order's rank decides; sampling goes by the key, so it repeats.  The rules are a fixed literal."""
    rules = [(0, 0, 4, "all", 0.0), (1, 5, 9, "hot_only", 250_000.0), (2, 10, 19, "sample", 3.0)]
    rule = spark.createDataFrame(rules, "place int, low int, high int, method string, bound double")
    ranked = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("rank")), "o_custkey")
    met = ranked.join(F.broadcast(rule), F.col("rank").between(F.col("low"), F.col("high")))
    m = F.col("method")
    return met.where((m == "all") | ((m == "hot_only") & (F.col("o_totalprice") >= F.col("bound"))) | ((m == "sample") & (F.col("o_orderkey") % 10 < F.col("bound")))).select("o_orderkey", "method")


@query(f"WITH {OBS} SELECT seq, count(*) OVER (PARTITION BY kind ORDER BY CAST(floor(sec) AS BIGINT) RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS used FROM obs")
def q_request_budget(spark, sf_dir):
    obs = observations(spark, sf_dir).withColumn("second", F.floor("sec"))
    return sequences.requests_in_window(obs, ["kind"], "second", 600, "used").select("seq", "used")


@query(f"WITH {OBS} SELECT seq, round(lead(sec, 4) OVER (PARTITION BY item ORDER BY sec, seq) - sec, 6) AS wait FROM obs")
def q_nth_expiry_wait(spark, sf_dir):
    """How long until the fourth later slot of the item frees."""
    w = Window.partitionBy("item").orderBy("sec", "seq")
    return observations(spark, sf_dir).select("seq", r6(F.lead("sec", 4).over(w) - F.col("sec"), "wait"))


@query(
    f"""WITH {OBS}, p AS (SELECT *, lag(score) OVER (PARTITION BY item ORDER BY sec, seq) AS before FROM obs)
SELECT item, round(sum(CASE WHEN score < before - 5 THEN 500 - before ELSE 0 END), 6) AS wasted, count(*) FILTER (score < before - 5) AS resets FROM p GROUP BY item"""
)
def q_token_waste(spark, sf_dir):
    """A drop of the used count is a new window: what the old one left is wasted."""
    before = F.lag("score").over(Window.partitionBy("item").orderBy("sec", "seq"))
    reset = F.col("score") < F.col("before") - 5
    return observations(spark, sf_dir).withColumn("before", before).groupBy("item").agg(r6(F.sum(F.when(reset, 500 - F.col("before")).otherwise(0.0)), "wasted"), F.count_if(reset).alias("resets"))


@query(
    f"""WITH RECURSIVE {OBS}, o AS (SELECT item, row_number() OVER (PARTITION BY item ORDER BY sec, seq) AS n, score AS rps FROM obs),
f AS (SELECT item, n, greatest(0.2::DOUBLE * rps + 0.8::DOUBLE * 10, 2.0::DOUBLE) AS ema, least(greatest(exp(0.1::DOUBLE * (greatest(0.2::DOUBLE * rps + 0.8::DOUBLE * 10, 2.0::DOUBLE) / 10 - 1)), 0.5::DOUBLE), 3.0::DOUBLE) AS gain FROM o WHERE n = 1
  UNION ALL SELECT o.item, o.n, greatest(0.2::DOUBLE * o.rps + 0.8::DOUBLE * f.ema, 2.0::DOUBLE), least(greatest(f.gain * exp(0.1::DOUBLE * (greatest(0.2::DOUBLE * o.rps + 0.8::DOUBLE * f.ema, 2.0::DOUBLE) / 10 - 1)), 0.5::DOUBLE), 3.0::DOUBLE) FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1)
SELECT item, CAST(max(n) AS BIGINT) AS steps, round(arg_max(ema, n), 6) AS ema, round(arg_max(gain, n), 6) AS gain, round(max(gain), 6) AS top_gain FROM f GROUP BY item"""
)
def q_ema_gain(spark, sf_dir):
    """The rate controller folded over each item's observations in order."""
    steps = sequences.sorted_steps(observations(spark, sf_dir).withColumnRenamed("score", "rps"), ["item"], ["sec", "seq"], "rps")
    folded = steps.select("item", sequences.fold_ema(F.col("steps"), 10.0, 0.2, 10.0, 0.1, 0.5, 3.0).alias("f"))
    return folded.select("item", F.col("f.steps").alias("steps"), r6(F.col("f.ema"), "ema"), r6(F.col("f.gain"), "gain"), r6(F.col("f.top_gain"), "top_gain"))


@query(
    f"""WITH RECURSIVE {OBS}, e AS (SELECT item, sec, row_number() OVER (PARTITION BY item ORDER BY sec, seq) AS n FROM obs WHERE kind = 'error'),
f AS (SELECT item, n, sec AS fired, 1 AS alerts FROM e WHERE n = 1 UNION ALL SELECT e.item, e.n, CASE WHEN e.sec - f.fired < 86400 THEN f.fired ELSE e.sec END, CASE WHEN e.sec - f.fired < 86400 THEN f.alerts ELSE f.alerts + 1 END FROM f JOIN e ON e.item = f.item AND e.n = f.n + 1)
SELECT item, CAST(max(alerts) AS BIGINT) AS alerts, round(max(fired), 3) AS last_fired FROM f GROUP BY item"""
)
def q_alert_cooldown(spark, sf_dir):
    """Errors raise alerts; each alert silences those of the next day."""
    steps = sequences.sorted_steps(observations(spark, sf_dir).where("kind = 'error'"), ["item"], ["sec"])
    return steps.select("item", sequences.fold_cooldown(F.col("steps"), 86_400.0).alias("f")).select("item", "f.alerts", F.round("f.fired", 3).alias("last_fired"))


@query(
    f"""WITH RECURSIVE {OBS}, o AS (SELECT item, sec, row_number() OVER (PARTITION BY item ORDER BY sec, seq) AS n FROM obs),
f AS (SELECT item, n, sec, 2.0::DOUBLE AS tokens, true AS granted FROM o WHERE n = 1
  UNION ALL SELECT o.item, o.n, o.sec, CASE WHEN least(3.0::DOUBLE, f.tokens + (o.sec - f.sec) / 43200) >= 1 THEN least(3.0::DOUBLE, f.tokens + (o.sec - f.sec) / 43200) - 1 ELSE least(3.0::DOUBLE, f.tokens + (o.sec - f.sec) / 43200) END,
    least(3.0::DOUBLE, f.tokens + (o.sec - f.sec) / 43200) >= 1 FROM f JOIN o ON o.item = f.item AND o.n = f.n + 1)
SELECT item, count(*) AS requests, count(*) FILTER (granted) AS granted FROM f GROUP BY item"""
)
def q_token_bucket(spark, sf_dir):
    """Three tokens at most, one more each half day; how many requests are granted."""
    steps = sequences.sorted_steps(observations(spark, sf_dir), ["item"], ["sec", "seq"])
    return steps.select("item", sequences.fold_bucket(F.col("steps"), 3.0, 1 / 43_200).alias("f")).select("item", "f.requests", "f.granted")


@query("SELECT n_nationkey AS attempt, CAST(least(30 * pow(2, n_nationkey), 240) AS BIGINT) AS retry, round(least(greatest(0.1 + 0.9 * (n_nationkey * 5 - 10) / 90.0, 0.1), 1.0), 6) AS ratio, CAST(CASE WHEN n_nationkey * 5 >= 50 THEN 0.5 WHEN n_nationkey * 5 >= 25 THEN 2 WHEN n_nationkey * 5 >= 10 THEN 4 ELSE 6 END AS DOUBLE) AS buffer, CAST(floor(60 + (1 - n_nationkey / 25.0) * 240) AS BIGINT) AS revisit, CAST(greatest(1, floor(24 * (n_nationkey / 25.0))) AS BIGINT) AS batch FROM nation")
def q_pacing_table(spark, sf_dir):
    n = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(n.alias("attempt"), models.retry_seconds(n).alias("retry"), r6(models.budget_ratio(n * 5), "ratio"), models.buffer_interval(n * 5, 6.0).alias("buffer"), models.revisit_seconds(n / 25.0).alias("revisit"), models.batch_size(n / 25.0, 10.0, 1.2).alias("batch"))


@query(f"WITH {DELTAS} SELECT item, CAST(day AS INT) AS day, CAST(CASE WHEN n_new > 0 THEN greatest(60, floor(300 / 2)) WHEN n_score > 0 OR n_edit > 0 THEN greatest(300, 300) ELSE least(21600, 300 * 2) END AS BIGINT) AS seconds FROM deltas")
def q_backoff(spark, sf_dir):
    s = models.backoff_seconds(F.lit(300), F.col("n_new"), F.col("n_score"), F.col("n_edit"))
    return deltas(spark, sf_dir).select("item", F.col("day").cast("int").alias("day"), s.alias("seconds"))


@query(f"WITH {OBS}, l AS (SELECT item, max(sec) AS last FROM obs GROUP BY item) SELECT item, round(last, 3) AS last FROM l ORDER BY last, item LIMIT 10")
def q_most_due(spark, sf_dir):
    """Least recently seen first: heartbeat, due polls and cooldowns."""
    last = observations(spark, sf_dir).groupBy("item").agg(F.max("sec").alias("last"))
    return last.orderBy("last", "item").limit(10).select("item", F.round("last", 3).alias("last"))


@query(f"WITH {OBS}, l AS (SELECT item, max(sec) AS last FROM obs GROUP BY item) SELECT count(*) AS items, count(*) FILTER (1706659200 - last >= 86400) AS eligible FROM l")
def q_cooldown_eligible(spark, sf_dir):
    last = observations(spark, sf_dir).groupBy("item").agg(F.max("sec").alias("last"))
    return last.agg(F.count("*").alias("items"), F.count_if(F.lit(1_706_659_200) - F.col("last") >= 86_400).alias("eligible"))


@query(f"WITH {OBS}, g AS (SELECT kind, sec - lag(sec) OVER (PARTITION BY kind ORDER BY sec, seq) AS gap FROM obs), a AS (SELECT kind, list_sort(list(round(gap, 6)) FILTER (gap IS NOT NULL)) AS x FROM g GROUP BY kind) SELECT kind, x[len(x) // 2 + 1] AS median, x[least(CAST(floor(len(x) * 0.9) AS BIGINT), len(x) - 1) + 1] AS p90, x[-1] AS longest FROM a")
def q_interval_percentiles(spark, sf_dir):
    """Nearest-rank median and p90 of the gaps between observations of a kind."""
    before = relational.lagged(observations(spark, sf_dir).select("kind", "sec", "seq"), ["kind"], ["sec", "seq"], "sec", "before")
    gaps = before.select("kind", F.round(F.col("sec") - F.col("before"), 6).alias("gap")).where("gap is not null")
    return relational.nearest_ranks(gaps, ["kind"], "gap", {"median": 0.5, "p90": 0.9, "longest": 1.0}, top=True)
