"""The scalar models: information gain, temperature, intervals, priority, coverage, backoff (survey M1-M20, A8, A30, A31, T11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weights of new, edited, re-scored and deleted items.
NEW, EDITED, SCORED, DELETED = 1.0, 0.5, 0.2, 0.1


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def delta_info(new: Column, edited: Column, scored: Column, deleted: Column) -> Column:
    return NEW * new + EDITED * edited + SCORED * scored + DELETED * deleted


def temperature(rate: Column, top_rate: Column, lam: Column, idle_hours: Column, volatility: Column, top_volatility: Column) -> Column:
    """Share of the cohort's activity, of freshness and of its uncertainty, in [0, 1]."""

    def share(x: Column, top: Column) -> Column:
        return x / F.coalesce(F.nullif(top, F.lit(0.0)), F.lit(1.0))

    return clamp(0.6 * share(rate, top_rate) + 0.3 * F.exp(-lam * idle_hours) + 0.1 * share(volatility, top_volatility), 0.0, 1.0)


def interval_hours(temp: Column, gain: float = 1.0, low: float = 0.008, high: float = 0.5) -> Column:
    return clamp(low * (1 + 3.0 * F.log1p(F.greatest(F.lit(0.0), 1 - clamp(temp, 0.0, 1.0)))), low, high) * gain


def young_or_idle_interval(dt: Column, scrapes: Column, zero_streak: Column, threshold: int = 2, factor: float = 1.5, cap: float = 6.0) -> Column:
    """1 and 3 minutes for the first two visits; then longer for each zero beyond the threshold."""
    slowed = F.least(dt * F.pow(F.lit(factor), zero_streak - threshold + 1), F.lit(cap))
    return F.when(scrapes == 0, F.lit(1 / 60)).when(scrapes == 1, F.lit(3 / 60)).when((zero_streak > 0) & (zero_streak >= threshold), slowed).otherwise(dt)


def priority(temp: Column, lam: Column, lateness: Column, dt: Column) -> Column:
    return temp / (1 + lam * lateness * dt)


def sigmoid_coverage(rank: Column, steepness: float, centre: float) -> Column:
    return 1 / (1 + F.exp(steepness * (rank - centre)))


def backoff_seconds(interval: Column, new: Column, scored: Column, updated: Column) -> Column:
    hot = F.greatest(F.lit(60), F.floor(interval / 2))
    warm = F.greatest(interval, F.lit(300))
    return F.when(new > 0, hot).when((scored > 0) | (updated > 0), warm).otherwise(F.least(F.lit(21_600), interval * 2)).cast("long")


def retry_seconds(attempt: Column) -> Column:
    return F.least(30 * F.pow(F.lit(2), attempt), F.lit(240.0)).cast("long")


def node_importance(score: Column, descendants: Column, velocity: Column, edits: Column) -> Column:
    return 0.5 * score + 0.3 * descendants + 0.1 * velocity + 0.1 * edits


def batch_importance(score: Column, velocity: Column, edits: Column) -> Column:
    return 0.5 * score + 0.2 * velocity + 0.1 * edits


def author_interest(score: Column, comments: Column, length: Column, replies: Column, depth: Column) -> Column:
    return score * 1.0 + comments * 0.5 + (length / 100) * 0.3 + replies * 2.0 + depth * 0.2


def budget_ratio(available: Column) -> Column:
    """Share of the queue to visit: 0.1 at 10 requests left or fewer, 1.0 at 100 or more, linear between."""
    return clamp(0.1 + 0.9 * (available - 10) / 90, 0.1, 1.0)


def buffer_interval(tokens: Column, base: float) -> Column:
    return F.when(tokens >= 50, F.lit(0.5)).when(tokens >= 25, F.lit(2.0)).when(tokens >= 10, F.lit(4.0)).otherwise(F.lit(base))


#: Items a request covers, extra requests and the most requests, by how deep a thread is read.
READING = {"shallow": (100, 1, 10), "medium": (50, 2, 30), "deep": (10, 5, 150)}


def estimate_requests(items: Column, mode: Column) -> Column:
    """Requests that reading a thread takes in a mode of READING."""
    out = None
    for name, (per, extra, most) in READING.items():
        cost = F.least(F.greatest(F.floor(items / per), F.lit(1)) + extra, F.lit(most)).cast("long")
        out = F.when(mode == name, cost) if out is None else out.when(mode == name, cost)
    return out


def revisit_seconds(ratio: Column) -> Column:
    """Least time between visits: a minute at full coverage, five at none."""
    return F.floor(60 + (1 - ratio) * 240).cast("long")


def batch_size(ratio: Column, rate: float, gain: float) -> Column:
    return F.greatest(F.floor(max(10.0, min(100.0, rate * gain * 2)) * ratio), F.lit(1)).cast("long")


def cost_error_pct(actual: Column, estimated: Column) -> Column:
    return F.abs(actual - estimated) / F.greatest(F.lit(1.0), actual) * 100


def retirement_reason(scrapes: Column, zero_streak: Column, recent_zero: Column, idle_hours: Column, since_scrape: Column, flagged: Column, least: int, streak: int, idle_limit: float) -> Column:
    """The first rule that holds; null: stays."""
    rules = F.when(zero_streak >= streak, "zero_streak").when(recent_zero, "recent_zero").when(idle_hours >= idle_limit, "inactive").when(since_scrape >= 1.5 * idle_limit, "no_gain").when(flagged, "flagged")
    return F.when(scrapes >= least, rules)


def explore_decision(depth: Column, age_hours: Column, karma: Column, account_days: Column, parent_score: Column, score: Column, min_depth: int, recent_hours: float, karma_limit: float, days_limit: float, score_limit: float) -> Column:
    """Struct (go_on, all_siblings) by the first rule that holds."""

    def say(go_on: bool, siblings: bool) -> Column:
        return F.struct(F.lit(go_on).alias("go_on"), F.lit(siblings).alias("all_siblings"))

    known = (karma > karma_limit) | (account_days > days_limit)
    dead = parent_score.isNotNull() & (parent_score <= score_limit) & (score <= score_limit)
    return F.when(depth < min_depth, say(True, True)).when(age_hours < recent_hours, say(True, True)).when(known, say(True, False)).when(dead, say(False, False)).otherwise(say(True, False))


def ramp_coverage(rank: Column, full_until: int, last: int, floor: float) -> Column:
    """Full coverage up to a rank, then a straight line down to the floor at the last rank (survey T18)."""
    down = 1 - (1 - floor) * (rank - full_until) / (last - full_until)
    return F.when(rank <= full_until, F.lit(1.0)).otherwise(F.greatest(down, F.lit(floor)))


def floor_sigmoid_coverage(rank: Column, steepness: float, pivot: float, floor: float) -> Column:
    return floor + (1 - floor) / (1 + F.exp(steepness * (rank - pivot)))


def confidence(score: Column) -> Column:
    """Tier and weight of a score from 0 to 10 (survey M20)."""
    return F.when(score >= 9, "high").when(score >= 6, "medium").otherwise("low")


def weighted_confidence(score: Column, hours: Column) -> Column:
    """The score after its domain's recency decay."""
    return score * F.when(hours < 24, F.lit(1.0)).when(hours < 48, F.lit(0.6)).when(hours < 72, F.lit(0.3)).otherwise(F.lit(0.1))


def hype_ratio(hype: Column, substance: Column) -> Column:
    """Struct of hype over substance (null without substance) and whether it is over 2 (survey M16)."""
    ratio = hype / F.nullif(substance, F.lit(0.0))
    return F.struct(ratio.alias("ratio"), F.coalesce(ratio > 2, hype > 0).alias("marketing_heavy"))
