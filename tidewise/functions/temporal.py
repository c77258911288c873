"""Column builders for time: ages, tags, weights, parsing with fallbacks (survey P1-P5, P17, P22, P28)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def epoch(ts: Column) -> Column:
    """Seconds since the epoch as double, UTC, keeping microseconds."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def hours_between(later: Column, earlier: Column) -> Column:
    """Hours from earlier to later, never negative."""
    return F.greatest((epoch(later) - epoch(earlier)) / 3600, F.lit(0.0))


def days_ago(ts: Column, end: Column) -> Column:
    return F.floor((epoch(end) - epoch(ts)) / DAY).cast("long")


def temporal_tag(days: Column) -> Column:
    return F.when(days < 1, "BREAKING").when(days < 7, "EMERGING").when(days < 30, "SUSTAINED").otherwise("RESURGENT")


def temporal_weight(hours: Column) -> Column:
    return F.when(hours < 24, F.lit(1.0)).when(hours < 48, F.lit(0.6)).when(hours < 72, F.lit(0.3)).otherwise(F.lit(0.1))


def parse_timestamp(text: Column) -> Column:
    """ISO with or without zone (no zone: UTC), else the compact yyyyMMdd_HHmmss found anywhere in the text, else null."""
    iso = F.try_to_timestamp(text)
    compact = F.try_to_timestamp(F.nullif(F.regexp_extract(text, r"(\d{8}_\d{6})", 1), F.lit("")), F.lit("yyyyMMdd_HHmmss"))
    return F.coalesce(iso, compact)


def compact_minutes(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmm")


def months_apart(later: Column, earlier: Column) -> Column:
    """Calendar months both ends included, at least 1."""
    return F.greatest(F.lit(1), 12 * (F.year(later) - F.year(earlier)) + F.month(later) - F.month(earlier) + 1).cast("int")


def minutes_seconds(seconds: Column) -> Column:
    whole = F.floor(seconds).cast("int")
    return F.format_string("%dm %ds", (whole / 60).cast("int"), whole % 60)
