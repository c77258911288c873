"""Writers: JSON lines with a header, reports, per-thread files, snapshots (survey K1-K11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header(items: DataFrame, ts: str, title: str, statistics: dict[str, Column] | None = None) -> DataFrame:
    """One row: the header text of a data set: totals, date range and a line for each statistic (an aggregate of the items)."""
    numbers = {f"_s{i}": c for i, c in enumerate((statistics or {}).values())}
    s = items.agg(F.count("*").alias("n"), F.date_format(F.min(ts), "yyyy-MM-dd").alias("a"), F.date_format(F.max(ts), "yyyy-MM-dd").alias("b"), *[c.alias(n) for n, c in numbers.items()])
    top = F.format_string("# %s\n# Format: JSON lines, newest first\n# Total items: %s\n# Date range: %s to %s", F.lit(title), F.format_number("n", 0), F.coalesce("a", F.lit("-")), F.coalesce("b", F.lit("-")))
    lines = [F.concat(F.lit(f"# {name}: "), F.coalesce(F.col(n).cast("string"), F.lit("-"))) for name, n in zip(statistics or {}, numbers, strict=True)]
    return s.select(F.concat_ws("\n", top, *lines).alias("value"))


def json_lines(items: DataFrame, ts: str, key: str, title: str, path: str) -> None:
    """items newest first as JSON lines in `path`/data (range-partitioned, so the parts in order are the order), the header in `path`/header."""
    ordered = items.orderBy(F.desc(ts), key)
    ordered.select(F.to_json(F.struct(*[F.col(c) for c in items.columns])).alias("value")).write.mode("overwrite").text(f"{path}/data")
    header(items, ts, title).write.mode("overwrite").text(f"{path}/header")


def report(items: DataFrame, line: Column, path: str) -> None:
    items.select(line.alias("value")).write.mode("overwrite").text(path)


def thread_files(nodes: DataFrame, path: str) -> None:
    """One JSON object of nodes for each thread, under thread=<id>."""
    entry = F.struct(F.col("node").cast("string").alias("k"), F.struct(*[F.col(c) for c in nodes.columns if c != "thread"]).alias("v"))
    merged = nodes.groupBy("thread").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("value"))
    merged.write.mode("overwrite").partitionBy("thread").text(path)


def edge_lists(nodes: DataFrame, path: str) -> None:
    """Nodes and edges of each thread as JSON lines."""
    node = F.struct(*[F.col(c) for c in nodes.columns if c != "thread"])
    edge = F.when(F.col("parent").isNotNull(), F.array(F.col("parent").cast("string"), F.col("node").cast("string")))
    nodes.groupBy("thread").agg(F.sort_array(F.collect_list(node)).alias("nodes"), F.sort_array(F.collect_list(edge)).alias("edges")).write.mode("overwrite").json(path)


def append_snapshot(rows: DataFrame, fetched_at: str, path: str) -> None:
    """Append under fetched_at=<time>, with white space of strings collapsed."""
    tidy = [F.regexp_replace(F.trim(c), r"\s+", " ").alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    rows.select(*tidy).withColumn("fetched_at", F.lit(fetched_at)).write.mode("append").partitionBy("fetched_at").json(path)


def bar(share: Column, width: int = 20) -> Column:
    full = F.floor(share * width).cast("int")
    return F.concat(F.repeat(F.lit("█"), full), F.repeat(F.lit("░"), F.lit(width) - full))


def table_lines(rows: DataFrame, name: str, number: str, share: Column, width: int = 14) -> DataFrame:
    """value: a line of a report table for each row: name, number, share in per cent and its bar (survey K10)."""
    pct = F.lpad(F.format_string("%.1f%%", 100 * share), 7, " ")
    return rows.select(F.concat(F.rpad(F.col(name), width, " "), F.lpad(F.format_number(number, 0), 10, " "), pct, F.lit(" "), bar(share)).alias("value"))
