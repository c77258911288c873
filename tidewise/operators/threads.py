"""Nested discussion threads: flattening, rebuilding, and the shapes a node takes (survey G1, G2, G8, G16, P7-P15, S11)."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLAT = "thread string, position int, node string, parent string, depth int, author string, text string, score long"


def _flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for thread, text in zip(batch["thread"], batch["json"], strict=True):
            try:
                roots = json.loads(text) if text else []
            except ValueError:
                roots = []
            stack = [(r, None, 0) for r in reversed(roots if isinstance(roots, list) else [roots])]
            position = 0
            while stack:  # depth first, in document order, however deep
                item, above, depth = stack.pop()
                if not isinstance(item, dict) or item.get("id") is None:
                    continue
                node, score = str(item["id"]), item.get("score")
                out.append((thread, position, node, above, depth, item.get("author"), item.get("text") or item.get("body") or "", int(score) if isinstance(score, (int, float)) else None))
                position += 1
                replies = item.get("replies")
                stack += [(r, node, depth + 1) for r in reversed(replies if isinstance(replies, list) else [])]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in FLAT.split(", ")]).astype({"score": "Int64"})


def flatten(threads: DataFrame) -> DataFrame:
    """Rows of nested threads (thread, json: a node or an array of nodes with `replies`); parents and depths are those of the nesting."""
    return threads.select(F.col("thread").cast("string").alias("thread"), "json").mapInPandas(_flat, FLAT)


def _tree(pdf: pd.DataFrame) -> pd.DataFrame:
    made, roots, lost = {}, [], 0
    pdf = pdf.sort_values("position")
    for row in pdf.itertuples(index=False):
        made[row.node] = {"id": row.node, "author": row.author, "text": row.text, "score": None if pd.isna(row.score) else int(row.score), "replies": []}
    for row in pdf.itertuples(index=False):
        above = made.get(row.parent) if isinstance(row.parent, str) else None
        lost += above is None and isinstance(row.parent, str)
        (roots if above is None else above["replies"]).append(made[row.node])
    return pd.DataFrame([(pdf["thread"].iloc[0], json.dumps(roots), lost)], columns=["thread", "json", "orphans"])


def rebuild(flat: DataFrame) -> DataFrame:
    """thread, json, orphans: the nested form of each thread; nodes whose parent is missing become roots.

    One row, and so one task, a thread: the nested document is one value by definition."""
    return flat.groupBy("thread").applyInPandas(_tree, "thread string, json string, orphans long")


def history(value: Column, ts: Column, empty: Column | None = None) -> Column:
    """A history of one observation; none where `empty` holds."""
    entry = F.array(F.struct(value.alias("value"), ts.alias("ts")))
    return entry if empty is None else F.when(empty, F.slice(entry, 1, 0)).otherwise(entry)


def as_nodes(flat: DataFrame, taken_at: Column) -> DataFrame:
    """Snapshot rows as canonical nodes with histories and a deletion flag."""
    gone = F.col("text").isin("[deleted]", "[removed]")
    return flat.select("thread", "node", "parent", "author", "depth", history(F.col("text"), taken_at, F.col("text") == "").alias("text_history"), history(F.col("score"), taken_at).alias("score_history"), gone.alias("is_deleted"), F.when(gone, taken_at).alias("deleted_at"))


def latest_view(nodes: DataFrame) -> DataFrame:
    """The flat latest-value form: last score and text, defaults where there is no history."""
    score, text = (F.try_element_at(h, F.lit(-1))["value"] for h in ("score_history", "text_history"))
    return nodes.select("thread", "node", "parent", "author", "depth", F.coalesce(score, F.lit(0)).alias("score"), F.coalesce(text, F.lit("")).alias("text"), F.greatest(F.size("text_history") - 1, F.lit(0)).alias("edits"), F.coalesce("is_deleted", F.lit(False)).alias("is_deleted"))


def with_remainder(rows: DataFrame, known: list[str]) -> DataFrame:
    """The known columns and all others as one JSON bag."""
    rest = [c for c in rows.columns if c not in known]
    return rows.select(*known, F.to_json(F.struct(*rest)).alias("extra") if rest else F.lit(None).cast("string").alias("extra"))


def upgraded(rows: DataFrame, taken_at: Column) -> DataFrame:
    """Rows that may hold latest values only (text, score) or histories: histories everywhere, the legacy columns gone (survey P15)."""
    texts = F.coalesce("text_history", history(F.col("text"), taken_at, F.col("text").isNull() | (F.col("text") == "")))
    scores = F.coalesce("score_history", history(F.coalesce("score", F.lit(0)), taken_at))
    return rows.withColumn("text_history", texts).withColumn("score_history", scores).drop("text", "score")


def from_map(files: DataFrame) -> DataFrame:
    """Nodes of maps in camel case (thread, m: id -> node) as flat rows with tuple histories (survey P10): pairs (value, ts)."""

    def pairs(name: str) -> Column:
        return F.transform(F.coalesce(F.col(f"x.{name}"), F.array()), lambda e: F.struct(e["value"].alias("value"), e["timestamp"].alias("ts")))

    rows = files.select("thread", F.explode("m").alias("node", "x"))
    return rows.select("thread", "node", F.col("x.parentId").alias("parent"), "x.author", pairs("textHistory").alias("text_history"), pairs("scoreHistory").alias("score_history"))


def clean(nodes: DataFrame) -> DataFrame:
    """Six fields of a node, the first of its histories for text and score; cleaning twice changes nothing (survey P11)."""
    first = lambda h: F.try_element_at(F.col(h), F.lit(1))["value"]
    text = F.coalesce(first("text_history"), F.lit("")) if "text_history" in nodes.columns else F.coalesce("text", F.lit(""))
    score = F.coalesce(first("score_history"), F.lit(0)) if "score_history" in nodes.columns else F.coalesce("score", F.lit(0))
    return nodes.select("thread", "node", "parent", F.coalesce("author", F.lit("[deleted]")).alias("author"), text.alias("text"), score.alias("score"))


def found(nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (thread, node) with author and text of the node, null where there is none (survey G16)."""
    return wanted.join(nodes.select("thread", "node", "author", "text"), ["thread", "node"], "left")
