"""Registry of the engine's named queries and their SQL counterparts."""

from tidewise.registry import cohort, fields, history, hygiene, ingest, items, landed, more, scheduling, streams, trees  # noqa: F401
from tidewise.registry.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
