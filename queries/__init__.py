"""The registered queries and their SQL counterparts."""

from queries import aggregates, cleaning, feeds, history, keys, layers, rollups, watch, writes  # noqa: F401
from queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
