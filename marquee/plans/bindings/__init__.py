"""Operators on the driver tables, each with the SQL that must give the same rows."""

from marquee.plans.bindings import accounts, collab, content, etl, files, search, statistics
from marquee.plans.bindings.registry import oracle_sql, queries

__all__ = [
    "accounts",
    "collab",
    "content",
    "etl",
    "files",
    "oracle_sql",
    "queries",
    "search",
    "statistics",
]
