"""The registered queries and their DuckDB statements, by name."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "r_reply_depth"


def query(name: str, sql: str | None = None):
    """Register a function of (spark, sf_dir) and its statement."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep
