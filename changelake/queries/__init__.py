"""The operators as named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changelake.sources.fixtures import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def named(name: str, views: tuple[str, ...] = (), sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL over the given views."""

    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name!r}")
        QUERIES[name] = query
        if sql is not None:
            body = sql.strip()
            if views:
                body = with_views(*views) + (", " + body[5:] if body.startswith("WITH ") else body)
            ORACLES[name] = body
        return query

    return register


def load() -> None:
    """Import the modules that register queries."""
    from changelake.queries import changes, gates, lineage, registry, tables  # noqa: F401
