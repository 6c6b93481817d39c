"""Where queries and the SQL that checks them are kept together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` computes the same rows in DuckDB."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_render(template: str, *exprs: str) -> str:
    """A prompt template as a SQL expression."""
    pieces = template.split("%s")
    parts = [quote(pieces[0])]
    for e, after in zip(exprs, pieces[1:], strict=True):
        parts += [f"({e})", quote(after)]
    return "(" + " || ".join(parts) + ")"
