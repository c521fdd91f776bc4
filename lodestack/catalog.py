"""Registry of the named queries: callable, DuckDB SQL and the operators shown."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None
    operators: tuple[str, ...]


QUERIES: dict[str, Query] = {}


def sql_text(value: str | int | None) -> str:
    """A value as a literal of SQL."""
    return "NULL" if value is None else str(value) if isinstance(value, int) else "'" + value.replace("'", "''") + "'"


def sql_rows(rows: list[tuple]) -> str:
    """Rows of values as they stand after VALUES."""
    return ", ".join("(" + ", ".join(map(sql_text, r)) + ")" for r in rows)


def query(operators: str, sql: str | None = None) -> Callable[[Run], Run]:

    def register(run: Run) -> Run:
        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__} is there already")
        QUERIES[run.__name__] = Query(run, sql, tuple(operators.split()))
        return run

    return register


def load() -> dict[str, Query]:
    from . import plans  # noqa: F401  registers all queries

    return QUERIES
