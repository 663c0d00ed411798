"""Queries of the engine's own operators over the test tables, each over its whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function (spark, sf_dir) under its name, with its SQL."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from corpusloom.plans import corpus, events, sources, titles, units  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
