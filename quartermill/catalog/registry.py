"""Registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quartermill.catalog.tables import Tables


@dataclass(frozen=True)
class Query:
    """One registered query."""

    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name`` with its SQL statement."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = Query(name, fn, sql)
        return fn

    return register
