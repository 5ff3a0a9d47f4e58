"""Named queries, each beside the SQL that must give the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quillframe.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, path: str) -> DataFrame:
        return self.build(Tables(spark, path))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a builder; ``sql`` is left out where no exact SQL form exists."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return add


def load_catalog() -> dict[str, Query]:
    from quillframe import catalog

    catalog.load()
    return QUERIES
