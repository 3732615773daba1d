"""Registered queries with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from commerce_lake import fixtures
from commerce_lake.catalog.views import with_views

# Days and instants that the sample data covers well.
DAY = "2000-08-03"
AS_OF = "2000-08-03 15:00:00"
LATE_AS_OF = "2000-08-03 18:00:00"
INITIAL_DAY = "1995-01-01"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[fixtures.Fixtures], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(fixtures.load(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the derived tables under `name`.

    `sql` may use the names of `catalog.views`; needed ones are added as CTEs.
    """

    def add(build):
        REGISTRY[name] = Query(name, build, with_views(sql) if sql else None)
        return build

    return add


def all_queries() -> dict[str, Query]:
    from commerce_lake.catalog import dimensions, events, expressions, live, marts, relational, streams

    assert all((dimensions, events, expressions, live, marts, relational, streams))
    return dict(REGISTRY)
