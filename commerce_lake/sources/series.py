"""Generated rows: number series, grids of two series, the calendar, literal rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date, calendar_columns

# First day and length of the calendar (up to 2099-12-31).
CALENDAR_START = dt.date(2025, 1, 1)
CALENDAR_DAYS = 27393


def number_series(spark: SparkSession, first: int, last: int, name: str = "n") -> DataFrame:
    """first, first + 1, .., last."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def number_grid(spark: SparkSession, outer: tuple[int, int], inner: tuple[int, int]) -> DataFrame:
    """All pairs (g, i) of two inclusive series.

    One series as long as the grid, taken apart by division: no join is needed.
    """
    width = inner[1] - inner[0] + 1
    cells = (outer[1] - outer[0] + 1) * width
    n = F.col("id")
    return spark.range(cells).select(
        (F.floor(n / width) + outer[0]).cast("bigint").alias("g"),
        (n % width + inner[0]).cast("bigint").alias("i"),
    )


def calendar(spark: SparkSession, start: dt.date = CALENDAR_START, days: int = CALENDAR_DAYS) -> DataFrame:
    day = F.date_add(as_date(start), F.col("id").cast("int"))
    return spark.range(days).select(day.alias("d")).select(*calendar_columns(F.col("d")))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A handful of rows given in the code."""
    return spark.createDataFrame(list(rows), schema)
