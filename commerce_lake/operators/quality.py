"""Constraint checks: keys, references, ranges and missing values as Spark jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def orphans(
    child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str, absent: int | None = None
) -> DataFrame:
    """Foreign key values without a parent row, with the number of rows that use them.

    Child rows are counted per value before the anti join, so that a value used
    by very many rows meets the parent as one row. Parent keys go to the join as
    they are: it looks for a first match only, and keys that are nearly all
    different would only fill the hash map of a `distinct`. It is a merge join:
    the size estimate of a compressed parent lets Spark broadcast millions of
    keys, a table of which every task would hold. `absent` is the stored form
    of "no reference".
    """
    used = child.where(F.col(foreign_key).isNotNull())
    if absent is not None:
        used = used.where(F.col(foreign_key) != absent)
    counts = used.groupBy(F.col(foreign_key).alias("key_value")).agg(F.count("*").alias("row_count"))
    known = parent.select(F.col(parent_key).alias("key_value"))
    return counts.join(known.hint("merge"), "key_value", "left_anti")


def out_of_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.where(~F.col(column).between(low, high))


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count of each column, in one pass, as (column_name, null_count) rows."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counts.select(F.inline(pairs))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
