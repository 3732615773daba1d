"""As-of dimension joins and the default-filling outer join."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date

_MATCHED = "_matched"
_SALT = "_salt"
_VERSION = "_version"
# Fixed value: the period whose versions an as-of join looks through.
PERIOD = "MM"


def valid_at(
    at: Column | dt.date | str,
    start: Column | str = "start_date",
    end: Column | str = "end_date",
    current: Column | str = "is_current",
) -> Column:
    """Version valid on a date: start <= date, and date < end or the version is open."""
    start, end, current = (F.col(c) if isinstance(c, str) else c for c in (start, end, current))
    day = as_date(at)
    return (start <= day) & ((end > day) | (current == 1))


def asof_inner(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    at: Column,
    columns: list[str],
) -> DataFrame:
    """Facts with the dimension version valid at each fact's own date.

    Facts without a valid version are dropped: the validity test stands in the
    WHERE clause of a left join, which makes that join inner. See `_with_version` for the way.
    """
    found = _with_version(facts, dimension, key, at, columns, "inner").where(F.col(_VERSION).isNotNull())
    return found.withColumns({name: F.col(_VERSION)[name] for name in columns}).drop(_VERSION)


def asof_left(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    at: Column | dt.date | str,
    columns: list[str],
    defaults: Mapping[str, object],
) -> DataFrame:
    """All facts, with the dimension version valid on a date where there is one.

    A date that is the same for all rows cuts the dimension first, and its build
    side holds one version per key. A column gives each row its own date.
    """
    if isinstance(at, Column):
        types = {f.name: f.dataType for f in dimension.schema.fields}
        found = _with_version(facts, dimension, key, at, columns, "left")
        filled = {n: F.when(F.col(_VERSION).isNull(), F.lit(v).cast(types[n])).otherwise(F.col(_VERSION)[n]) for n, v in defaults.items()}
        return found.withColumns({**{n: F.col(_VERSION)[n] for n in columns}, **filled}).drop(_VERSION)
    dim = dimension.where(valid_at(at)).select(key, *columns)
    return left_join_default(facts, dim, key, defaults)


def versions_by_period(dimension: DataFrame, asked: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, _period, _versions: the versions that can be valid in each asked (key, _period), by start.

    Versions and asked periods form one stream per key in order of time. The last version before
    a period is carried into it, and joins those that start within it. A version starts
    on a day, so a period of a month has at most 32 of them however long the history is.
    """
    version = F.struct(F.col("start_date").alias("_start"), F.col("end_date").alias("_end"), F.col("is_current").alias("_current"), *columns)
    stream = dimension.select(key, F.trunc("start_date", PERIOD).alias("_period"), F.col("start_date").alias("_t"), F.lit(1).alias("_side"), version.alias("_v"))
    stream = stream.unionByName(asked.select(key, "_period", F.col("_period").alias("_t"), F.lit(0).alias("_side")), allowMissingColumns=True)
    # a period comes before the versions that start on its first day: these are its own
    so_far = Window.partitionBy(key).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = stream.withColumn("_open", F.last("_v", ignorenulls=True).over(so_far))
    asked_for = F.col("_side") == 0
    return (
        carried.groupBy(key, "_period")
        .agg(
            F.bool_or(asked_for).alias("_asked"),
            F.collect_list(F.when(asked_for, F.col("_open")).otherwise(F.col("_v"))).alias("_versions"),
        )
        .where("_asked")
        .select(key, "_period", F.sort_array("_versions").alias("_versions"))
    )


def _with_version(facts: DataFrame, dimension: DataFrame, key: str, at: Column, columns: list[str], how: str) -> DataFrame:
    """`facts` with the version valid at `at` as a struct, joined by key and period.

    Versions of a key must not overlap, which a type-2 history keeps. Each fact meets one row, with
    the few versions of its period, so the join gives as many rows as there are facts;
    it is a plain equi-join, in which Spark splits hot keys and broadcasts a small side.
    """
    dated = facts.withColumn("_period", F.trunc(at, PERIOD))
    asked = dated.select(key, "_period").where(F.col(key).isNotNull() & F.col("_period").isNotNull()).distinct()
    rows = dated.join(versions_by_period(dimension, asked, key, columns), [key, "_period"], how)
    day = as_date(at)
    valid = F.filter("_versions", lambda v: valid_at(day, v["_start"], v["_end"], v["_current"]))
    # the order of columns is that of `facts`, which the join by name has changed
    return rows.withColumn(_VERSION, F.try_element_at(valid, F.lit(-1))).select(*facts.columns, _VERSION)


def left_join_default(
    left: DataFrame,
    right: DataFrame,
    on: str | list[str],
    defaults: Mapping[str, object],
    spread_by: str | None = None,
) -> DataFrame:
    """Left join whose unmatched rows carry type defaults instead of NULL.

    Only columns named in `defaults` are filled and only on unmatched rows: a
    NULL that stands in a matched right row survives.

    AQE can split a hot key of an outer join on the preserved side only. Where
    the right side may hold very many rows of one key, name a column in
    `spread_by` that tells those rows apart (it is not part of the result): they
    are then dealt over all partitions by its hash.
    """
    on = [on] if isinstance(on, str) else list(on)
    if spread_by is not None:
        left, right = _deal_rows(left, right, on, spread_by)
        return left_join_default(left, right, [*on, _SALT], defaults).drop(_SALT)
    marked = right.withColumn(_MATCHED, F.lit(True))
    types = {f.name: f.dataType for f in right.schema.fields}
    filled = {
        name: F.when(F.col(_MATCHED).isNull(), F.lit(value).cast(types[name])).otherwise(F.col(name))
        for name, value in defaults.items()
    }
    return left.join(marked, on, "left").withColumns(filled).drop(_MATCHED)


def _deal_rows(
    left: DataFrame, right: DataFrame, on: list[str], spread_by: str
) -> tuple[DataFrame, DataFrame]:
    """Add a salt to both sides so that each left row meets each right row once.

    A left row is repeated for exactly the salts its key has on the right, so a
    repeated row always finds a match and an unmatched row stays single. The
    salt set of a key is at most as long as there are shuffle partitions and is
    combined before its shuffle.
    """
    buckets = int(right.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(buckets)).cast("int")
    salted = right.withColumn(_SALT, salt).drop(spread_by)
    present = salted.groupBy(*on).agg(F.collect_set(_SALT).alias("_salts"))
    reaching = left.join(present, on, "left").withColumn(_SALT, F.explode_outer("_salts")).drop("_salts")
    return reaching, salted
