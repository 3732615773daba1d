"""Type-2 dimensions: versions with validity `[start_date, end_date)`."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.functions.keys import surrogate_key
from commerce_lake.functions.time import as_date, on_day
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.schemas import LAKE_DECIMAL, SEQ

Day = Column | dt.date | str


@dataclass(frozen=True)
class Dimension:
    """A dimension over one silver table; attributes map name to stored type."""

    name: str
    source: str
    key: str
    natural: str
    attributes: tuple[tuple[str, T.DataType], ...]
    # attribute -> stored value of a missing one
    defaults: tuple[tuple[str, object], ...] = ()

    def attribute_columns(self) -> list[Column]:
        fill = dict(self.defaults)
        return [
            (F.coalesce(F.col(n), F.lit(fill[n])) if n in fill else F.col(n)).cast(t).alias(n)
            for n, t in self.attributes
        ]

    @property
    def columns(self) -> list[str]:
        names = [n for n, _ in self.attributes]
        return [self.key, self.natural, *names, "start_date", "end_date", "is_current"]


DIM_USER = Dimension(
    "dim_user",
    "user",
    "user_key",
    "user_id",
    (
        ("name", T.StringType()),
        ("email", T.StringType()),
        ("phone", T.StringType()),
        ("created_time", T.TimestampType()),
    ),
)
DIM_CATEGORY = Dimension(
    "dim_category",
    "category",
    "category_key",
    "category_id",
    (("name", T.StringType()), ("parent_id", T.LongType())),
    defaults=(("parent_id", 0),),
)
DIM_PRODUCT = Dimension(
    "dim_product",
    "product",
    "product_key",
    "product_id",
    (
        ("name", T.StringType()),
        ("description", T.StringType()),
        ("price_amount", LAKE_DECIMAL),
        ("category_id", T.LongType()),
        ("stock_quantity", T.LongType()),
    ),
)
DIMENSIONS = {d.name: d for d in (DIM_USER, DIM_CATEGORY, DIM_PRODUCT)}


def touched_on(dim: Dimension, changes: DataFrame, day: Day) -> DataFrame:
    """The day's last change of each id. Touched means changed; attributes are not compared."""
    names = [dim.natural, *[n for n, _ in dim.attributes], "updated_time"]
    names += [SEQ] if SEQ in changes.columns else []
    todays = changes.where(on_day(F.col("updated_time"), day)).select(*names)
    return latest_by_key(todays, dim.natural, "updated_time")


def open_versions(dim: Dimension, rows: DataFrame, day: Day) -> DataFrame:
    """One open version per row, starting on `day`."""
    return rows.select(
        surrogate_key(F.col(dim.natural), day).alias(dim.key),
        F.col(dim.natural),
        *dim.attribute_columns(),
        as_date(day).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(1).alias("is_current"),
    )


def new_versions(dim: Dimension, changes: DataFrame, day: Day) -> DataFrame:
    return open_versions(dim, touched_on(dim, changes, day), day)


def expired_versions(dim: Dimension, snapshot: DataFrame, changes: DataFrame, day: Day) -> DataFrame:
    """Open versions of touched ids, closed on `day`."""
    ids = changes.where(on_day(F.col("updated_time"), day)).select(dim.natural).distinct()
    current = snapshot.where(F.col("is_current") == 1)
    return (
        current.join(ids, dim.natural, "left_semi")
        .withColumns({"end_date": as_date(day), "is_current": F.lit(0)})
        .select(*dim.columns)
    )


def delta(dim: Dimension, snapshot: DataFrame, changes: DataFrame, day: Day) -> DataFrame:
    """What one day adds: new open versions and closed old ones."""
    return new_versions(dim, changes, day).unionByName(expired_versions(dim, snapshot, changes, day))


def merge(dim: Dimension, *batches: DataFrame) -> DataFrame:
    """One row per (id, start_date): the last batch wins, a closed row beats an open one.

    General form for batches of any origin. It ranks the whole history; for the
    daily step `apply_day` gives the same rows with one join.
    """
    numbered = [b.select(*dim.columns, F.lit(i).alias("_batch")) for i, b in enumerate(batches)]
    rows = numbered[0]
    for other in numbered[1:]:
        rows = rows.unionByName(other)
    rows = rows.withColumn("_closed", 1 - F.col("is_current"))
    return latest_by_key(rows, [dim.natural, "start_date"], ["_batch", "_closed"]).select(*dim.columns)


def apply_day(dim: Dimension, versions: DataFrame, changes: DataFrame, day: Day) -> DataFrame:
    """Versions after `day`: touched open ones closed, new ones added.

    One join on the natural id. Closed versions pass through it unchanged, so a
    caller that stores them apart may pass the open ones alone.
    """
    touched = touched_on(dim, changes, day)
    hit = touched.select(dim.natural, F.lit(True).alias("_touched"))
    ends = F.col("_touched").isNotNull() & (F.col("is_current") == 1)
    seen = (
        versions.join(hit, dim.natural, "left")
        .withColumns(
            {
                "end_date": F.when(ends, as_date(day)).otherwise(F.col("end_date")),
                "is_current": F.when(ends, 0).otherwise(F.col("is_current")),
            }
        )
        .select(*dim.columns)
    )
    return seen.unionByName(open_versions(dim, touched, day))


def history(
    dim: Dimension, initial: DataFrame, changes: DataFrame, day: Day, before: Day | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """All versions that an initial load on `day` and the changes of every day give, in one go.

    The same rows as applying the days one after the other: the last change of an id on a day
    starts a version, and the next start of the id ends it. With `before`, only earlier changes
    count. With `ids`, the versions of the ids that stand there; others are left out before they
    are cleaned and ranked, which is exact, as an id's versions come from its own rows.
    """
    if ids is not None:
        asked = ids.select(dim.natural).distinct()
        initial, changes = (rows.join(asked, dim.natural, "left_semi") for rows in (initial, changes))
    start = F.to_date("updated_time")
    if before is not None:
        changes = changes.where(start < as_date(before))
    names = [dim.natural, *[n for n, _ in dim.attributes], "updated_time", *([SEQ] if SEQ in changes.columns else [])]
    # a change on the day of the initial load replaces what was loaded
    starts = changes.select(*names, start.alias("start_date"), F.lit(1).alias("_change")).unionByName(
        initial.select(*names, as_date(day).alias("start_date"), F.lit(0).alias("_change"))
    )
    newest = latest_by_key(starts, [dim.natural, "start_date"], ["_change", "updated_time"])
    end = F.lead("start_date").over(Window.partitionBy(dim.natural).orderBy("start_date"))
    return newest.select(
        surrogate_key(F.col(dim.natural), F.col("start_date")).alias(dim.key),
        F.col(dim.natural),
        *dim.attribute_columns(),
        "start_date",
        end.alias("end_date"),
    ).withColumn("is_current", F.col("end_date").isNull().cast("int"))


def high_water_mark(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.max("start_date").alias("last_date"))
