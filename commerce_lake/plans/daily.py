"""The daily run: hot bronze to cold, silver, dimensions, facts, marts.

Each step replaces whole partitions, of the day and of the dates that its rows belong to, so
a run that was cut off can be started again for the same day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType

from commerce_lake.functions.time import as_date
from commerce_lake.operators import scd2
from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.operators.silver import to_silver
from commerce_lake.plans import facts, marts, publication
from commerce_lake.plans.publication import Ledger, Publication
from commerce_lake.schemas import BATCH, DAY, SEQ, TABLES, TableSpec
from commerce_lake.sources import tables


_LOADS_SCHEMA = "dimension string, generation int, load_date date"


class AlreadyProcessed(RuntimeError):
    """The day, or a later one, is already in the target table."""


@dataclass(frozen=True)
class Lake:
    """Table locations: hot tier, cold tier and everything derived."""

    spark: SparkSession
    root: str
    cold_root: str | None = None

    def path(self, table: str) -> str:
        base = self.cold_root if self.cold_root and table.startswith("bronze_cold_") else self.root
        return f"{base}/{table}"

    def exists(self, table: str) -> bool:
        return tables.exists(self.spark, self.path(table))

    def read(self, table: str) -> DataFrame:
        """A fact or mart as last published, or a load log, with its declared schema; empty if never written."""
        schema = facts.SCHEMAS.get(table) or marts.SCHEMAS.get(table)
        if schema is not None:
            return publication.read(self, table, schema, publication.current(self)[1].get(table, {}))
        if not self.exists(table):
            return self.spark.createDataFrame([], _LOADS_SCHEMA)
        return self.spark.read.schema(_LOADS_SCHEMA).parquet(self.path(table))

    def bronze_schema(self, spec: TableSpec) -> StructType:
        return spec.bronze_schema().add(SEQ, LongType()).add(DAY, DateType()).add(BATCH, LongType())

    def read_bronze(self, spec: TableSpec, tier: str) -> DataFrame:
        """Bronze with its declared schema: no footer is read to infer one."""
        schema = self.bronze_schema(spec)
        table = self.spark.read.schema(schema).parquet(self.path(f"bronze_{tier}_{spec.name}"))
        return table.select(*schema.names)

    def write(self, df: DataFrame, table: str, column: str, sort: list[str]) -> None:
        tables.overwrite_partitions(df, self.path(table), column, sort)


def _batches(table: DataFrame) -> dict[tuple, int]:
    """Rows of each (day, ingest batch): one count for a batch, not a row of data."""
    counted = table.groupBy(DAY, BATCH).count().collect()
    return {(r[DAY], r[BATCH]): r["count"] for r in counted}


def _of_batches(table: DataFrame, batches: list[tuple]) -> DataFrame:
    """Rows of the given batches; only their partitions are read."""
    by_day: dict = {}
    for day, batch in batches:
        by_day.setdefault(day, []).append(batch)
    return table.where(reduce(or_, ((F.col(DAY) == F.lit(d)) & F.col(BATCH).isin(b) for d, b in by_day.items())))


def copy_to_cold(lake: Lake, spec: TableSpec, day: dt.date | str) -> list[tuple]:
    """Copy the hot batches of `day` and of earlier days to the cold tier; returns (day, batch) of each.

    A batch goes as a whole and replaces only itself, so late batches add to what is cold, and a
    repeated copy writes the same again. A batch is copied unless cold has at least its rows, which
    keeps one whose deletion from hot was cut off. Copies are counted.
    """
    if not lake.exists(spec.bronze_hot):
        return []
    hot = lake.read_bronze(spec, "hot")
    found = _batches(hot.where(F.col(DAY) <= as_date(day)))
    if not found:
        return []

    def in_cold() -> dict[tuple, int]:
        if not lake.exists(spec.bronze_cold):
            return {}
        return _batches(_of_batches(lake.read_bronze(spec, "cold"), list(found)))

    there = in_cold()
    missing = [b for b, rows in found.items() if there.get(b, 0) < rows]
    if missing:
        rows = _of_batches(hot, missing).repartition(DAY, BATCH).sortWithinPartitions(DAY, BATCH, "updated_at")
        tables.overwrite_partitions(rows, lake.path(spec.bronze_cold), [DAY, BATCH])
        there = in_cold()
    for batch, rows in found.items():
        if there.get(batch, 0) < rows:
            raise RuntimeError(f"{spec.bronze_cold} {batch}: {there.get(batch, 0)} of {rows} rows copied")
    return sorted(found)


def drop_from_hot(lake: Lake, spec: TableSpec, batches: list[tuple]) -> None:
    """Delete exactly these batches; what ingest writes meanwhile is not among them and stays."""
    for date, batch in batches:
        tables.drop_partition(lake.spark, lake.path(spec.bronze_hot), DAY, f"{date}/{BATCH}={batch}")


def move_to_cold(lake: Lake, spec: TableSpec, day: dt.date | str) -> list[dt.date]:
    """Copy and drop; returns the days of the moved batches."""
    batches = copy_to_cold(lake, spec, day)
    drop_from_hot(lake, spec, batches)
    return sorted({date for date, _ in batches})


def read_log(lake: Lake, spec: TableSpec, since: dt.date | str | None = None) -> DataFrame:
    """Both tiers as one log, for the live marts; a batch that stands in both counts once."""
    tiers = [t for t in ("hot", "cold") if lake.exists(f"bronze_{t}_{spec.name}")]
    if not tiers:
        return lake.spark.createDataFrame([], lake.bronze_schema(spec)).drop(BATCH)
    logs = [lake.read_bronze(spec, t) for t in tiers]
    if since is not None:
        logs = [log.where(F.col(DAY) >= as_date(since)) for log in logs]
    if len(logs) == 1:
        return logs[0].drop(BATCH)
    hot, cold = logs
    moved = cold.select(DAY, BATCH).distinct()
    return hot.join(moved, [DAY, BATCH], "left_anti").select(cold.columns).unionByName(cold).drop(BATCH)


def build_silver(lake: Lake, spec: TableSpec, day: dt.date | str, dedup: bool = True) -> None:
    """Clean one cold day; with `dedup` keep each key's last version of the day."""
    if not lake.exists(spec.bronze_cold):
        return
    bronze = tables.scan_day(lake.read_bronze(spec, "cold"), day).drop(BATCH)
    if dedup:
        bronze = latest_by_key(bronze.drop(DAY), spec.key).withColumn(DAY, as_date(day))
    silver = to_silver(bronze.drop(DAY)).withColumn(DAY, as_date(day))
    lake.write(silver, spec.silver, DAY, ["updated_time"])


def silver_schema(spec: TableSpec) -> StructType:
    """Declared silver schema, the projection of the bronze one."""
    empty = SparkSession.active().createDataFrame([], spec.bronze_schema().add(SEQ, LongType()))
    return to_silver(empty).schema.add(DAY, DateType())


def read_silver(lake: Lake, name: str, until: dt.date | str) -> DataFrame:
    """Silver history up to a day; later partitions are not listed for the scan."""
    spec = TABLES[name]
    schema = silver_schema(spec)
    if not lake.exists(spec.silver):
        return lake.spark.createDataFrame([], schema)
    return lake.spark.read.schema(schema).parquet(lake.path(spec.silver)).where(F.col(DAY) <= as_date(until))


# --- dimensions -----------------------------------------------------------------
# Versions are partitioned by (generation, is_current, load_date). A load writes the
# versions it closed and a fresh snapshot of the open ones, in one job; closed history
# is never read back or rewritten. The row in the load log, written last, makes the
# load count. Where the past has changed, the whole history is written as a new
# generation, which the log names in the same way.


def _loads(dim: scd2.Dimension) -> str:
    return f"{dim.name}_loads"


def _version_schema(dim: scd2.Dimension) -> str:
    attributes = ", ".join(f"{n} {t.simpleString()}" for n, t in dim.attributes)
    natural = f"{dim.key} string, {dim.natural} bigint"
    return f"{natural}, {attributes}, start_date date, end_date date, generation int, is_current int, load_date date"


def _last(lake: Lake, dim: scd2.Dimension) -> tuple[dt.date, int] | None:
    """Newest finished load, day and generation, from the load log (one row per load)."""
    newest = lake.read(_loads(dim)).agg(F.max(F.struct("generation", "load_date")).alias("last")).first()["last"]
    return (newest["load_date"], newest["generation"]) if newest else None


def last_load(lake: Lake, dim: scd2.Dimension) -> dt.date | None:
    last = _last(lake, dim)
    return last[0] if last else None


def _versions(lake: Lake, dim: scd2.Dimension, generation: int) -> DataFrame:
    rows = lake.spark.read.schema(_version_schema(dim)).parquet(lake.path(dim.name))
    return rows.where(F.col("generation") == generation)


def _open_versions(lake: Lake, dim: scd2.Dimension, load: dt.date, generation: int) -> DataFrame:
    newest = (F.col("is_current") == 1) & (F.col("load_date") == as_date(load))
    return _versions(lake, dim, generation).where(newest).select(*dim.columns)


def read_dimension(lake: Lake, dim: scd2.Dimension) -> DataFrame:
    """All versions: closed history plus the newest snapshot of open ones."""
    last = _last(lake, dim)
    if last is None or not lake.exists(dim.name):
        return lake.spark.createDataFrame([], _version_schema(dim)).select(*dim.columns)
    # partitions newer than the last logged load belong to a run that was cut off
    history = (F.col("is_current") == 0) & (F.col("load_date") <= as_date(last[0]))
    closed = _versions(lake, dim, last[1]).where(history).select(*dim.columns)
    return closed.unionByName(_open_versions(lake, dim, *last))


def _write_versions(lake: Lake, dim: scd2.Dimension, versions: DataFrame, day: dt.date | str, generation: int) -> None:
    number, load = F.lit(generation).alias("generation"), as_date(day).alias("load_date")
    rows = versions.select("*", number, load).sortWithinPartitions("is_current", dim.natural, "start_date")
    tables.overwrite_partitions(rows, lake.path(dim.name), ["generation", "is_current", "load_date"])
    log = lake.spark.range(1).select(F.lit(dim.name).alias("dimension"), number, load)
    tables.overwrite_partitions(log, lake.path(_loads(dim)), ["generation", "load_date"])


def rebuild_dimension(lake: Lake, dim: scd2.Dimension, day: dt.date | str) -> None:
    """The whole history up to `day` from silver, as a new generation."""
    last = _last(lake, dim)
    changes = read_silver(lake, dim.source, day).drop(DAY)
    versions = scd2.history(dim, changes.where(F.lit(False)), changes, day)
    _write_versions(lake, dim, versions, day, last[1] + 1 if last else 0)


def load_dimension(lake: Lake, dim: scd2.Dimension, day: dt.date | str, rerun: bool = False, late: bool = False) -> None:
    """Apply one day's changes. Days must come in order.

    A day already loaded raises. With `rerun` the newest loaded day is accepted, and with `late`
    earlier days have changed too; then the history is built anew. Snapshots of open versions
    older than the previous load are dropped.
    """
    last = _last(lake, dim)
    date = dt.date.fromisoformat(str(day))
    if last is not None and last[0] >= date and not (rerun and last[0] == date):
        raise AlreadyProcessed(f"{dim.name}: last load {last[0]} >= {day}")
    if late or (last is not None and last[0] == date):
        return rebuild_dimension(lake, dim, day)
    changes = read_silver(lake, dim.source, day).where(F.col(DAY) == as_date(day))
    if last is None or not lake.exists(dim.name):
        versions, generation = scd2.new_versions(dim, changes, day), 0
    else:
        versions, generation = scd2.apply_day(dim, _open_versions(lake, dim, *last), changes, day), last[1]
    _write_versions(lake, dim, versions, day, generation)
    if last is not None:
        kept = {str(last[0]), str(day)}
        for load in lake.read(_loads(dim)).where(F.col("generation") == generation).select("load_date").distinct().collect():
            if str(load[0]) not in kept:
                old = f"{lake.path(dim.name)}/generation={generation}/is_current=1"
                tables.drop_partition(lake.spark, old, "load_date", load[0])


# --- facts and marts ------------------------------------------------------------


def _refuse(lake: Lake, table: str, day: dt.date | str) -> None:
    if publication.current(lake)[1].get(table, {}).get(str(day)) is not None:
        raise AlreadyProcessed(f"{table}: {day} already processed")


def _staged(out: Publication, table: str) -> DataFrame:
    """A table as this run will publish it."""
    return publication.read(out.lake, table, facts.SCHEMAS.get(table) or marts.SCHEMAS[table], out.days(table))


def fact_days(lake: Lake, days: list[dt.date]) -> list[dt.date]:
    """The dates whose facts depend on the silver partitions of `days`: these and the creation dates in them."""
    until = max(days)
    found = set(days)
    for name in ("order", "order_item"):
        touched = read_silver(lake, name, until).where(F.col(DAY).isin(days))
        found |= {r[0] for r in touched.select(F.to_date("created_time")).distinct().collect() if r[0] and r[0] <= until}
    return sorted(found)


def load_facts(
    lake: Lake, day: dt.date | str, rerun: bool = False, days: list[dt.date] | None = None, into: Publication | None = None
) -> list[dt.date]:
    """Order facts of `day`, and of every date that its silver rows, or those of `days`, belong to.

    An item or order may reach the log days after its creation; the facts of its creation date are
    then built again. Versions of a row are stamped on or after its creation, so silver of orders
    and items is read from the first of these dates on. An order that ended on one of them may have
    been shipped and paid before, so shipping and payment of the chosen orders are read unbounded.
    Returns the dates. They are published at once, or with the rest of `into`.
    """
    out = into or Publication(lake)
    date = dt.date.fromisoformat(str(day))
    dates = fact_days(lake, sorted({date, *(days or [])}))
    if not rerun:
        _refuse(lake, "fact_order", day)

    def newest(name: str, *columns: str, ids: DataFrame | None = None) -> DataFrame:
        key = TABLES[name].key
        rows = read_silver(lake, name, day)
        if ids is None:
            rows = rows.where(F.col(DAY) >= as_date(dates[0]))
        rows = rows.select(*dict.fromkeys([key, "order_id", *columns, "updated_time", SEQ]))
        if ids is not None:
            rows = rows.join(ids, "order_id", "left_semi")
        return latest_by_key(rows, key, "updated_time")

    orders = newest("order", "user_id", "order_status", "total_amount", "created_time")
    in_dates = lambda c: F.to_date(c).isin(dates)
    orders = orders.where(in_dates("created_time") | in_dates("updated_time"))
    ids = orders.select("order_id").distinct()
    rows = facts.fact_order(
        orders,
        read_dimension(lake, scd2.DIM_USER),
        newest("shipping", "postal_code", "country", "city", ids=ids),
        newest("payment", "payment_method", ids=ids),
        None,
    ).where(F.col("date_key").isin(dates))
    out.write("fact_order", rows, dates, ["order_id", "user_key"])
    items = newest("order_item", "product_id", "quantity", "price_amount", "created_time").where(in_dates("created_time"))
    details = facts.fact_order_detail(
        items, read_dimension(lake, scd2.DIM_PRODUCT), read_dimension(lake, scd2.DIM_CATEGORY), None
    )
    out.write("fact_order_detail", details, dates, ["order_id"])
    if into is None:
        out.commit()
    return dates


def load_marts(
    lake: Lake, day: dt.date | str, rerun: bool = False, days: list[dt.date] | None = None, into: Publication | None = None
) -> None:
    """Marts of `day` and of the other dates whose facts were built again, published at once or with the rest of `into`."""
    out = into or Publication(lake)
    fact, detail = _staged(out, "fact_order"), _staged(out, "fact_order_detail")
    if not rerun:
        _refuse(lake, "daily_transaction", day)
    for date in sorted({dt.date.fromisoformat(str(day)), *(days or [])}):
        sales = marts.daily_transaction(fact, detail, read_dimension(lake, scd2.DIM_CATEGORY), date)
        out.write("daily_transaction", sales, [date], ["order_status", "country"])
        users = marts.daily_user(fact, read_dimension(lake, scd2.DIM_USER), date)
        out.write("daily_user", users, [date], ["active_user"])
    if into is None:
        out.commit()


def run_day(lake: Lake, day: dt.date | str, rerun: bool = False, dedup_silver: bool = True) -> None:
    """All steps of one day, in dependency order. `rerun` repeats a finished day.

    Rows of earlier days that came late are moved too; their silver days, the dimensions, and the
    facts and marts they belong to are built again. Facts and marts are published together; hot
    batches are dropped at the very end. A run that was cut off is continued by the next call for
    its day, from the first step that is not in its ledger.
    """
    ledger = Ledger(lake, day)
    try:
        if not (rerun or ledger.resumed):
            _refuse(lake, "fact_order", day)
        _run_steps(lake, ledger, day, rerun or ledger.resumed, dedup_silver)
    except (AlreadyProcessed, publication.ConcurrentRun) as refused:
        ledger.finish(type(refused).__name__)
        raise
    ledger.finish()


def _run_steps(lake: Lake, ledger: Ledger, day: dt.date | str, rerun: bool, dedup_silver: bool) -> None:
    date = dt.date.fromisoformat(str(day))
    base = ledger.step("begin", lambda: publication.current(lake)[0])
    copied = ledger.step("copy", lambda: {spec.name: copy_to_cold(lake, spec, day) for spec in TABLES.values()})
    batches = {name: [(dt.date.fromisoformat(d), batch) for d, batch in found] for name, found in copied.items()}
    moved = {name: sorted({d for d, _ in found if d < date}) for name, found in batches.items()}

    def silver() -> None:
        for spec in TABLES.values():
            for each in sorted({date, *moved[spec.name]}):
                build_silver(lake, spec, each, dedup_silver)

    ledger.step("silver", silver)
    for dim in scd2.DIMENSIONS.values():
        late = bool(moved[dim.source]) or last_load(lake, dim) is None
        ledger.step(dim.name, lambda dim=dim, late=late: load_dimension(lake, dim, day, rerun, late=late))

    def build() -> dict:
        out = Publication(lake, ledger.run, base)
        days = load_facts(lake, day, True, sorted({d for x in moved.values() for d in x}), into=out)
        load_marts(lake, day, True, days, into=out)
        return out.staged

    staged = ledger.step("build", build)

    def publish() -> None:
        out = Publication(lake, ledger.run, base, staged)
        # the commit itself may be what was cut off before its note
        if out.published != {**out.published, **{t: out.days(t) for t in staged}}:
            out.commit()

    ledger.step("publish", publish)
    for spec in TABLES.values():
        drop_from_hot(lake, spec, batches[spec.name])
