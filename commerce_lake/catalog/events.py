"""Change events: envelope round trips for the eight tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.catalog import query
from commerce_lake.schemas import SEQ, TABLES
from commerce_lake.sources import cdc, versions


def source_rows(fx, name):
    """Rows as the operational table holds them: absent values are NULL."""
    spec, rows = TABLES[name], fx[name]
    optional = [f.name for f in spec.fields if f.kind == "string?"]
    rows = rows.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in optional})
    if name == "product":
        rows = rows.withColumn("category_id", F.nullif(F.col("category_id"), F.lit(0).cast("bigint")))
    return rows


def _register(name: str) -> None:
    @query(f"bronze_{name}", f"SELECT * FROM t_{name}")
    def _build(fx):
        spec = TABLES[name]
        return cdc.json_to_bronze(cdc.to_json_events(source_rows(fx, name), spec), spec)


for _name in TABLES:
    _register(_name)


@query(
    "cdc_flatten",
    "SELECT * REPLACE (CASE WHEN tracking_number = '' THEN NULL ELSE tracking_number END AS tracking_number) FROM t_shipping",
)
def _cdc_flatten(fx):
    spec = TABLES["shipping"]
    events = cdc.to_json_events(source_rows(fx, "shipping"), spec)
    return cdc.flatten(cdc.parse_json_events(events, spec), spec)


def _with_cut_events(fx):
    """Order events; those of cancelled orders were cut off on their way."""
    spec = TABLES["order"]
    events = cdc.to_json_events(fx["order"], spec)
    cancelled = F.get_json_object("value", "$.after.order_status") == "cancelled"
    return events.withColumn("value", F.when(cancelled, F.expr("left(value, length(value) - 20)")).otherwise(F.col("value"))), spec


@query("cdc_rejected", "SELECT order_id, _seq FROM t_order WHERE order_status = 'cancelled'")
def _cdc_rejected(fx):
    events, spec = _with_cut_events(fx)
    number = F.regexp_extract("value", r'"order_id":(\d+)', 1).cast("bigint")
    return cdc.rejected_events(events, spec).select(number.alias("order_id"), SEQ)


@query("cdc_accepted", "SELECT * FROM t_order WHERE order_status <> 'cancelled'")
def _cdc_accepted(fx):
    events, spec = _with_cut_events(fx)
    return cdc.json_to_bronze(events, spec, bad="skip")


@query("cdc_drop_deletes", "SELECT * FROM t_order WHERE order_status <> 'cancelled' AND total_amount >= 10000")
def _cdc_drop_deletes(fx):
    """Cancelled orders arrive as deletes, cheap ones as tombstones without any value."""
    spec = TABLES["order"]
    rows = fx["order"]
    events = cdc.to_json_events(rows, spec, deleted=F.col("order_status") == "cancelled")
    cheap = F.get_json_object("value", "$.after.total_amount").cast("decimal(18,2)") < 10000
    events = events.withColumn("value", F.when(~F.coalesce(cheap, F.lit(False)), F.col("value")))
    return cdc.flatten(cdc.parse_json_events(events, spec), spec).select(
        *[F.col(f.name).cast(f.dataType) for f in spec.bronze_schema().fields], SEQ
    )


_OLD = "1995-01-01"


def old_order():
    """The record that the first order service wrote: a number for the amount, no user, another name for the status."""
    record = T.StructType().add("order_id", "integer").add("status", "string").add("total_amount", "double")
    return record.add("created_at", "long").add("updated_at", "long"), {"order_status": "status"}


def order_readers(spec):
    wire = cdc.envelope_schema(spec)["after"].dataType
    return {7: versions.json_reader(spec, *old_order()), 1042: versions.json_reader(spec, wire)}


@query(
    "cdc_schema_versions",
    f"SELECT * REPLACE (CASE WHEN created_at < TIMESTAMP '{_OLD}' THEN 0 ELSE user_id END AS user_id) FROM t_order",
)
def _cdc_schema_versions(fx):
    """Orders of two services in one batch, each message read by the schema that it names."""
    spec, rows = TABLES["order"], fx["order"]
    old = F.col("created_at") < F.lit(_OLD).cast("timestamp")
    earlier = F.struct(
        "order_id", F.col("order_status").alias("status"), F.col("total_amount").cast("double").alias("total_amount"),
        F.unix_micros("created_at").alias("created_at"), F.unix_micros("updated_at").alias("updated_at"),
    )
    first = rows.where(old).select(SEQ, versions.frame(F.to_json(F.struct(earlier.alias("after"))), 7).alias("value"))
    newer = cdc.to_json_events(rows.where(~old), spec).withColumn("value", versions.frame(F.col("value"), 1042))
    events = first.unionByName(newer.select(SEQ, "value"))
    return cdc.to_bronze(cdc.flatten(versions.parse_versions(events, spec, order_readers(spec)), spec), spec)
