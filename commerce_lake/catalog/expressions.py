"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commerce_lake.catalog import query
from commerce_lake.catalog.views import capitalized, clean
from commerce_lake.functions import decode
from commerce_lake.functions.text import capitalize_name, clean_string, padded_number, upper_case
from commerce_lake.functions.time import hour_boundaries


@query("clean_string", f"SELECT doc_id, {clean('text')} AS text FROM documents")
def _clean_string(fx):
    return fx.source("documents").select("doc_id", clean_string(F.col("text")).alias("text"))


@query("capitalize_name", f"SELECT doc_id, {capitalized(clean('text'))} AS text FROM documents")
def _capitalize_name(fx):
    return fx.source("documents").select("doc_id", capitalize_name(clean_string(F.col("text"))).alias("text"))


@query("upper_case", f"SELECT doc_id, upper({clean('text')}) AS text FROM documents")
def _upper_case(fx):
    return fx.source("documents").select("doc_id", upper_case(clean_string(F.col("text"))).alias("text"))


@query(
    "decode_defaults",
    """SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS k_long,
              coalesce(TRY_CAST(event_type AS BIGINT), 0) AS bad_long,
              coalesce(TRY_CAST(event_type AS DOUBLE), 0.0) AS bad_double,
              coalesce(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 0.0) AS value_double,
              coalesce(json_extract_string(props, '$.missing'), '') AS empty_string,
              coalesce(CAST(value AS DECIMAL(12,2)), 0) AS value_decimal
       FROM events""",
)
def _decode_defaults(fx):
    k = F.get_json_object("props", "$.k")
    return fx.source("events").select(
        "event_id",
        decode.long_or_zero(k).alias("k_long"),
        decode.long_or_zero(F.col("event_type")).alias("bad_long"),
        decode.double_or_zero(F.col("event_type")).alias("bad_double"),
        decode.double_or_zero(F.col("value").cast("string")).alias("value_double"),
        decode.string_or_empty(F.get_json_object("props", "$.missing")).alias("empty_string"),
        decode.decimal_or_zero(F.col("value")).alias("value_decimal"),
    )


_MICROS = "(CASE WHEN event_type = 'error' THEN NULL ELSE epoch_us(ts) - 1705000000000000 END)"
_MILLIS = f"(CASE WHEN {_MICROS} < 0 THEN -((-{_MICROS}) // 1000) ELSE {_MICROS} // 1000 END)"


@query(
    "cdc_timestamps",
    f"""SELECT event_id, make_timestamp(coalesce({_MILLIS}, 0) * 1000) AS required_time,
               make_timestamp({_MILLIS} * 1000) AS optional_time FROM events""",
)
def _cdc_timestamps(fx):
    """Event times moved to both sides of 1970, missing for error events."""
    moved = F.unix_micros(F.col("ts").cast("timestamp")) - F.lit(1705000000000000)
    micros = F.when(F.col("event_type") != "error", moved)
    return fx.source("events").select(
        "event_id",
        decode.micros_to_timestamp_or_epoch(micros).alias("required_time"),
        decode.micros_to_timestamp(micros).alias("optional_time"),
    )


@query(
    "hour_boundaries",
    "SELECT order_id, date_diff('hour', created_at, updated_at) AS hours FROM t_final",
)
def _hour_boundaries(fx):
    hours = hour_boundaries(F.col("created_at"), F.col("updated_at"))
    return fx["order"].where(F.col("_seq") == 2).select("order_id", hours.alias("hours"))


@query(
    "arith_round",
    """SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole, round_even(o_orderkey * 0.125::DOUBLE, 2) AS half_even,
              CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice / (o_orderkey % 3) END AS share,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 3 - 1 AS DECIMAL(21,2)) AS scaled
       FROM orders""",
)
def _arith_round(fx):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return fx.source("orders").select(
        key,
        F.floor(price).alias("whole"),
        F.bround(key.cast("double") * 0.125, 2).alias("half_even"),
        F.try_divide(price, (key % 3).cast("double")).alias("share"),
        (price.cast("decimal(18,2)") * 3 - 1).cast("decimal(21,2)").alias("scaled"),
    )


@query(
    "string_build",
    """SELECT c_custkey, 'Buyer no. ' || c_custkey AS label, c_custkey || '.buyer@shop.example' AS mailbox,
              'A' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code FROM customer""",
)
def _string_build(fx):
    key = F.col("c_custkey")
    text = key.cast("string")
    return fx.source("customer").select(
        key,
        F.concat(F.lit("Buyer no. "), text).alias("label"),
        F.concat(text, F.lit(".buyer@shop.example")).alias("mailbox"),
        F.concat(F.lit("A"), padded_number(key, 6)).alias("code"),
    )


@query(
    "status_case",
    """SELECT order_id, CASE WHEN order_status = 'completed' THEN 'completed'
                             WHEN total_amount > 250000 THEN 'failed large'
                             WHEN total_amount > 100000 THEN 'failed medium' ELSE 'failed small' END AS state
       FROM t_final""",
)
def _status_case(fx):
    amount = F.col("total_amount")
    state = (
        F.when(F.col("order_status") == "completed", "completed")
        .when(amount > 250000, "failed large")
        .when(amount > 100000, "failed medium")
        .otherwise("failed small")
    )
    return fx["order"].where(F.col("_seq") == 2).select("order_id", state.alias("state"))
