"""Decoding of change-event fields: typed values with defaults for missing ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lake.schemas import SOURCE_DECIMAL, Field, TableSpec


def long_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))


def int_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(0))


def double_or_zero(c: Column) -> Column:
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def string_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def decimal_or_zero(c: Column) -> Column:
    """Missing becomes 0; a value that is no number raises (plain ANSI cast)."""
    return F.coalesce(c.cast(SOURCE_DECIMAL), F.lit(0).cast(SOURCE_DECIMAL))


def micros_to_timestamp(c: Column) -> Column:
    """Epoch microseconds to a millisecond timestamp, truncating toward zero."""
    return F.timestamp_millis(_div(c.try_cast("bigint"), 1000))


def micros_to_timestamp_or_epoch(c: Column) -> Column:
    return F.timestamp_millis(_div(long_or_zero(c), 1000))


def _div(c: Column, n: int) -> Column:
    # Integer division; `/` would go through double and lose microseconds.
    return F.call_function("div", c, F.lit(n).cast("bigint"))


_DECODERS = {
    "long": long_or_zero,
    "long?": lambda c: c.try_cast("bigint"),
    "int": int_or_zero,
    "string": string_or_empty,
    "string?": lambda c: c.cast("string"),
    "decimal": decimal_or_zero,
    "ts": micros_to_timestamp_or_epoch,
    "ts?": micros_to_timestamp,
}


def decode_field(field: Field, record: str = "after") -> Column:
    return _DECODERS[field.kind](F.col(f"{record}.{field.name}")).alias(field.name)


def decode_columns(spec: TableSpec, record: str = "after") -> list[Column]:
    """Typed columns of one table out of the event's `record` struct."""
    return [decode_field(f, record) for f in spec.fields]


def encode_micros(c: Column) -> Column:
    """Inverse of the timestamp decoders, for building replay events."""
    return F.unix_micros(c)
