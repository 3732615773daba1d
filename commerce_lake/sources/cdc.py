"""Change-event envelopes: build, parse, flatten.

An event is `{before, after, op, ts_ms}`; only `after` is used. A delete has no
`after`, and the tombstone that may follow it has no value at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.functions.decode import decode_columns, encode_micros
from commerce_lake.schemas import DAY, SEQ, TableSpec

# Wire types of JSON events. Decimals travel as text so that a malformed one
# raises in the decoder instead of turning into NULL in the parser.
_WIRE = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "decimal": T.StringType(),
    "ts": T.LongType(),
}


_BAD = "_malformed"


def envelope_schema(spec: TableSpec) -> T.StructType:
    """The part of an event that is read; the parser skips the rest."""
    record = T.StructType([T.StructField(f.name, _WIRE[f.base]) for f in spec.fields])
    return T.StructType([T.StructField("after", record)])


def _wire_value(df: DataFrame, name: str, base: str) -> Column:
    c = F.col(name)
    if base == "ts":
        return encode_micros(c).alias(name)
    return c.cast(_WIRE[base]).alias(name)


def to_json_events(rows: DataFrame, spec: TableSpec, deleted: Column | None = None) -> DataFrame:
    """Replay rows as JSON events; rows flagged `deleted` become delete events."""
    record = F.struct(*[_wire_value(rows, f.name, f.base) for f in spec.fields])
    gone = F.lit(False) if deleted is None else deleted
    event = F.struct(
        F.when(gone, record).alias("before"),
        F.when(~gone, record).alias("after"),
        F.when(gone, F.lit("d")).otherwise(F.lit("c")).alias("op"),
        F.unix_millis(F.col("updated_at")).alias("ts_ms"),
    )
    return rows.select(*_seq(rows), F.to_json(event).alias("value"))


def _parsed(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Events with their parsed form as `_event`; its `_bad` holds a text that is no such event.

    The struct leaves through a one-element explode. A filter on it cannot move
    below that, where it would parse every event a second time.
    """
    schema = envelope_schema(spec).add(_BAD, T.StringType())
    event = F.from_json(F.col("value").cast("string"), schema, {"columnNameOfCorruptRecord": _BAD})
    return events.withColumn("_event", F.explode(F.array(event)))


def _is_bad() -> Column:
    """A value that is there and is no event. An empty one is a tombstone; a single field of a
    wrong type leaves the rest of `after` and counts as missing."""
    event = F.col("_event")
    return event[_BAD].isNotNull() & event["after"].isNull() & (F.trim(F.col("value").cast("string")) != "")


def parse_json_events(events: DataFrame, spec: TableSpec, bad: str = "raise") -> DataFrame:
    """`value` text to an `after` struct; other columns pass through.

    A value that cannot be parsed raises. With `bad="skip"` it is left out here, for callers that
    keep such events by `rejected_events`.
    """
    parsed = _parsed(events, spec)
    after = F.col("_event.after")
    if bad == "skip":
        parsed = parsed.where(~F.coalesce(_is_bad(), F.lit(False)))
    else:
        message = F.concat(F.lit(f"malformed {spec.name} event: "), F.substring(F.col("value").cast("string"), 1, 200))
        after = F.when(_is_bad(), F.raise_error(message).cast(envelope_schema(spec)["after"].dataType)).otherwise(after)
    return parsed.withColumn("after", after).drop("value", "_event")


def rejected_events(events: DataFrame, spec: TableSpec) -> DataFrame:
    """The events whose value cannot be parsed, as they came."""
    return _parsed(events, spec).where(_is_bad()).drop("_event")


def drop_deletes(events: DataFrame) -> DataFrame:
    """Remove deletes and tombstones: both have an empty `after` once malformed events are out."""
    return events.where(F.col("after").isNotNull())


def flatten(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed rows out of events that carry an `after` struct (JSON or Avro)."""
    return drop_deletes(events).select(*decode_columns(spec), *_seq(events))


def to_bronze(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Decoded rows by name in the stored types; optional strings become ''."""
    columns = []
    for field in spec.bronze_schema().fields:
        c = F.col(field.name).cast(field.dataType)
        if isinstance(field.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        columns.append(c.alias(field.name))
    return rows.select(*columns, *_seq(rows))


def json_to_bronze(events: DataFrame, spec: TableSpec, bad: str = "raise") -> DataFrame:
    """JSON `value` column to bronze rows. No shuffle: one map stage."""
    return to_bronze(flatten(parse_json_events(events, spec, bad), spec), spec)


def with_day(bronze: DataFrame) -> DataFrame:
    """Add the day partition column."""
    return bronze.withColumn(DAY, F.to_date("updated_at"))


def _seq(df: DataFrame) -> list[Column]:
    return [F.col(SEQ)] if SEQ in df.columns else []
