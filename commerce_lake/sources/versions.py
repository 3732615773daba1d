"""Messages that name the schema they were written with.

A framed value is a zero byte, the number of the writer's schema in four bytes, and the body. Each
message is read by its own writer's schema and then resolved to the table's: fields by name or by
a former name, types by cast; a field that the writer did not have is missing and decodes to its default.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.schemas import TableSpec
from commerce_lake.sources.cdc import envelope_schema

# Fixed value: registry framing in front of the body (zero byte, schema number).
HEADER_BYTES = 5
_BAD = "_malformed"


def frame(body: Column, number: Column | int) -> Column:
    """A framed value; a missing body, a tombstone, stays missing."""
    number = F.lit(number) if isinstance(number, int) else number
    head = F.unhex(F.lpad(F.hex(number.cast("bigint")), 10, "0"))
    return F.concat(head, body.cast("binary"))


def schema_number(value: Column) -> Column:
    """The writer's schema of a framed value; missing where the frame is broken."""
    head = F.hex(F.substring(value, 1, HEADER_BYTES))
    framed = (F.length(head) == 2 * HEADER_BYTES) & head.startswith("00")
    return F.when(framed, F.conv(F.substring(head, 3, 8), 16, 10).cast("bigint"))


def body(value: Column) -> Column:
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.greatest(F.octet_length(value) - HEADER_BYTES, F.lit(0)))


def resolve(record: Column, written: T.StructType, spec: TableSpec, former: Mapping[str, str]) -> Column:
    """A writer's record as the record of the table. `former` maps a field to its name in that writer."""
    target = envelope_schema(spec)["after"].dataType
    names = set(written.names)

    def field(f: T.StructField) -> Column:
        name = former.get(f.name, f.name)
        value = record[name] if name in names else F.lit(None)
        return value.cast(f.dataType).alias(f.name)

    return F.when(record.isNotNull(), F.struct(*map(field, target.fields)))


def _raise(message: Column, kind: T.DataType) -> Column:
    return F.raise_error(message).cast(kind)


def json_reader(spec: TableSpec, written: T.StructType, former: Mapping[str, str] | None = None) -> Callable[[Column], Column]:
    """Reads JSON bodies of one writer; a body that is no such event raises."""
    schema = T.StructType([T.StructField("after", written), T.StructField(_BAD, T.StringType())])
    target = envelope_schema(spec)["after"].dataType

    def read(value: Column) -> Column:
        text = body(value).cast("string")
        event = F.from_json(text, schema, {"columnNameOfCorruptRecord": _BAD})
        shown = F.concat(F.lit(f"malformed {spec.name} event: "), F.substring(text, 1, 200))

        def judged(e: Column) -> Column:
            bad = e[_BAD].isNotNull() & e["after"].isNull() & (F.trim(text) != "")
            return F.when(bad, _raise(shown, target)).otherwise(resolve(e["after"], written, spec, former or {}))

        # bound to a name by the transform, so that a body is parsed once
        return F.get(F.transform(F.array(event), judged), F.lit(0))

    return read


def avro_reader(spec: TableSpec, schema_json: str, written: T.StructType, former: Mapping[str, str] | None = None) -> Callable[[Column], Column]:
    """Reads Avro bodies of one writer; needs the spark-avro package."""
    from pyspark.sql.avro.functions import from_avro

    return lambda value: resolve(from_avro(body(value), schema_json)["after"], written, spec, former or {})


def parse_versions(events: DataFrame, spec: TableSpec, readers: Mapping[int, Callable[[Column], Column]]) -> DataFrame:
    """Framed `value` to an `after` struct, each by the reader of its schema number; other columns pass through.

    One map stage: a message meets only its own reader. A missing value is a tombstone and has no
    `after`; a broken frame, or a number without a reader, raises and names the number.
    """
    value = F.col("value").cast("binary")
    number = schema_number(value)
    target = envelope_schema(spec)["after"].dataType
    after = F.when(F.col("value").isNull(), F.lit(None).cast(target))
    for known, read in sorted(readers.items()):
        after = after.when(number == known, read(value))
    unknown = F.concat(F.lit(f"{spec.name}: no reader for schema "), F.coalesce(number.cast("string"), F.lit("of a broken frame")))
    return events.withColumn("after", after.otherwise(_raise(unknown, target))).drop("value")
