"""Kafka change-event source with Avro values.

Needs the spark-sql-kafka and spark-avro packages on the cluster. The rows it
returns have the shape `cdc.flatten` expects, the same as the file replay used
where those packages are absent.
"""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commerce_lake.schemas import SEQ, TableSpec
from commerce_lake.settings import Settings
from commerce_lake.sources import versions

# Messages a micro-batch takes at most, so that a first start does not take the whole backlog at once.
MAX_OFFSETS = 5_000_000
REGISTRY_SECONDS = 30


def read_events(
    spark: SparkSession, topic: str, settings: Settings, starting_offsets: str = "earliest"
) -> DataFrame:
    """Raw topic. Offsets resume from the query's checkpoint; the first start is `earliest`."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.kafka)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("maxOffsetsPerTrigger", MAX_OFFSETS)
        .load()
    )


def _registry(settings: Settings, path: str):
    with urllib.request.urlopen(f"{settings.schema_registry}/{path}", timeout=REGISTRY_SECONDS) as reply:
        return json.load(reply)


def registry_schemas(settings: Settings, topic: str) -> dict[int, str]:
    """Value schemas of a topic by their number in the registry (a small request for each version)."""
    subject = f"subjects/{urllib.parse.quote(f'{topic}-value')}/versions"
    found = [_registry(settings, f"{subject}/{v}") for v in _registry(settings, subject)]
    return {f["id"]: f["schema"] for f in found}


def decode_avro(events: DataFrame, spec: TableSpec, schemas: Mapping[int, str]) -> DataFrame:
    """Avro body to an `after` struct, each message by the schema that it names; tombstones are dropped.

    A number that was registered after the start stops the query by name; the next start knows it.
    """
    readers = {n: versions.avro_reader(spec, text, _record(events.sparkSession, text)) for n, text in schemas.items()}
    framed = events.where(F.col("value").isNotNull()).select("value", F.col("offset").alias(SEQ))
    return versions.parse_versions(framed, spec, readers)


def _record(spark: SparkSession, schema_json: str) -> T.StructType:
    """The type of `after` in an Avro schema, as Spark reads it."""
    text = spark._jvm.org.apache.spark.sql.avro.SchemaConverters.toSqlType(
        spark._jvm.org.apache.avro.Schema.Parser().parse(schema_json)
    ).dataType()
    return T.StructType.fromJson(json.loads(text.json()))["after"].dataType


def table_events(spark: SparkSession, spec: TableSpec, settings: Settings) -> DataFrame:
    topic = spec.topic()
    return decode_avro(read_events(spark, topic, settings), spec, registry_schemas(settings, topic))
