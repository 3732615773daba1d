"""Batch-idempotent sinks.

Every micro-batch writes its own `batch_id` partitions with dynamic overwrite. A
batch that is repeated after a lost executor or a restart replaces what it wrote
before, so the table holds each batch exactly once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.schemas import BATCH
from commerce_lake.settings import Settings
from commerce_lake.sources.tables import exists, write_jdbc

# Fixed value: seconds between micro-batches of a continuous run.
TRIGGER_SECONDS = 10


def write_batches(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition: Sequence[str] = (),
    each: Callable[[DataFrame], DataFrame] | None = None,
    output_mode: str = "append",
    once: bool = False,
) -> StreamingQuery:
    """Start writing a stream to a Parquet table. `once` drains the source and stops."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = each(batch) if each else batch
        (
            rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition, BATCH)
            .parquet(path)
        )

    return _start(stream, checkpoint, output_mode, once, write)


def write_database(
    stream: DataFrame, table: str, settings: Settings, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append a stream to a database table: at least once, like any plain insert."""
    return _start(stream, checkpoint, "append", once, lambda batch, _: write_jdbc(batch, table, settings))


def write_console(stream: DataFrame, output_mode: str = "append") -> StreamingQuery:
    """Print a stream, for debugging."""
    return stream.writeStream.format("console").outputMode(output_mode).start()


def _start(stream, checkpoint, output_mode, once, write) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).outputMode(output_mode)
    writer = writer.option("checkpointLocation", checkpoint)
    timing = {"availableNow": True} if once else {"processingTime": f"{TRIGGER_SECONDS} seconds"}
    return writer.trigger(**timing).start()


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of a table written by a stream; empty if the stream has written nothing yet."""
    full = StructType(schema.fields + [StructField(BATCH, LongType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(path)


def read_newest(
    spark: SparkSession, path: str, schema: StructType, keys: str | Sequence[str], version: Sequence[str] = ()
) -> DataFrame:
    """Current rows of a table that a stream writes changed rows to; the later batch wins."""
    return latest_by_key(read_batches(spark, path, schema), keys, [*version, BATCH]).drop(BATCH)
