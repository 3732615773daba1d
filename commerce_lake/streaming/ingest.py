"""Change events to the hot bronze log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from commerce_lake.plans.daily import Lake
from commerce_lake.schemas import DAY, TABLES, TableSpec
from commerce_lake.settings import Settings
from commerce_lake.sources import cdc, kafka
from commerce_lake.streaming.sinks import write_batches


def replay_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON events, one per line, from files as they arrive in a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder)


def append_bronze(
    events: DataFrame, spec: TableSpec, lake: Lake, checkpoint: str, once: bool = False, bad: str = "raise"
) -> StreamingQuery:
    """Decode events and append every row version; there is no watermark and no shuffle.

    A malformed JSON event stops the query, unless `bad="skip"`: run `append_rejects` beside it then.

    Stopping the query and starting it again on the same checkpoint continues
    after the last finished batch.
    """
    rows = cdc.flatten(events, spec) if "after" in events.columns else cdc.flatten(
        cdc.parse_json_events(events, spec, bad), spec
    )
    bronze = cdc.with_day(cdc.to_bronze(rows, spec))
    return write_batches(bronze, lake.path(spec.bronze_hot), checkpoint, partition=[DAY], once=once)


def append_rejects(
    events: DataFrame, spec: TableSpec, lake: Lake, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Append the JSON events that cannot be parsed, as they came, to a table of their own."""
    return write_batches(cdc.rejected_events(events, spec), lake.path(f"rejects_{spec.name}"), checkpoint, once=once)


def run_ingest(spark: SparkSession, lake: Lake, settings: Settings, checkpoint_root: str) -> list[StreamingQuery]:
    """One query per shop table on its topic, all in one session."""
    return [
        append_bronze(kafka.table_events(spark, spec, settings), spec, lake, f"{checkpoint_root}/{spec.name}")
        for spec in TABLES.values()
    ]
