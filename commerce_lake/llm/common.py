"""Shared by the operators: stored intermediate tables and fixed values of the contracts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.session import work_dir

# The white space of the contracts, for Java, DuckDB and Python patterns.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

SLICE_ROWS = 512
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
# What the JVM and Python hold of whole texts at once while a table is stored.
BATCH_ROWS = 2048
BATCH_BYTES = 4 << 20
READ_ROWS = 512


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` written as Parquet to the cluster's shared folder and read again.

    Cuts the lineage: what is read back does not depend on any executor. Shuffle files of the
    write are given up at its end, as the table replaces them. Batches to Python have at most
    BATCH_ROWS rows and end with the row that passes BATCH_BYTES; Parquet is read READ_ROWS rows at a time.
    """
    spark: SparkSession = df.sparkSession
    path = work_dir(spark, purpose)
    rows, read = int(spark.conf.get(_BATCH_ROWS)), int(spark.conf.get(_READ_ROWS))
    during = {_CLEANUP: "true", _BATCH_ROWS: str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)}
    during |= {_BATCH_BYTES: str(BATCH_BYTES), _READ_ROWS: str(min(read, READ_ROWS))}
    before = {_CLEANUP: spark.conf.get(_CLEANUP, "false"), _BATCH_ROWS: str(rows)}
    before |= {_BATCH_BYTES: spark.conf.get(_BATCH_BYTES), _READ_ROWS: str(read)}
    for name, value in during.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, which bounds what Python holds at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def fold_spaces(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACES, " ")
