"""Table scans, catalog listing and table writes."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date
from commerce_lake.schemas import DAY
from commerce_lake.settings import Settings


def scan_day(table: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows of one day of a day-partitioned table; only that partition is listed and read."""
    return table.where(F.col(DAY) == as_date(day))


def schema_listing(df: DataFrame) -> list[tuple[str, str]]:
    """(name, type) of each column."""
    return df.dtypes


def run_script(spark: SparkSession, sql: str, day: dt.date | str) -> DataFrame:
    """Run a SQL text with the named parameter `:execution_date` bound, never spliced in."""
    return spark.sql(sql, args={"execution_date": str(day)})


def overwrite_partitions(df: DataFrame, path: str, column: str | list[str], sort: list[str] | None = None) -> None:
    """Replace exactly the partitions that occur in `df`.

    Rerunning after a failure is safe, and an empty `df` changes nothing. Rows
    are sorted inside each file so that min/max statistics can skip row groups.
    """
    columns = [column] if isinstance(column, str) else column
    if sort:
        df = df.sortWithinPartitions(*columns, *sort)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def append(df: DataFrame, path: str, *columns: str) -> None:
    df.write.mode("append").partitionBy(*columns).parquet(path)


def write_jdbc(df: DataFrame, table: str, settings: Settings, batch_size: int = 1000) -> None:
    """Append to a database table, by column name, in statement batches."""
    (
        df.write.format("jdbc")
        .mode("append")
        .option("url", settings.database_url)
        .option("dbtable", table)
        .option("user", settings.database_user)
        .option("password", settings.database_password)
        .option("batchsize", batch_size)
        .save()
    )


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is absent."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears as a whole; False if the name is taken, which then stays as it is."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    fs = target.getFileSystem(conf)
    hidden = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    plain = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(hidden), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        fs.delete(hidden, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def drop_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    """Delete one partition folder; no-op if it is absent."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
