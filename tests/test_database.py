"""The transactional sink on a database file: failed tasks and repeated batches leave one copy."""

import shutil
import sqlite3

import pytest
from pyspark.sql import functions as F

from commerce_lake.sources.database import Database, Staged, Target, TransactionalWriter, write_transactional


@pytest.fixture
def target(tmp_path):
    path = str(tmp_path / "shop.db")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE sales (id BIGINT, "order" TEXT, amount DOUBLE)')
    return Target(Database("sqlite3", {"database": path, "timeout": 60}), "sales", "orders")


def read(target, table="sales", columns='id, "order", amount'):
    with sqlite3.connect(target.database.arguments["database"]) as db:
        return sorted(db.execute(f"SELECT {columns} FROM {table}").fetchall(), key=str)


def files(spark, tmp_path, ids):
    rows = spark.createDataFrame([(i, f"o{i}", i / 2) for i in ids], "id long, order string, amount double")
    rows.repartition(3).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), [(i, f"o{i}", i / 2) for i in ids]


def drain(stream, target, checkpoint):
    write_transactional(stream, target, str(checkpoint), once=True).awaitTermination()


def test_batches_arrive_once_and_repeated_ones_change_nothing(spark, tmp_path, target):
    stream, first = files(spark, tmp_path, range(2500))
    drain(stream, target, tmp_path / "cp")
    assert read(target) == sorted(first, key=str)
    stream, more = files(spark, tmp_path, range(2500, 2600))
    drain(stream.select("amount", "order", "id"), target, tmp_path / "cp")
    assert read(target) == sorted(first + more, key=str)
    # the crash between the commit in the database and that in the checkpoint
    shutil.copytree(tmp_path / "cp", tmp_path / "cp2", ignore=lambda folder, names: [n for n in names if folder.endswith("commits") and n in ("1", ".1.crc")])
    drain(stream, target, tmp_path / "cp2")
    assert read(target) == sorted(first + more, key=str)
    assert read(target, "sales_staging", "*") == []
    assert read(target, "sales_batches", "*") == [("orders", 0), ("orders", 1)]


def test_failed_task_leaves_nothing(spark, tmp_path, target):
    stream, rows = files(spark, tmp_path, range(300))
    bad = stream.withColumn("amount", F.when(F.col("id") == 250, F.raise_error("bad row").cast("double")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="bad row"):
        drain(bad, target, tmp_path / "cp")
    assert read(target) == []
    drain(stream, target, tmp_path / "cp")
    assert read(target) == sorted(rows, key=str)
    assert read(target, "sales_staging", "*") == []


def test_attempts_that_no_commit_names(target):
    target.prepare()
    writer = TransactionalWriter(target, ["id", "order", "amount"])
    lost, kept = writer.write(iter([(1, "a", 0.5)])), writer.write(iter([(1, "a", 0.5)]))
    assert writer.write(iter([])) == Staged(None, 0)
    writer.commit([kept, None, Staged(None, 0)], 0)
    assert read(target) == [(1, "a", 0.5)]
    writer.commit([lost], 0)  # the batch again, by other tasks
    assert read(target) == [(1, "a", 0.5)] and read(target, "sales_staging", "*") == []
    gone = writer.write(iter([(2, "b", None)]))
    writer.abort([gone, None], 1)
    with pytest.raises(RuntimeError, match="missing"):
        writer.commit([gone], 1)
    assert read(target, "sales_batches", "*") == [("orders", 0)]
    other = TransactionalWriter(Target(target.database, "sales", "refunds"), ["id"])
    other.commit([other.write(iter([(3,)]))], 0)
    assert read(target) == [(1, "a", 0.5), (3, None, None)]


def test_names_are_checked(target):
    with pytest.raises(ValueError):
        Target(target.database, "sales; DROP TABLE sales", "x")
