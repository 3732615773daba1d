"""Streams: restart, repeated batches, version handling, alerts over several batches."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from commerce_lake.operators.dedup import latest_by_key
from commerce_lake.plans.daily import Lake
from commerce_lake.schemas import TABLES
from commerce_lake.session import rocksdb_state
from commerce_lake.streaming import alerts, dedup, ingest
from commerce_lake.streaming.sinks import read_batches, read_newest, write_batches

SPEC = TABLES["order"]


def micros(text):
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=dt.UTC).timestamp() * 1_000_000)


def event(order_id, status, updated, created="2024-01-01 10:00:00"):
    after = {
        "order_id": order_id, "user_id": 1, "order_status": status, "total_amount": "5.00",
        "created_at": micros(created), "updated_at": micros(updated),
    }
    return json.dumps({"before": None, "after": after, "op": "c", "ts_ms": 0})


def deliver(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("\n".join(lines) + "\n")
    (folder / f".{name}").rename(folder / name)


def drain(query):
    query.awaitTermination()


def test_ingest_restart_loses_and_repeats_nothing(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    inbox, checkpoint = tmp_path / "inbox", str(tmp_path / "checkpoint")

    def run():
        drain(ingest.append_bronze(ingest.replay_events(spark, str(inbox), 1), SPEC, lake, checkpoint, once=True))

    deliver(inbox, "a.json", [event(1, "created", "2024-01-01 10:00:00"), json.dumps({"before": {}, "after": None, "op": "d"})])
    run()
    deliver(inbox, "b.json", [event(1, "completed", "2024-01-02 10:00:00"), event(2, "created", "2024-01-02 11:00:00")])
    run()
    run()
    got = lake.read_bronze(SPEC, "hot").orderBy("order_id", "updated_at").select("order_id", "order_status", "updated_date")
    assert [(r[0], r[1], str(r[2])) for r in got.collect()] == [
        (1, "created", "2024-01-01"), (1, "completed", "2024-01-02"), (2, "created", "2024-01-02"),
    ]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    """The same batch id written again (a retry) leaves one copy."""
    source = tmp_path / "in"
    spark.range(10).write.parquet(str(source))
    for attempt in ("first", "again"):
        stream = spark.readStream.schema("id bigint").parquet(str(source))
        drain(write_batches(stream, str(tmp_path / "out"), str(tmp_path / attempt), once=True))
    assert read_batches(spark, str(tmp_path / "out"), stream.schema).count() == 10


def versions(spark, folder, name, rows):
    df = spark.createDataFrame(
        [(k, dt.datetime.fromisoformat(u), v) for k, u, v in rows], "id bigint, updated_at timestamp, v string"
    )
    df.coalesce(1).write.mode("append").parquet(str(folder / name))


BATCHES = [
    [(1, "2024-01-01 10:00:00", "a1"), (2, "2024-01-01 10:00:00", "b1"), (1, "2024-01-01 10:05:00", "a2")],
    [(1, "2024-01-01 10:01:00", "a-late"), (2, "2024-01-01 10:06:00", "b2")],
    [(3, "2024-01-01 10:07:00", "c1"), (2, "2024-01-01 10:06:00", "b2")],
]


@pytest.fixture
def stages(spark, tmp_path):
    """Runs a stream over three deliveries, one run each, on one checkpoint."""

    def run(build, mode, each=None):
        for i, rows in enumerate(BATCHES):
            versions(spark, tmp_path / "in", f"part{i}", rows)
            stream = spark.readStream.schema("id bigint, updated_at timestamp, v string").parquet(str(tmp_path / "in" / "part[0-9]"))
            with rocksdb_state(spark):
                out = build(stream)
                drain(write_batches(out, str(tmp_path / "out"), str(tmp_path / "cp"), each=each, output_mode=mode, once=True))
        return str(tmp_path / "out"), out.schema

    return run


NEWEST = [(1, "a2"), (2, "b2"), (3, "c1")]


def test_newest_by_state(spark, stages):
    path, schema = stages(lambda s: dedup.newest_by_state(s, "id"), "update")
    got = read_newest(spark, path, schema, "id").orderBy("id").select("id", "v")
    assert list(map(tuple, got.collect())) == NEWEST


def test_newest_per_batch(spark, stages):
    path, schema = stages(lambda s: s, "append", each=lambda b: latest_by_key(b, "id"))
    assert read_batches(spark, path, schema).count() == 2 + 2 + 2
    got = read_newest(spark, path, schema, "id", ["updated_at"]).orderBy("id").select("id", "v")
    assert list(map(tuple, got.collect())) == NEWEST


def test_drop_redeliveries(spark, stages):
    path, schema = stages(lambda s: dedup.drop_redeliveries(s, ["id", "updated_at"]), "append")
    assert sorted(r.v for r in read_batches(spark, path, schema).collect()) == ["a-late", "a1", "a2", "b1", "b2", "c1"]


def write_events(spark, path, rows, schema):
    parsed = [tuple(dt.datetime.fromisoformat(v) if isinstance(v, str) and v[:2] == "20" else v for v in r) for r in rows]
    spark.createDataFrame(parsed, schema).coalesce(1).write.parquet(str(path))


def test_failed_payments_over_batches(spark, tmp_path):
    schema = "payment_id bigint, order_id bigint, status string, payment_date timestamp"
    inbox = tmp_path / "in"
    write_events(spark, inbox / "p0", [(1, 1, "failed", "2024-01-01 10:00:30"), (2, 1, "failed", "2024-01-01 10:01:00"), (3, 8, "failed", "2024-01-01 10:01:00")], schema)
    write_events(spark, inbox / "p1", [(4, 2, "failed", "2024-01-01 10:04:59"), (5, 1, "completed", "2024-01-01 10:02:00"), (6, 1, "failed", "2024-01-01 10:05:00")], schema)
    owners = spark.createDataFrame([(1, 7), (2, 7)], "order_id bigint, user_id bigint")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).schema(schema).parquet(str(inbox / "p[0-9]"))
    out = alerts.abnormal_payment(alerts.with_owner(stream, owners))
    drain(write_batches(out, str(tmp_path / "out"), str(tmp_path / "cp"), output_mode="update", once=True))
    got = read_newest(spark, str(tmp_path / "out"), out.schema, ["user_id", "window_start"]).collect()
    assert [(r.user_id, r.failed_count, r.window_end.minute) for r in got] == [(7, 3, 5)]


def test_no_alert_gives_an_empty_table(spark, tmp_path):
    schema = "user_id bigint, created_at timestamp, order_value decimal(18,2)"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "in"))
    out = alerts.abnormal_order(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    drain(write_batches(out, str(tmp_path / "out"), str(tmp_path / "cp"), output_mode="update", once=True))
    assert read_batches(spark, str(tmp_path / "out"), out.schema).isEmpty()


def test_stuck_orders(spark, tmp_path):
    schema = "order_id bigint, order_status string, created_at timestamp, updated_at timestamp"
    rows = [
        (1, "created", "2024-01-01 10:59:00", "2024-01-01 10:59:00"),
        (1, "completed", "2024-01-01 10:59:00", "2024-01-01 11:59:00"),
        (2, "created", "2024-01-01 10:01:00", "2024-01-01 10:01:00"),
        (3, "created", "2024-01-01 10:01:00", "2024-01-01 10:01:00"),
        (3, "cancelled", "2024-01-01 10:01:00", "2024-01-01 12:00:00"),
        (4, "created", "2024-01-01 15:00:00", "2024-01-01 15:00:00"),
        (4, "completed", "2024-01-01 15:00:00", "2024-01-01 15:10:00"),
    ]
    write_events(spark, tmp_path / "in" / "p0", rows, schema)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "p[0-9]"))
    out = alerts.stuck_order(
        stream.where(F.col("order_status") == "created"), stream.where(F.col("order_status") == "completed").unionByName(
            stream.where(F.col("order_status") == "cancelled"))
    )
    drain(write_batches(out, str(tmp_path / "out"), str(tmp_path / "cp"), once=True))
    got = read_batches(spark, str(tmp_path / "out"), out.schema).orderBy("order_id").collect()
    assert [(r.order_id, r.alert_time.hour) for r in got] == [(2, 12), (3, 12)]
