"""The segment source: where a start begins, and that nothing is lost or repeated after it."""

import json

import pytest

from commerce_lake.plans.daily import Lake
from commerce_lake.schemas import TABLES
from commerce_lake.sources import segments
from commerce_lake.sources.segments import append_segment, read_events, write_log
from commerce_lake.streaming import ingest
from commerce_lake.streaming.sinks import read_batches, write_batches
from test_streaming import event

SCHEMA = "partition int, _seq long, value string"


class Run:
    """Drains the log into a table; a run without `checkpoint` is a first start."""

    def __init__(self, spark, tmp_path):
        self.spark, self.log, self.base = spark, str(tmp_path / "log"), tmp_path

    def __call__(self, name, **options):
        stream = read_events(self.spark, self.log, **options)
        write_batches(stream, str(self.base / name), str(self.base / f"{name}_checkpoint"), once=True).awaitTermination()
        rows = read_batches(self.spark, str(self.base / name), stream.schema).collect()
        return sorted((r.partition, r["_seq"], r.value) for r in rows)


@pytest.fixture
def run(spark, tmp_path):
    return Run(spark, tmp_path)


def test_resume_loses_and_repeats_nothing(run):
    append_segment(run.log, 0, ["a", "b", "c"])
    append_segment(run.log, 1, ["x"])
    first = [(0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "x")]
    assert run("t", starting="earliest") == first
    assert run("t", starting="earliest") == first
    assert append_segment(run.log, 0, ["d", ""]) == 5
    append_segment(run.log, 2, ["new partition"])
    more = first + [(0, 3, "d"), (0, 4, ""), (2, 0, "new partition")]
    assert run("t", starting="earliest") == sorted(more)
    assert run("t", starting="latest") == sorted(more)  # the checkpoint decides, not the option


def test_first_starts(run):
    for k in range(3):
        append_segment(run.log, 0, [f"{k}{c}" for c in "abc"])
    append_segment(run.log, 1, ["x", "y"])
    assert run("late", starting="latest") == []
    assert run("given", starting=json.dumps({"0": 4})) == [(0, 4, "1b"), (0, 5, "1c"), (0, 6, "2a"), (0, 7, "2b"), (0, 8, "2c"), (1, 0, "x"), (1, 1, "y")]
    append_segment(run.log, 1, ["z"])
    assert run("late", starting="latest") == [(1, 2, "z")]


def test_a_group_goes_on_from_what_it_committed(run):
    append_segment(run.log, 0, ["a", "b"])
    assert run("one", group="g") == [(0, 0, "a"), (0, 1, "b")]
    append_segment(run.log, 0, ["c"])
    run("one", group="g")
    append_segment(run.log, 0, ["d"])
    run("one", group="g")
    # another query of the group, without the checkpoint: nothing is lost, and only uncommitted batches come again
    again = run("two", group="g")
    assert [r[1] for r in again] in ([], [3])
    assert [r[1] for r in run("three", group="other")] == [0, 1, 2, 3]


def test_deleted_segments_are_an_error_only_where_unread(run, tmp_path):
    append_segment(run.log, 0, ["a", "b"])
    assert len(run("t", starting="earliest")) == 2
    append_segment(run.log, 0, ["c"])
    next((tmp_path / "log" / "partition=0").glob("*0-*2.log")).unlink()
    assert len(run("t", starting="earliest")) == 3
    assert run("new", starting="earliest") == [(0, 2, "c")]
    with pytest.raises(Exception, match="OffsetsLost"):
        run("given", starting=json.dumps({"0": 1}))


def test_a_table_as_a_log(spark, run):
    rows = spark.range(1000).selectExpr("CASE WHEN id % 100 = 0 THEN NULL ELSE concat('m', id % 300) END AS value")
    assert write_log(rows, run.log, 3, segment_rows=50) == 1000
    got = run("t", starting="earliest")
    assert sorted(r[2] for r in got) == sorted(r.value or "" for r in rows.collect())
    offsets = {p: [o for q, o, _ in got if q == p] for p, _, _ in got}
    assert all(o == list(range(len(o))) for o in offsets.values())


def test_ingest_from_segments(spark, run, tmp_path):
    spec, lake = TABLES["order"], Lake(spark, str(tmp_path / "lake"))

    def load():
        ingest.append_bronze(read_events(spark, run.log, "earliest"), spec, lake, str(tmp_path / "ingest"), once=True).awaitTermination()

    append_segment(run.log, 0, [event(1, "created", "2024-01-01 10:00:00"), json.dumps({"before": {}, "after": None, "op": "d"})])
    load()
    append_segment(run.log, 0, [event(1, "completed", "2024-01-01 11:00:00"), ""])
    load()
    rows = lake.read_bronze(spec, "hot").orderBy("_seq").collect()
    assert [(r["_seq"], r.order_status) for r in rows] == [(0, "created"), (2, "completed")]


def test_a_partition_is_written_by_several_tasks_without_gaps(spark, tmp_path):
    """Task size is bounded whatever the number of partitions; offsets run on from task to task."""
    events = spark.range(1000).selectExpr("CAST(id % 700 AS STRING) AS value")
    folder = str(tmp_path / "log")
    assert segments.write_log(events, folder, partitions=2, segment_rows=40, task_rows=60) == 1000
    found = segments._segments(*segments._open(folder))
    assert sorted(found) == [0, 1]
    values = []
    for parts in found.values():
        assert parts[0].first == 0 and all(a.end == b.first for a, b in zip(parts, parts[1:]))
        assert any(s.end - s.first < 40 for s in parts[:-1])  # more than one task
        for s in parts:
            lines = open(s.path).read().split("\n")[:-1]
            assert len(lines) == s.end - s.first
            values += lines
    assert sorted(values) == sorted(str(k % 700) for k in range(1000))
