"""A change log in segment files as a streaming source with offsets of its own.

A log is a folder with a folder for each partition. A segment `<first>-<end>.log` there holds the
messages with offsets from `first` up to, but not including, `end`, one per line. Segments
appear as a whole and never change; old ones may be deleted. The names alone tell all offsets, so
planning a batch lists files and reads none, and a segment is a task.

The source resumes from the query's checkpoint. A first start is at `earliest`, `latest`, the
offsets that a `group` has committed (earliest where it has none), or offsets given as
JSON. A batch is committed for its group after it has been written, so a query without
the checkpoint repeats at most what was not yet committed and loses nothing.
"""

from __future__ import annotations

import io
import json
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from commerce_lake.schemas import SEQ

FORMAT = "change_log"
_SEGMENT = re.compile(r"(\d+)-(\d+)\.log")
_GROUPS = "_groups"
TASK_ROWS = 250_000


class OffsetsLost(RuntimeError):
    """Messages that have not been read are in no segment any more."""


@dataclass
class Segment(InputPartition):
    partition: int
    path: str
    first: int
    start: int
    end: int


def _open(path: str) -> tuple[files.FileSystem, str]:
    if "://" in path and not path.startswith("file:"):
        return files.FileSystem.from_uri(path)
    return files.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")


def segment_name(first: int, end: int) -> str:
    return f"{first:020d}-{end:020d}.log"


def append_segment(path: str, partition: int, messages: list[str]) -> int:
    """Add messages behind the last offset of a partition; returns the new end. One writer per partition."""
    if any("\n" in m for m in messages):
        raise ValueError("a message is one line")
    fs, root = _open(path)
    last = max((s.end for s in _segments(fs, root).get(partition, [])), default=0)
    _put(fs, root, partition, last, messages)
    return last + len(messages)


def _put(fs: files.FileSystem, root: str, partition: int, first: int, messages: list[str]) -> None:
    folder = posixpath.join(root, f"partition={partition}")
    fs.create_dir(folder)
    hidden = posixpath.join(folder, f".{uuid.uuid4().hex}")
    with fs.open_output_stream(hidden) as out:
        out.write("".join(f"{m}\n" for m in messages).encode())
    fs.move(hidden, posixpath.join(folder, segment_name(first, first + len(messages))))


def write_log(events: DataFrame, path: str, partitions: int, segment_rows: int = 10_000, task_rows: int = TASK_ROWS) -> int:
    """The `value` column of a table as a new log; returns the messages.

    Messages are dealt by their own hash to tasks of about `task_rows`, several for a partition of the
    log, and sorted, so a task that is repeated writes the same files again. They are counted by task
    first, which gives each task the offset it starts at.
    """
    values = events.select(F.coalesce("value", F.lit("")).alias("value"))
    tasks = partitions * max(1, -(-values.count() // (partitions * task_rows)))
    dealt = values.withColumn("task", F.pmod(F.xxhash64("value"), F.lit(tasks)).cast("int"))
    counts = dict(dealt.groupBy("task").count().collect()) if tasks > partitions else {}
    begin, ends = {}, [0] * partitions
    for task in range(tasks):
        begin[task] = ends[task % partitions]
        ends[task % partitions] += counts.get(task, 0)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(path)
        task, messages, waiting = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            waiting += batch.column(0).to_pylist()
            while len(waiting) >= segment_rows:
                _put(fs, root, task % partitions, begin[task] + messages, waiting[:segment_rows])
                messages, waiting = messages + segment_rows, waiting[segment_rows:]
        if waiting:
            _put(fs, root, task % partitions, begin[task] + messages, waiting)
        yield pa.RecordBatch.from_arrays([pa.array([messages + len(waiting)], pa.int64())], ["messages"])

    placed = dealt.repartitionById(tasks, "task").select("value").sortWithinPartitions("value")
    return placed.mapInArrow(write, "messages long").agg(F.sum("messages")).first()[0] or 0


def _segments(fs: files.FileSystem, root: str) -> dict[int, list[Segment]]:
    out: dict[int, list[Segment]] = {}
    for info in fs.get_file_info(files.FileSelector(root, allow_not_found=True, recursive=True)):
        folder, name = posixpath.split(info.path)
        match, place = _SEGMENT.fullmatch(name), posixpath.basename(folder)
        if match and place.startswith("partition="):
            first, end = map(int, match.groups())
            partition = int(place.removeprefix("partition="))
            out.setdefault(partition, []).append(Segment(partition, info.path, first, first, end))
    return {p: sorted(s, key=lambda s: s.first) for p, s in out.items()}


class ChangeLogReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, group: str | None):
        self.path, self.starting, self.group = path, starting, group

    def _list(self) -> dict[int, list[Segment]]:
        return _segments(*_open(self.path))

    def _group_file(self) -> tuple[files.FileSystem, str]:
        fs, root = _open(self.path)
        return fs, posixpath.join(root, _GROUPS, f"{self.group}.json")

    def _committed(self) -> dict:
        if self.group is None:
            return {}
        fs, path = self._group_file()
        if fs.get_file_info(path).type == files.FileType.NotFound:
            return {}
        with fs.open_input_stream(path) as found:
            return json.loads(found.read())

    def initialOffset(self) -> dict:
        """Of each partition; those that are not named, or come later, start at their first segment."""
        there = self._list()
        first = {str(p): s[0].first for p, s in there.items()}
        if self.starting == "earliest":
            return first
        if self.starting == "latest":
            return {str(p): s[-1].end for p, s in there.items()}
        given = self._committed() if self.starting == "committed" else json.loads(self.starting)
        return {**first, **{p: int(o) for p, o in given.items()}}

    def latestOffset(self) -> dict:
        return {str(p): s[-1].end for p, s in self._list().items()}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        out, there = [], self._list()
        for p, stop in end.items():
            segments = there.get(int(p), [])
            at = start.get(p, segments[0].first if segments else 0)
            for s in segments:
                low, high = max(at, s.first), min(stop, s.end)
                if low < high:
                    if low > at:
                        raise OffsetsLost(f"partition {p}: offsets {at} to {low}")
                    out.append(Segment(s.partition, s.path, s.first, low, high))
                    at = high
            if at < stop:
                raise OffsetsLost(f"partition {p}: offsets {at} to {stop}")
        return out

    def read(self, partition: Segment) -> Iterator[tuple]:
        fs = _open(self.path)[0]
        with fs.open_input_file(partition.path) as segment:
            for k, line in enumerate(io.BufferedReader(segment)):
                offset = partition.first + k
                if offset >= partition.end:
                    break
                if offset >= partition.start:
                    yield partition.partition, offset, line.decode().removesuffix("\n")

    def commit(self, end: dict) -> None:
        if self.group is None:
            return
        fs, path = self._group_file()
        fs.create_dir(posixpath.dirname(path))
        hidden = f"{path}.{uuid.uuid4().hex}"
        with fs.open_output_stream(hidden) as out:
            out.write(json.dumps(end).encode())
        fs.move(hidden, path)


class ChangeLog(DataSource):
    """`spark.readStream.format("change_log")` with the options path, startingOffsets and group."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"partition int, {SEQ} long, value string"

    def streamReader(self, schema) -> ChangeLogReader:
        group = self.options.get("group")
        return ChangeLogReader(self.options["path"], self.options.get("startingOffsets", "committed" if group else "earliest"), group)


def read_events(spark: SparkSession, path: str, starting: str = "committed", group: str | None = None) -> DataFrame:
    """The messages of a log with their offsets, in the shape that `ingest.append_bronze` takes."""
    spark.dataSource.register(ChangeLog)
    reader = spark.readStream.format(FORMAT).option("path", path).option("startingOffsets", starting)
    if group is not None:
        reader = reader.option("group", group)
    return reader.load()
