"""Facts and marts that change as a whole: runs write aside, a manifest says what counts.

A run writes its days into folders of its own, `<table>/run=<id>/date_key=<day>`, where no reader
looks. The manifest names the run that holds each day of each table. Committing adds the next
version of the manifest under a name that must not exist yet: readers see the old days or
all new ones, and of two runs from one version the second fails. The ledger notes each finished
step of a day's run with its result, so that a run that was cut off goes on where it stopped.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame

from commerce_lake.sources import tables

MANIFESTS = "_manifest"
RUNS = "_runs"
_FINISHED = "finished"

#: table -> day -> the run that holds it, or None where the day has no rows.
Days = dict[str, dict[str, str | None]]


class ConcurrentRun(RuntimeError):
    """Another run has committed since this one began."""


def _versions(lake) -> list[str]:
    return sorted(n for n in tables.list_names(lake.spark, lake.path(MANIFESTS)) if n.endswith(".json") and not n.startswith("."))


def current(lake) -> tuple[int, Days]:
    """Number and content of the newest manifest; 0 and nothing before the first."""
    names = _versions(lake)
    if not names:
        return 0, {}
    return int(names[-1].removesuffix(".json")), json.loads(tables.read_text(lake.spark, f"{lake.path(MANIFESTS)}/{names[-1]}"))


def read(lake, table: str, schema: str, days: dict[str, str | None]) -> DataFrame:
    """The rows of the given days, each from the run that holds it; nothing else is listed."""
    paths = [f"{lake.path(table)}/run={run}/date_key={day}" for day, run in sorted(days.items()) if run is not None]
    empty = lake.spark.createDataFrame([], schema)
    if not paths:
        return empty
    return lake.spark.read.schema(empty.schema).option("basePath", lake.path(table)).parquet(*paths).select(empty.columns)


class Publication:
    """What one run has written, on top of the manifest it began with."""

    def __init__(self, lake, run: str | None = None, base: int | None = None, staged: Days | None = None):
        self.lake, self.run = lake, run or uuid.uuid4().hex
        number, self.published = current(lake)
        self.base = number if base is None else base
        self.staged: Days = staged or {}

    def write(self, table: str, rows: DataFrame, days: Iterable[dt.date | str], sort: list[str]) -> None:
        """The rows of `days`, which are all that `rows` holds. A day without rows will have none."""
        path, wanted = f"{self.lake.path(table)}/run={self.run}", [str(d) for d in days]
        for day in wanted:  # of an earlier try of the same run
            tables.drop_partition(self.lake.spark, path, "date_key", day)
        tables.overwrite_partitions(rows, path, "date_key", sort)
        there = set(tables.list_names(self.lake.spark, path))
        self.staged.setdefault(table, {}).update({d: self.run if f"date_key={d}" in there else None for d in wanted})

    def days(self, table: str) -> dict[str, str | None]:
        return {**self.published.get(table, {}), **self.staged.get(table, {})}

    def commit(self) -> None:
        merged = {t: self.days(t) for t in sorted({*self.published, *self.staged})}
        name = f"{self.lake.path(MANIFESTS)}/{self.base + 1:012d}.json"
        if current(self.lake)[0] != self.base or not tables.create_text(self.lake.spark, name, json.dumps(merged)):
            raise ConcurrentRun(f"manifest {self.base + 1} is taken")


def vacuum(lake, keep: int = 2) -> int:
    """Delete days of runs that none of the newest `keep` manifests names; returns how many. No run may be under way."""
    held: set[tuple[str, str, str]] = set()
    names = _versions(lake)[-keep:]
    known: set[str] = set()
    for name in names:
        for table, days in json.loads(tables.read_text(lake.spark, f"{lake.path(MANIFESTS)}/{name}")).items():
            known.add(table)
            held |= {(table, run, day) for day, run in days.items() if run is not None}
    gone = 0
    for table in known:
        for run in tables.list_names(lake.spark, lake.path(table)):
            for part in tables.list_names(lake.spark, f"{lake.path(table)}/{run}"):
                if part.startswith("date_key=") and (table, run.removeprefix("run="), part.removeprefix("date_key=")) not in held:
                    tables.drop_partition(lake.spark, f"{lake.path(table)}/{run}", "date_key", part.removeprefix("date_key="))
                    gone += 1
    return gone


class Ledger:
    """The finished steps of one run of a day. Opening continues a run that was cut off."""

    def __init__(self, lake, day: dt.date | str):
        self.lake, root = lake, lake.path(f"{RUNS}/{day}")
        unfinished = [r for r in sorted(tables.list_names(lake.spark, root)) if f"{_FINISHED}.json" not in tables.list_names(lake.spark, f"{root}/{r}")]
        self.resumed = bool(unfinished)
        self.run = unfinished[-1] if unfinished else uuid.uuid4().hex
        self.folder = f"{root}/{self.run}"
        names = tables.list_names(lake.spark, self.folder) if unfinished else []
        self.results = {n.removesuffix(".json"): json.loads(tables.read_text(lake.spark, f"{self.folder}/{n}")) for n in names if n.endswith(".json") and not n.startswith(".")}

    def step(self, name: str, work: Callable[[], Any]) -> Any:
        """The result of a step: noted if it has been done, else by doing it. Results are JSON values."""
        if name not in self.results:
            result = json.loads(json.dumps(work(), default=str))
            tables.create_text(self.lake.spark, f"{self.folder}/{name}.json", json.dumps(result))
            self.results[name] = result
        return self.results[name]

    def finish(self, how: str = "done") -> None:
        self.step(_FINISHED, lambda: how)
