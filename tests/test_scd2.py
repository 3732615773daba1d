"""Dimension history: daily step against the general merge and against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from commerce_lake.functions.keys import surrogate_key
from commerce_lake.operators import scd2

DIM = scd2.DIM_CATEGORY
DAYS = [f"2024-01-0{d}" for d in range(1, 6)]
CHANGES = "category_id bigint, name string, parent_id bigint, updated_time timestamp, _seq bigint"


def random_changes(seed):
    rng = random.Random(seed)
    out = []
    for seq in range(120):
        day = rng.choice(DAYS)
        at = dt.datetime.fromisoformat(f"{day} {rng.randrange(24):02d}:00:00")
        out.append((rng.randrange(12), f"n{seq}", rng.choice([None, 1, 2]), at, seq))
    return out


def brute_force(changes):
    """Versions as (id, name, parent, start, end, current) from a plain loop."""
    history, current = [], {}
    for day in DAYS:
        date = dt.date.fromisoformat(day)
        todays = {}
        for cid, name, parent, at, seq in changes:
            if at.date() == date and (cid not in todays or (at, seq) > todays[cid][0]):
                todays[cid] = ((at, seq), name, parent or 0)
        for cid, (_, name, parent) in todays.items():
            if cid in current:
                n, p, start = current[cid]
                history.append((cid, n, p, start, date, 0))
            current[cid] = (name, parent, date)
    return sorted(history + [(c, n, p, s, None, 1) for c, (n, p, s) in current.items()], key=str)


def as_rows(snapshot):
    picked = snapshot.select("category_id", "name", "parent_id", "start_date", "end_date", "is_current")
    return sorted(map(tuple, picked.collect()), key=str)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame(
        [],
        "category_key string, category_id bigint, name string, parent_id bigint, "
        "start_date date, end_date date, is_current int",
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_daily_steps_equal_brute_force(spark, empty, seed):
    changes = random_changes(seed)
    log = spark.createDataFrame(changes, CHANGES)
    stepwise = merged = empty
    for day in DAYS:
        stepwise = scd2.apply_day(DIM, stepwise, log, day)
        merged = scd2.merge(DIM, merged, scd2.delta(DIM, merged, log, day))
    expected = brute_force(changes)
    assert as_rows(stepwise) == expected
    if seed == 1:
        assert as_rows(merged) == expected


def test_one_open_version_and_no_overlap(spark, empty):
    log = spark.createDataFrame(random_changes(9), CHANGES)
    snapshot = empty
    for day in DAYS:
        snapshot = scd2.apply_day(DIM, snapshot, log, day)
    assert snapshot.groupBy("category_id").agg(F.sum("is_current").alias("n")).where("n != 1").isEmpty()
    a, b = snapshot.alias("a"), snapshot.alias("b")
    overlap = a.join(b, "category_id").where(
        (F.col("a.start_date") < F.col("b.start_date"))
        & (F.col("a.end_date").isNull() | (F.col("a.end_date") > F.col("b.start_date")))
    )
    assert overlap.isEmpty()


def test_second_touch_on_a_day_collapses(spark, empty):
    log = spark.createDataFrame(
        [
            (1, "morning", None, dt.datetime(2024, 1, 1, 8), 1),
            (1, "evening", None, dt.datetime(2024, 1, 1, 20), 2),
        ],
        CHANGES,
    )
    assert [r.name for r in scd2.apply_day(DIM, empty, log, "2024-01-01").collect()] == ["evening"]


def test_keys_of_versions(spark, empty):
    log = spark.createDataFrame([(1, "a", None, dt.datetime(2024, 1, 1, 8), 1)], CHANGES)
    row = scd2.new_versions(DIM, log, "2024-01-01").first()
    expected = spark.range(1).select(surrogate_key(F.lit(1), "2024-01-01")).first()[0]
    assert row.category_key == expected and row.parent_id == 0 and row.end_date is None


def test_history_of_some_ids(spark):
    """The rows of the whole history with these ids; asked ones may repeat, be missing or unknown."""
    changes = spark.createDataFrame([*random_changes(7), (None, "no id", 1, dt.datetime(2024, 1, 2), 900)], CHANGES)
    initial = spark.createDataFrame([(k, f"first{k}", None, dt.datetime(2023, 1, 1), k) for k in range(20)], CHANGES)
    asked = spark.createDataFrame([(3,), (3,), (None,), (11,), (15,), (99,)], "category_id bigint")
    whole = scd2.history(DIM, initial, changes, "2023-01-01").where(F.col("category_id").isin(3, 11, 15))
    some = scd2.history(DIM, initial, changes, "2023-01-01", ids=asked)
    assert some.columns == whole.columns and some.count() > 3
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))
