"""Newest version per key."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.functions.time import as_date, on_day
from commerce_lake.schemas import DAY, SEQ

_RANK = "_rank"


def latest_by_key(df: DataFrame, keys: str | Sequence[str], version: str | Sequence[str] = "updated_at") -> DataFrame:
    """The row with the highest `version` of every key.

    Ties go to the higher ingest position and then to the remaining columns, so
    the result does not depend on input order. Select the needed columns before
    the call: all columns take part in the sort.

    The rank filter lets Spark keep one row per key and task *before* the
    shuffle, so a key with very many versions costs each task one row.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    versions = [version] if isinstance(version, str) else list(version)
    first = versions + ([SEQ] if SEQ in df.columns else [])
    rest = [c for c in df.columns if c not in keys and c not in first]
    order = [F.col(c).desc() for c in first + rest]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_where(
    df: DataFrame, keys: str | Sequence[str], predicate: Column, version: str | Sequence[str] = "updated_at"
) -> DataFrame:
    """Keys whose newest version satisfies `predicate`, with that version.

    Same as filtering `latest_by_key`. Only keys that satisfy it in some version can do so in
    their newest, so these are found first, and only their versions are ranked and shuffled.
    """
    return _latest_of(df, keys, df.where(predicate), version).where(predicate)


def latest_among(
    df: DataFrame, keys: str | Sequence[str], others: DataFrame, on: str, version: str | Sequence[str] = "updated_at"
) -> DataFrame:
    """Newest versions of the keys that refer to `others` by the column `on`, in that version.

    Exact as `latest_where` is: keys that refer to them in some version are ranked.
    """
    others = others.select(on).distinct()
    newest = _latest_of(df, keys, df.join(others, on, "left_semi"), version)
    return newest.join(others, on, "left_semi")


def _latest_of(df: DataFrame, keys: str | Sequence[str], candidates: DataFrame, version: str | Sequence[str]) -> DataFrame:
    names = [keys] if isinstance(keys, str) else list(keys)
    return latest_by_key(df.join(candidates.select(*names).distinct(), names, "left_semi"), keys, version)


def latest_updated_on(
    df: DataFrame,
    keys: str | Sequence[str],
    day: Column | dt.date | str,
    version: str = "updated_at",
) -> DataFrame:
    """Keys whose newest version was written on `day`, with that version.

    Same as filtering `latest_by_key` to the day. Older days cannot hold the
    newest version of such a key, and later days must stay visible because they
    outrank it; so the lower bound alone may move below the ranking, where it
    reaches the scan (and prunes day partitions if the table has them).
    """
    start = as_date(day)
    since = df.where(F.col(version) >= start.cast("timestamp"))
    if DAY in df.columns:
        since = since.where(F.col(DAY) >= start).drop(DAY)
    return latest_by_key(since, keys, version).where(on_day(F.col(version), day))
