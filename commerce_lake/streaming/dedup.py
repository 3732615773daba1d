"""Duplicate and version handling on change streams.

Three guarantees, from cheap to strict:

* `drop_redeliveries` removes exact repeats that arrive close together;
* `sinks.write_batches(each=latest_by_key)` keeps the newest version per batch,
  `sinks.read_newest` the newest of all;
* `newest_by_state` remembers the newest version of each key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commerce_lake.schemas import SEQ


def drop_redeliveries(stream: DataFrame, keys: Sequence[str], delay: str = "10 minutes") -> DataFrame:
    """Drop rows repeated within `delay`; the first arrival stays, whatever its version.

    Every row more than `delay` behind the newest is dropped as late, a repeat or not: use it only
    where rows later than that may be lost.

    `keys` should identify one version of one row, such as id and update time.
    """
    return stream.withWatermark("updated_at", delay).dropDuplicatesWithinWatermark(list(keys))


def newest_by_state(stream: DataFrame, key: str, version: str = "updated_at") -> DataFrame:
    """Newest version of each key seen so far, sent again whenever the key occurs.

    A streaming aggregate in update mode: an older version that arrives late
    repeats the newer one. State holds one row per key for good.
    """
    first = [version, SEQ] if SEQ in stream.columns else [version]
    rest = [c for c in stream.columns if c != key and c not in first]
    newest = F.max(F.struct(*first, *rest)).alias("newest")
    return stream.groupBy(key).agg(newest).select(key, "newest.*").select(*stream.columns)
