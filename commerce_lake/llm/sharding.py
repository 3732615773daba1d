"""Shards of near-equal bytes by sampled splitters.

Records are ordered by a hash of their text and their id, which keeps equal texts together and
still lets a large group of them be split. A size-weighted sample of the keys gives the quantiles
that range-partition the records; ranges that turn out overfull are sampled again and divided.
The exact bytes of the ranges then place every record on the line from 0 to the total, and the
shard is the part of the line its middle falls into.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import stored, text_or_empty

SHARDS = 40
OVERHEAD = 16
SAMPLES_PER_RANGE = 64
OVERFULL = 2.0
ROUNDS = 8
_UNIT = 1 << 53


class Splitters:
    """Sorted boundary keys (hash, id); a key belongs to the range of the boundaries up to it."""

    def __init__(self, keys: list[tuple[int, int]]):
        self.keys = sorted(set(keys))
        self.hashes = np.array([h for h, _ in self.keys], np.int64)
        self.ids = np.array([i for _, i in self.keys], np.int64)

    def range_of(self, hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        first = np.searchsorted(self.hashes, hashes, "left")
        past = np.searchsorted(self.hashes, hashes, "right")
        tied = np.flatnonzero(past > first)
        for start in np.unique(first[tied]):
            rows = tied[first[tied] == start]
            stop = past[rows[0]]
            first[rows] = start + np.searchsorted(self.ids[start:stop], ids[rows], "right")
        return first

    def tag(self, records: DataFrame) -> DataFrame:
        """`records` (id, size, crc, hash) with the range of each."""

        def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("id").fill_null(-1).to_numpy(zero_copy_only=False)
                ranges = self.range_of(batch.column("hash").to_numpy(zero_copy_only=False), ids)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ranges)], [*batch.schema.names, "range"])

        return records.select("id", "size", "crc", "hash").mapInArrow(tagged, "id long, size long, crc long, hash long, range long")


def _quantiles(sample: list, parts: int) -> list[tuple[int, int]]:
    """Keys that divide the weights of (hash, id, weight) rows in equal parts."""
    sample = sorted((r["hash"], r["id"], r["weight"]) for r in sample)
    if not sample or parts < 2:
        return []
    upto = np.cumsum([w for _, _, w in sample])
    cuts = np.searchsorted(upto, upto[-1] * np.arange(1, parts) / parts)
    return [sample[k][:2] for k in cuts]


def _draw(records: DataFrame, per_byte: float) -> list:
    """A record stands in the sample with a chance of size x per_byte, and for that many bytes."""
    chance = F.col("size") * per_byte
    unit = F.pmod(F.xxhash64("hash", "id"), F.lit(_UNIT)) / F.lit(float(_UNIT))
    weight = F.greatest(F.col("size").cast("double"), F.lit(1.0 / per_byte))
    return records.where(unit < chance).select("hash", F.coalesce("id", F.lit(-1)).alias("id"), weight.alias("weight")).collect()


def choose_splitters(records: DataFrame, ranges: int, total: int) -> Splitters:
    """Boundaries of about `ranges` ranges, none far over its share of the bytes.

    The driver gets about SAMPLES_PER_RANGE keys for each range, and a sum for each range. A range
    whose records all have one key stays as it is.
    """
    share = max(total / ranges, 1.0)
    found = Splitters(_quantiles(_draw(records, SAMPLES_PER_RANGE / share), ranges))
    for _ in range(ROUNDS):
        tagged = found.tag(records)
        sums = tagged.groupBy("range").agg(F.sum("size").alias("bytes"), (F.max(F.struct("hash", "id")) > F.min(F.struct("hash", "id"))).alias("divisible"))
        over = {r["range"]: r["bytes"] for r in sums.where((F.col("bytes") > OVERFULL * share) & F.col("divisible")).collect()}
        if not over:
            break
        again = tagged.where(F.col("range").isin(list(over)))
        sample = _draw(again, 4 * SAMPLES_PER_RANGE / share)
        at = found.range_of(np.array([r["hash"] for r in sample], np.int64), np.array([r["id"] for r in sample], np.int64))
        more = []
        for k, size in over.items():
            more += _quantiles([r for r, a in zip(sample, at) if a == k], int(-(-size // share)))
        wider = Splitters(found.keys + more)
        if len(wider.keys) == len(found.keys):
            break
        found = wider
    return found


def shard(df: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard for each row of `df`.

    The law is `bytes`: bytes of any two shards differ by no more than the largest records. Sizes
    are UTF-8 bytes of the text, none if it is missing, plus 16. Slots count from 0 in the order
    of hash and id. Repeated rows are records of their own.
    """
    text = text_or_empty(text_col)
    hash_ = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    records = stored(
        df.select(
            F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("crc"), hash_.alias("hash")
        ),
        "shard_records",
    )
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"]
    ranges = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    tagged = choose_splitters(records, ranges, total).tag(records)
    # sums of whole ranges, one row for each range
    sums = tagged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    line = Window.orderBy("range")
    before = sums.select(
        "range", (F.sum("bytes").over(line) - F.col("bytes")).alias("bytes_before"), (F.sum("rows").over(line) - F.col("rows")).alias("rows_before")
    )
    inside = Window.partitionBy("range").orderBy("hash", "id", "crc", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = tagged.withColumns({"upto": F.sum("size").over(inside), "nth": F.count("*").over(inside)}).join(before, "range")
    numbered = placed.select(
        "id",
        "size",
        "crc",
        F.expr(f"least({shards - 1}, cast(bytes_before * 2 + upto * 2 - size as decimal(38, 0)) * {shards} div {max(2 * total, 1)})").cast("int").alias("shard"),
        (F.col("rows_before") + F.col("nth") - 1).alias("row"),
    )
    numbered = stored(numbered, "shard_rows")
    first = numbered.groupBy("shard").agg(F.min("row").alias("first"))
    return numbered.join(F.broadcast(first), "shard").select(  # a row for each shard
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """`df` as Parquet below `path`, a folder for each shard; rows are placed as `shard` says."""
    text = text_or_empty(text_col)
    placed = shard(df, shards, id_col, text_col).select(F.col(id_col).alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot")
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(1)))
    left = df.withColumns({"_id": F.col(id_col).cast("long"), "_crc": F.crc32(text)}).withColumn("_nth", nth("_id", "_crc"))
    right = placed.withColumn("_nth", nth("_id", "_crc"))
    joined = left.join(right, left["_id"].eqNullSafe(right["_id"]) & (left["_crc"] == right["_crc"]) & (left["_nth"] == right["_nth"]))
    joined.select(*(left[c] for c in df.columns if c not in ("shard", "slot")), right["shard"], right["slot"]).write.partitionBy("shard").parquet(path)
