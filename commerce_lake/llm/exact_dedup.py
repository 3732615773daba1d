"""Exact duplicates by sorting the contents.

Sampled splitters range-partition the normalised texts, each range is sorted by the
external sorter of the shuffle, and neighbours are compared in full. The range key ends with
the id, so a group of copies larger than a range spreads over several ranges; what the ranges
know of their first and last group is put together afterwards, at most two rows for a range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import fold_spaces, stored, text_or_empty

SPLITTER_CHARS = 64
_RUNS = "id long, first_id long, members long, leads boolean, range int, edge string, digest string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by text and id -> a row for each, with the group it has in this range.

    `edge` holds the text on one row of the first and of the last group, which may go on in
    another range. Of a group only ids are kept in memory.
    """
    part = TaskContext.get().partitionId()
    schema = pa.schema(
        [("id", pa.int64()), ("first_id", pa.int64()), ("members", pa.int64()), ("leads", pa.bool_()), ("range", pa.int32()), ("edge", pa.string()), ("digest", pa.string())]
    )
    text, digest, ids, opening = None, None, [], True
    out: list[tuple] = []

    def close(last: bool) -> None:
        nonlocal opening
        edge = text if opening or last else None
        for k, i in enumerate(ids):
            out.append((i, ids[0], len(ids), k == 0, part, edge if k == 0 else None, digest))
        opening = False

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        out.clear()
        return batch

    for batch in batches:
        for i, t, d in zip(*(batch.column(n).to_pylist() for n in ("id", "norm", "digest"))):
            if t != text:
                if text is not None:
                    close(False)
                text, digest, ids = t, d, []
            ids.append(i)
        while len(out) > 20_000:
            yield flush()
    if text is not None:
        close(True)
        yield flush()


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, keep_id, group_size, kept, text_sha256: a row for each row of `df`.

    A missing text counts as empty. White space runs count as one space. The row with the
    smallest id of equal texts is kept; ids that are missing come last, and of repeated rows with
    the same id one is kept. Other columns are ignored, whatever their names.
    """
    lean = df.select(F.col(id_col).cast("long").alias("id"), fold_spaces(text_or_empty(text_col)).alias("norm"))
    keyed = lean.select("id", "norm", F.sha2("norm", 256).alias("digest"), F.substring("norm", 1, SPLITTER_CHARS).alias("head"))
    # The splitters sampled by Spark are short; head and digest order the texts by their first
    # characters and then apart, the id splits large groups.
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_id = F.col("id").asc_nulls_last()
    ranged = keyed.repartitionByRange(ranges, "head", "digest", by_id).sortWithinPartitions("head", "digest", "norm", by_id)
    rows = stored(ranged.select("id", "norm", "digest").mapInArrow(_runs, _RUNS), "exact_dedup")
    edges = (
        rows.where(F.col("edge").isNotNull())
        .groupBy("edge")
        .agg(
            F.sum("members").alias("all_members"),
            F.min_by("first_id", F.struct("range")).alias("keep_id"),
            F.min("range").alias("keep_range"),
            F.count("*").alias("parts"),
            F.collect_list("range").alias("ranges"),
        )
        .where(F.col("parts") > 1)
        .select("keep_id", "all_members", "keep_range", F.explode("ranges").alias("range"), F.sha2("edge", 256).alias("digest"))
    )
    joined = rows.join(edges, ["range", "digest"], "left")
    across = F.col("all_members").isNotNull()
    return joined.select(
        F.col("id").alias(id_col),
        F.when(across, F.col("keep_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("all_members", "members").alias("group_size"),
        (F.col("leads") & (~across | (F.col("range") == F.col("keep_range")))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that `exact_duplicates` keeps, with all their columns."""
    keys = ["_key", "_no_key", "_sha"]

    def keyed(rows: DataFrame, sha) -> DataFrame:
        return rows.withColumns({"_key": F.coalesce(F.col(id_col), F.lit(-1)), "_no_key": F.col(id_col).isNull(), "_sha": sha})

    keep = keyed(exact_duplicates(df, id_col, text_col).where("kept"), F.col("text_sha256")).select(keys)
    mine = keyed(df, F.sha2(fold_spaces(text_or_empty(text_col)), 256))
    # Of rows repeated with the same id and text one stays: partitioned as the join already is.
    nth = F.row_number().over(Window.partitionBy(keys).orderBy(F.lit(1)))
    return mine.join(keep, keys, "left_semi").withColumn("_nth", nth).where("_nth = 1").drop(*keys, "_nth")
