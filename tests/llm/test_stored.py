"""What a task holds while a table is stored."""

import pyarrow as pa
from pyspark.sql import functions as F

from commerce_lake.llm import bpe
from commerce_lake.llm.common import BATCH_BYTES, BATCH_ROWS, READ_ROWS, stored


def test_batches_to_python_are_bounded(spark):
    """By rows, whatever the session's own setting, which comes back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = [r.n for r in stored(spark.range(3 * BATCH_ROWS, numPartitions=1).mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(found) == 3 * BATCH_ROWS and max(found) <= BATCH_ROWS and spark.conf.get(name) == before


def test_long_texts_are_bounded_in_bytes(spark, monkeypatch):
    """Batches to Python, and rows that a Parquet reader decodes at once; the settings come back."""
    names = ["spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before, during, row = [spark.conf.get(n) for n in names], [], 10_000
    texts = spark.range(1500, numPartitions=1).select(F.repeat(F.lit("x"), row).alias("text"))
    write = type(texts.write).parquet

    def seen(self, *args, **kwargs):
        during.append(int(spark.conf.get(names[1])))
        return write(self, *args, **kwargs)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    monkeypatch.setattr(type(texts.write), "parquet", seen)
    found = [r.n for r in stored(texts.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(found) == 1500 and max(found) * row <= BATCH_BYTES + 2 * row
    assert during == [READ_ROWS] and [spark.conf.get(n) for n in names] == before


def test_long_chunks_are_not_cached():
    voc = bpe.Vocabulary(bpe.public_vocabulary())
    long_ = "ab" * 500
    ids = voc.encode(f"word {long_} word {long_}")
    assert list(memoryview(ids).cast("I")) == voc.tokenizer.encode(f"word {long_} word {long_}", add_special_tokens=False).ids
    assert all(len(k) <= bpe.CACHED_BYTES for cache in (voc.words, voc.chunks) for k in [*cache, *cache.older])
