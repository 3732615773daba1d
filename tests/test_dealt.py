"""Tables replayed as micro-batches of several files."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from commerce_lake.catalog import streams
from commerce_lake.streaming.sinks import read_batches, write_batches


@pytest.mark.parametrize("way", ["time", "keys"])
def test_a_micro_batch_has_several_files_and_the_same_rows(spark, tmp_path, way):
    at = F.timestamp_seconds(F.col("id") * 60)
    table = spark.range(0, 4000, 1, 2).select("id", at.alias("updated_at"))
    fx = SimpleNamespace(spark=spark)
    stream = streams._in_time(fx, table, file_rows=300) if way == "time" else streams._dealt(fx, table, ["id"], "dealt", file_rows=300)
    write_batches(stream, str(tmp_path / "table"), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    out = read_batches(spark, str(tmp_path / "table"), table.schema)
    assert sorted(r.id for r in out.collect()) == list(range(4000))
    spans = out.groupBy("batch_id").agg(F.min("id"), F.max("id"), F.count("*")).orderBy("batch_id").collect()
    assert len(spans) == 4
    if way == "time":
        assert [tuple(r)[1:4] for r in spans] == [(k * 1000, k * 1000 + 999, 1000) for k in range(4)]
