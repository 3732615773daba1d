"""WARC bundles: format and round trip."""

import os
from collections import defaultdict
from hashlib import sha1

import zstandard
from corpus_helpers import DATA
from pyspark.sql import functions as F

from commerce_lake.llm import queries, warc


def test_frames_are_independent_and_the_whole_file_is_plain_zstd(tmp_path):
    writer = warc.BundleWriter(str(tmp_path), frame_bytes=2000, bundle_bytes=20_000)
    records = [warc.record_bytes(k, "u", os.urandom(700), "aa" * 20, None) for k in range(60)]
    places = [writer.add(r) for r in records]
    writer.close()
    assert len({p[0] for p in places}) > 1
    reader = warc.BundleReader()
    for record, (bundle, frame, offset, size) in reversed(list(zip(records, places))):
        assert reader.frame(bundle, frame)[offset : offset + size] == record
    fs, path = warc.file_system(places[0][0])
    with fs.open_input_file(path) as f:
        table = warc.read_seek_table(f)
        assert sum(packed for _, packed, _ in table) < f.size()
    with open(path, "rb") as f, zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) as plain:
        assert plain.read() == b"".join(r for r, p in zip(records, places) if p[0] == places[0][0])


def test_edge_cases(spark):
    big = "x" * 2000
    rows = [(1, "u", big), (2, "u", big), (2, "u", big), (None, None, None), (3, "", "y" * 10), (4, "a b", "y" * 10), (None, "z", big), (5, "é", "é" * 600), (6, None, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, bundle string, frame int")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in warc.round_trip(df).collect())
    assert got == sorted(
        [(1, 2000, "revisit", 2), (2, 2000, "response", 0), (2, 2000, "response", 0), (0, 0, "response", 0), (3, 10, "response", 0)]
        + [(4, 10, "response", 0), (0, 2000, "revisit", 2), (5, 1200, "response", 0), (6, 0, "response", 0)]
    )
    assert warc.round_trip(df.where("page_id > 100")).count() == 0


def test_query(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    groups = defaultdict(list)
    for p in pages:
        groups[(p.html or "").encode()].append(p.page_id)
    want = set()
    for payload, ids in groups.items():
        for i in ids:
            again = len(payload) >= 1000 and i != max(ids)
            want.add((i, len(payload), sha1(payload).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
    assert {tuple(r) for r in queries.op2_warc_bundles(spark, str(DATA)).collect()} == want


def test_frames_are_read_back_by_many_tasks(spark, tmp_path):
    """Tasks follow the bytes of the records, not those of the index; a frame stays in one task."""
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "concat(id, repeat(uuid(), 1000)) AS html")
    index = warc.write_bundles(pages.coalesce(1), str(tmp_path))
    out = warc.read_bundles(index, task_bytes=1 << 20)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert out.rdd.getNumPartitions() == index.agg({"bytes": "sum"}).first()[0] // (1 << 20) + 1 > 10
    tasks = out.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert sum(r["count"] for r in tasks) == 400 and len(tasks) > 1
