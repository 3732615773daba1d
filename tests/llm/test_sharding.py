"""Shards of near-equal bytes."""

import zlib
from collections import defaultdict

from corpus_helpers import DATA

from commerce_lake.llm import queries, sharding


def check(rows, texts, shards):
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sorted((r["size"], r["text_crc32"]) for r in rows) == sorted((len(t.encode()) + 16, zlib.crc32(t.encode())) for t in texts)
    mean, largest = sum(size.values()) / shards, max(r["size"] for r in rows)
    assert all(abs(size[k] - mean) <= largest for k in range(shards))


def test_hot_text_and_repeated_rows(spark):
    rows = [(k, "same" * 50) for k in range(2000)] + [(7, "same" * 50)] * 50 + [(None, None)] * 5 + [(k, f"text {k}") for k in range(500)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, shard int, size string")
    out = sharding.shard(df).collect()
    check(out, [t or "" for _, t in rows], 40)
    assert {r["law"] for r in out} == {"bytes"} and {r["grown_shard"] for r in out} == {None}


def test_overfull_ranges_are_divided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES_PER_RANGE", 1)
    records = spark.range(4000).selectExpr("id", "100L AS size", "0L AS crc", "id * 1000003 % 7919 AS hash")
    found = sharding.choose_splitters(records, 20, 400_000)
    sums = found.tag(records).groupBy("range").sum("size").collect()
    assert max(r[1] for r in sums) <= 2 * 400_000 / 20


def test_edge_cases(docs, no_docs, tmp_path, spark):
    check(sharding.shard(docs, 3).collect(), [r.text or "" for r in docs.collect()], 3)
    assert sharding.shard(no_docs).count() == 0
    sharding.write_shards(docs, str(tmp_path / "shards"), 3)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == docs.count()


def test_query(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    check(queries.op4_sampled_splitters(spark, str(DATA)).collect(), texts, 40)
