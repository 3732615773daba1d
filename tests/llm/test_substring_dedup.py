"""Removed bytes against a set of all strings."""

import random
from hashlib import sha256

import numpy as np
import pytest
from corpus_helpers import DATA

from commerce_lake.llm import queries, substring_dedup

LENGTH = substring_dedup.LENGTH


def brute(texts):
    """texts: in order -> (bytes, removed, spans, digest of the rest) of each."""
    seen, out = set(), []
    for text in texts:
        gone = bytearray(len(text))
        for p in range(len(text) - LENGTH + 1):
            string = text[p : p + LENGTH]
            if string in seen:
                gone[p : p + LENGTH] = b"\1" * LENGTH
            seen.add(string)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(text), sum(gone), spans, sha256(bytes(b for b, g in zip(text, gone) if not g)).hexdigest()))
    return out


def digest(row):
    spans = [(s["start"], s["end"]) for s in row["spans"]]
    return row["n_bytes"], sum(b - a for a, b in spans), len(spans), sha256(row["kept"]).hexdigest()


def made(seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcé \n") for _ in range(rng.randrange(90, 400))) for _ in range(20)]
    noise = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(150)))
    rows = [(k, "".join(rng.choice(passages) if rng.random() < 0.5 else noise() for _ in range(rng.randrange(6)))) for k in range(200)]
    return rows + [(1000, "a" * 1000), (1001, "ab" * 700), (1002, None), (1003, ""), (1004, "a" * 99), (1005, "xyz" * 200 + "a" * 300), (1006, passages[0] * 5)]


@pytest.mark.parametrize("hot", [3, 4096])
def test_random_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", hot)
    rows = made(hot)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, tie int, start string").repartition(5)
    got = {r["doc_id"]: digest(r) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == dict(zip((i for i, _ in rows), brute([(t or "").encode() for _, t in rows])))


def test_edge_cases(docs, no_docs):
    rows = substring_dedup.remove_repeats(docs).collect()
    last = lambda i: (i is None, i or 0)
    order = sorted(((r.doc_id, (r.text or "").encode()) for r in docs.collect()), key=lambda r: (*last(r[0]), sha256(r[1]).hexdigest()))
    want = [(i, *d) for (i, _), d in zip(order, brute([t for _, t in order]))]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], *digest(r))) for r in rows)
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_no_batch_of_texts_after_the_last_table(spark):
    """What is left is cut out by row: the session's batches to Python, of any size, hold no text."""
    last = substring_dedup.remove_repeats(spark.createDataFrame(made(5), "doc_id long, text string"))
    assert "MapInArrow" not in last._jdf.queryExecution().executedPlan().toString()


def test_few_files_for_what_few_texts_share(spark, monkeypatch):
    """Many tasks look at the segments of texts that share next to nothing; the table is one small file."""
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    conf |= {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    before, files, store = {n: spark.conf.get(n) for n in conf}, {}, substring_dedup.stored

    def kept(df, purpose):
        table = store(df, purpose)
        files[purpose] = len(table.inputFiles())
        return table

    monkeypatch.setattr(substring_dedup, "stored", kept)
    rng = np.random.default_rng(9)
    rows = [(k, rng.integers(97, 123, 2000).astype(np.uint8).tobytes().decode()) for k in range(300)]
    rows.append((300, rows[0][1][500:700]))
    try:
        for n, v in conf.items():
            spark.conf.set(n, v)
        spans = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).where("size(spans) > 0").collect()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert [(r["doc_id"], digest(r)[:3]) for r in spans] == [(300, (200, 200, 1))]
    assert files["segments"] == 1


def test_every_byte_is_kept(spark):
    """Control characters and characters that a span cuts in two, before, between and behind the spans."""
    shared = "é" * 49 + "日" + "x" * 60
    odd = "".join(map(chr, range(256))) + "日本👍🏽\x00\x85"
    rows = [(1, shared + odd), (2, odd + "日" * 40 + shared + odd[::-1] + shared[1:]), (3, "è" + shared[1:] + "ç"), (4, odd)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: digest(r) for r in substring_dedup.remove_repeats(df).collect()}
    assert got == dict(zip((i for i, _ in rows), brute([t.encode() for _, t in rows])))


def test_index_of_a_block():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 100, 3000).astype(np.uint8).tobytes() * 2
    data = np.frombuffer(data + b"\xfe", np.uint8)
    index = substring_dedup.RunIndex(data, 50)
    assert index.lengths.sum() == len(data) and len(index.heads) < 0.7 * len(data)
    text = data.tobytes()
    order = sorted(range(len(text)), key=lambda k: text[k:])
    match, agree = index.matches(np.arange(len(text)))
    for before, k in zip(order, order[1:]):
        common = 0
        while common < 50 and text[before + common : before + common + 1] == text[k + common : k + common + 1] != b"":
            common += 1
        assert match[k] == before and min(agree[k], 50) == common


def test_query(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()
    want = dict(zip((r.doc_id for r in rows), brute([(r.text or "").encode() for r in rows])))
    got = queries.op10_suffix_repeats(spark, str(DATA)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_crowded_anchor_is_held_to_the_bound():
    """One anchor with 100,000 different segments, each there twice, between two others."""
    import pyarrow as pa

    n, hot = 100_000, 50
    content = np.repeat(np.arange(n), 2)
    key = np.full(2 * n, 7)
    columns = [np.concatenate([[3, 3], key, [9]]), np.concatenate([[1, 2], content, [5]])]
    size = len(columns[0])
    columns += [np.arange(size), np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, 4)]
    rows = pa.table(dict(zip(substring_dedup._SEG_NAMES, (c.astype(np.int64) for c in columns))))
    out = [b for b in substring_dedup._compared(hot)(iter(rows.to_batches(max_chunksize=997)))]
    assert max(b.num_rows for b in out) <= 997 + hot
    found = pa.Table.from_batches(out)
    kind, ids, members, count = (found.column(c).to_numpy() for c in ("kind", "id", "members", "count"))
    assert sorted(ids[kind == 0]) == list(range(3, 2 * n + 2, 2)) and (count[kind == 0] == 4 + LENGTH - 1).all()
    assert sorted(ids[kind == 1]) == [0, 1, *range(2, 2 * n + 2, 2)] and (count[kind == 1] == 4).all()
    assert (members[(kind == 1) & (ids > 1)] > hot).all() and (members[(kind == 1) & (ids < 2)] == 2).all()
