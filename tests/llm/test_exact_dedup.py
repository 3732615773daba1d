"""Exact duplicates against grouping in Python; the query has SQL."""

import re
from collections import defaultdict
from hashlib import sha256

import compare
from corpus_helpers import DATA

from commerce_lake.llm import exact_dedup, queries


def fold(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check(df):
    groups = defaultdict(list)
    for r in df.collect():
        groups[fold(r["text"])].append(r["doc_id"])
    last = lambda i: (i is None, i or 0)
    want = sorted(str((i, min(ids, key=last), len(ids), sha256(t.encode()).hexdigest())) for t, ids in groups.items() for i in ids)
    rows = exact_dedup.exact_duplicates(df).collect()
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in rows) == want
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_edge_cases(docs, no_docs):
    check(docs)
    check(no_docs)
    out = exact_dedup.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert out.count() == len({fold(r.text) for r in docs.collect()})


def test_groups_over_many_ranges(spark):
    rows = [(k, "hot  text") for k in range(3000)] + [(k, f"hot text {k % 7}") for k in range(3000, 3500)] + [(5000, "hot\ttext")] * 3
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))


def test_query(spark):
    con = compare.connect(str(DATA))
    assert compare.differences(queries.op8_exact_dedup(spark, str(DATA)), con, queries.oracle_sql()["op8_exact_dedup"]) == []
