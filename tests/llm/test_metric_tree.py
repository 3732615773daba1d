"""The M-tree search against every inner product."""

import math
from collections import Counter

import compare
import numpy as np
import pyarrow as pa
import pytest
from corpus_helpers import DATA

from commerce_lake.llm import metric_tree, queries

SCHEMA = "vec_id long, embedding array<float>, rank int, x string, id long, score double"


def frame(spark, rows):
    rows = [(k, v and [None if c is None else float(c) for c in v], 1, "x", -1, 0.5) for k, v in rows]
    return spark.createDataFrame(rows, SCHEMA)


def reference(rows, k=10, step=100):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in good), default=0)
    x = [[math.floor(1024 * float(np.float32(c))) for c in v] + [0] * (dims - len(v)) for _, v in good]
    out = Counter()
    for a, (i, _) in enumerate(good):
        if i is None or i % step:
            continue
        scores = [(-sum(p * q for p, q in zip(x[a], x[b])), j is None, j or 0) for b, (j, _) in enumerate(good) if b != a]
        for rank, (score, none, j) in enumerate(sorted(scores)[:k], 1):
            out[i, rank, None if none else j, -score] += 1
    return out


def check(df, rows):
    assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()) == reference(rows)


def test_edge_cases(spark):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=6).round(3).tolist()) for k in range(300)]
    rows += [(100, rows[100][1]), (100, rows[3][1]), (200, rows[200][1])]  # repeated rows and ids
    rows += [(None, rows[0][1]), (None, None), (400, None), (500, [None] * 6), (600, [float("nan")] * 6), (700, [float("inf")] + [0.0] * 5)]
    rows += [(800, []), (900, [0.5, 0.25]), (-100, [0.0] * 6)]
    check(metric_tree.nearest(frame(spark, rows)), rows)


def test_few_rows(spark):
    for rows in ([], [(0, None)], [(0, [1.0])], [(0, []), (100, [])], [(None, [1.0, 2.0])], [(0, [1.0, -1.0]), (100, [1.0, -1.0]), (7, [2.0, 0.0])]):
        check(metric_tree.nearest(frame(spark, rows)), rows)


def test_ties_and_a_vector_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [1.0, 1.0, 0.0] if k % 3 == 0 else rng.integers(-2, 3, 3).tolist()) for k in rng.permutation(1500).tolist()]
    check(metric_tree.nearest(frame(spark, rows)), rows)


@pytest.mark.parametrize("size", [(40, 8, 4), (4, 4, 2)])
def test_many_pages_subtrees_and_blocks(spark, monkeypatch, size):
    """Clustered vectors of very different norms, with sizes that force several of everything."""
    for name, value in zip(("SUBTREE_ROWS", "PAGE_ROWS", "FANOUT"), size):
        monkeypatch.setattr(metric_tree, name, value)
    monkeypatch.setattr(metric_tree, "QUERY_BLOCK", 3)
    monkeypatch.setattr(metric_tree, "ROUTE_ROWS", 200)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 5)) * 10
    rows = [(k, (centres[k % 6] * (1 + k % 4) + rng.normal(size=5)).round(2).tolist()) for k in range(900)]
    check(metric_tree.nearest(frame(spark, rows)), rows)


def test_scores_beyond_64_bits_raise(spark):
    rows = [(0, [3e7, 1.0]), (1, [1.0, 2e7]), (2, [5.0, 4.0])]
    with pytest.raises(Exception, match="64 bits|overflow"):
        metric_tree.nearest(frame(spark, [(0, [4e9]), (1, [4e9])])).collect()
    check(metric_tree.nearest(frame(spark, rows[1:])), rows[1:])


def test_bounds_avoid_comparisons():
    """In clustered vectors a search compares a small part, and finds what a full scan finds."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(50, 16)) * 1000
    x = (centres[rng.integers(0, 50, 8000)] + rng.normal(size=(8000, 16)) * 20).astype(np.int64)
    square = float((x * x).sum(axis=1).max())
    rows = metric_tree.grow(0, x, [[k] for k in range(len(x))], metric_tree.lifted(x[:1], square)[0], square)
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), metric_tree._PAGE_TYPES)], metric_tree._PAGE_NAMES)
    tree = metric_tree.Subtree(table, 16, square)
    for k in range(0, 8000, 400):
        want = sorted(((-int(s), i) for i, s in enumerate(x @ x[k])))[:10]
        assert tree.search(x[k], 10, None) == [(-s, i) for s, i in want]
    assert tree.compared < 0.25 * 20 * len(x)


def test_query(spark):
    df = queries.op11_m_tree_top_k(spark, str(DATA))
    assert compare.differences(df, compare.connect(str(DATA)), queries.NEAREST_SQL) == []
