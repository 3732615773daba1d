"""Whitening against an eigendecomposition of the exact integer rows."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest
from corpus_helpers import DATA

from commerce_lake.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, component string, n int, x string, id long"


def frame(spark, vectors):
    return spark.createDataFrame([(k, v and [None if c is None else float(c) for c in v], "c", 1, "x", -k) for k, v in vectors], SCHEMA)


def reference(vectors):
    """vec_id -> (deviation, whitened by component), and the explained shares."""
    good = [(k, v) for k, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in good), default=0)
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (dims - len(v)) for _, v in good], np.int64)
    n, sums = len(x), x.sum(axis=0)
    y = (n * x - sums) / n
    e, v = np.linalg.eigh(y.T @ y / n)
    order = [j for j in np.argsort(-e) if e[j] > 1e-9 * e.max()][:32]
    z = y @ v[:, order] / np.sqrt(e[order])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [(k, int(d), row) for (k, _), d, row in zip(good, deviation, z)], e[order] / e.sum(), e[order]


def check(df, vectors):
    want, shares, e = reference(vectors)
    rows = df.collect()
    got = {}
    for r in rows:
        got.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    assert len(rows) == len(want) * len(shares)
    assert {(k, d) for k, d, _ in want} == set(got)
    mine = np.array([[got[k, d][c + 1].whitened for c in range(len(shares))] for k, d, _ in want])
    theirs = np.array([z for _, _, z in want])
    apart = np.abs(np.diff(e)) > 1e-6 * e[0]
    clear = [j for j in range(len(e)) if (j == 0 or apart[j - 1]) and (j == len(e) - 1 or apart[j])]
    for j in clear:
        sign = np.sign(mine[:, j] @ theirs[:, j])
        assert np.allclose(sign * mine[:, j], theirs[:, j], atol=1e-6), j
    assert np.allclose([rows and got[want[0][0], want[0][1]][c + 1].explained for c in range(len(shares))], shares, rtol=1e-6)
    assert all(r.identity_error <= 1e-8 and r.n == len(want) for r in rows)
    assert np.allclose(mine.T @ mine / len(want), np.eye(len(shares)), atol=1e-8)


def test_edge_cases(spark):
    rng = np.random.default_rng(2)
    vectors = [(k, [float(c) for c in rng.normal(size=5) * (3, 1, 0.5, 2, 4)]) for k in range(40)]
    vectors += [(7, vectors[7][1]), (50, None), (51, [1.0, None, 0, 0, 0]), (52, [float("nan")] * 5), (53, [float("inf"), 0, 0, 0, 0]), (54, [2.0, 1.0])]
    check(whitening.whiten(frame(spark, vectors)), vectors)


@pytest.mark.parametrize("scale", [1, 10_000])
def test_dependent_and_constant_dimensions(spark, scale):
    """Directions without spread have no component, also beside dimensions of much larger spread."""
    rng = np.random.default_rng(3)
    base = rng.integers(-50, 50, (60, 3)) * (scale, 1, 1)
    rows = [(k, [float(v) for v in (a, b, a + b, 3, c, c)]) for k, (a, b, c) in enumerate(base.tolist())]
    df = whitening.whiten(frame(spark, rows))
    assert {r.component for r in df.collect()} == {1, 2, 3}
    check(df, rows)


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    assert whitening.whiten(frame(spark, [(1, []), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_badly_conditioned_rows_need_the_shift_and_further_passes(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=(150, 4)) * (1e4, 1e3, 10, 1)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(np.round(y @ np.linalg.qr(rng.normal(size=(4, 4)))[0], 1).tolist())]
    check(whitening.whiten(frame(spark, rows)), rows)


def test_deviation_beyond_64_bits_raises(spark):
    for big in (3e10, 3e17):
        with pytest.raises(Exception, match="64 bits|long overflow"):
            whitening.whiten(frame(spark, [(1, [big]), (2, [-big])])).collect()


def test_query(spark):
    table = pq.read_table(f"{DATA}/embeddings.parquet")
    vectors = list(zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist()))
    check(queries.op13_embedding_whitening(spark, str(DATA)), vectors)
