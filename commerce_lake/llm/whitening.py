"""Whitening of vectors by shifted Cholesky QR.

The centred rows Y are factored as Y = QR without sorting or gathering them. A pass over the rows
sums the Gram matrix of what earlier factors left, its Cholesky factor becomes one more factor of
R, and the next pass applies it by triangular solves. The first factor is shifted, so that it
exists however badly conditioned the rows are; further passes bring Q to full precision. The
singular value decomposition of the small R then gives the components: R has the singular values
and right vectors of Y. Only the d x d matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored
from commerce_lake.llm.vectors import finite, matrix

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
BATCH = 4096
MAX_PASSES = 8
SETTLED = 1e-12
NULL = 1e-6


@dataclass(frozen=True)
class Whitening:
    """Row count and exact sums of the fitted rows, their components (columns) and eigenvalues, largest first."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def scaled(vector: Column) -> Column:
    """Integer entries of a vector: floor(64 c) + 1,000,000."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows x upper^-1 by substitution, one column after the other."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums).astype(np.float64) / n


def _summed(df: DataFrame, task, width: int) -> np.ndarray:
    """Sum over all tasks of the matrix that `task` makes of each one's rows; matrix rows are summed by Spark."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches, BATCH):
            part = task(batch)
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "v"])

    partial = df.mapInArrow(parts, "i int, v array<double>")
    rows = partial.groupBy("i").agg(F.array(*(F.sum(F.get("v", F.lit(j))) for j in range(width))).alias("v")).collect()
    return np.array([r["v"] for r in sorted(rows, key=lambda r: r["i"])])


def _exact_sums(df: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    largest = F.max(F.greatest(F.abs(F.array_min("x")), F.abs(F.array_max("x")))).alias("most")
    row = df.agg(F.count("*").alias("n"), F.array(*(F.sum(F.get("x", F.lit(j))) for j in range(dims))).alias("s"), largest).first()
    if row["n"] * row["most"] >= 2**62:
        raise OverflowError("sums of the entries do not fit in 64 bits")
    return row["n"], np.array(row["s"], np.int64)


def fit(df: DataFrame) -> Whitening:
    """Components of the rows of `df`, whose column `x` holds arrays of longs; shorter rows end with zero entries of the source.

    Directions in which no row differs have no component. An empty `df` has none at all.
    """
    dims = df.agg(F.max(F.size("x"))).first()[0] or 0
    if not dims:
        return Whitening(df.count(), np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 0.0)
    n, sums = _exact_sums(df.select(_padded(dims).alias("x")), dims)
    factors: list[np.ndarray] = []

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        y = _centred(matrix(batch.column("x"), dims, OFFSET), n, sums)
        for r in factors:
            y = solve_right(y, r)
        return y.T @ y

    total, trace = np.eye(dims), 0.0
    for _ in range(MAX_PASSES):
        g = _summed(df.select("x"), gram, dims)
        if not factors:
            trace = float(np.trace(g)) / n
            if not trace:
                return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0)
            more = 11 * (BATCH * dims + dims * (dims + 1)) * np.finfo(float).eps * np.trace(g) * np.eye(dims)
        else:
            values, vectors = np.linalg.eigh(g)
            empty = values < NULL
            if np.abs(values[~empty] - 1).max(initial=0) < SETTLED * dims:
                break
            # directions without spread keep their scale, which would only blow up rounding
            more = vectors[:, empty] @ vectors[:, empty].T
        r = np.linalg.cholesky(g + more).T
        factors = [*factors, r]
        total = r @ total
    u, singular, vt = np.linalg.svd(total)
    # of each component, the part of its scale that the rows fill: one, or none where no row differs
    filled = np.einsum("ij,ik,kj->j", u, g, u)
    eigenvalues = singular**2 * filled / n
    real = filled > 0.5
    order = np.argsort(-eigenvalues[real], kind="stable")
    return Whitening(n, sums, vt[real][order].T, eigenvalues[real][order], trace)


def _padded(dims: int) -> Column:
    return F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.greatest(F.lit(0), F.lit(dims) - F.size("x"))))


def _whitened(y: np.ndarray, model: Whitening, k: int) -> np.ndarray:
    return y @ model.components[:, :k] / np.sqrt(model.eigenvalues[:k])


def identity_error(df: DataFrame, model: Whitening, count: int = COMPONENTS) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, over the first `count` components."""
    dims, k = len(model.sums), min(count, len(model.eigenvalues))
    if not k:
        return 0.0

    def moments(batch: pa.RecordBatch) -> np.ndarray:
        z = _whitened(_centred(matrix(batch.column("x"), dims, OFFSET), model.n, model.sums), model, k)
        return np.vstack([z.T @ z, z.sum(axis=0)])

    found = _summed(df.select("x"), moments, k) / model.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def transform(df: DataFrame, model: Whitening, count: int = COMPONENTS) -> DataFrame:
    """`df` (id, x) as id, deviation, whitened: the squared distance of n x from the sums, and a double for each component.

    A deviation that does not fit in a long raises OverflowError.
    """
    dims, k = len(model.sums), min(count, len(model.eigenvalues))
    n, sums = model.n, model.sums

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BATCH):
            x = matrix(batch.column("x"), dims, OFFSET)
            apart = n * x - sums
            if dims and float(np.abs(apart).max(initial=0)) ** 2 * dims >= 2**62:
                deviation = [sum(int(v) ** 2 for v in row) for row in apart]
                if max(deviation) >= 2**63:
                    raise OverflowError("a deviation does not fit in 64 bits")
            else:
                deviation = (apart * apart).sum(axis=1)
            z = _whitened(apart.astype(np.float64) / n, model, k) if k else np.zeros((len(x), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviation, pa.int64()), pa.array(list(z), pa.list_(pa.float64()))], ["id", "deviation", "whitened"]
            )

    return df.select("id", "x").mapInArrow(rows, "id long, deviation long, whitened array<double>")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component.

    Vectors that are null, or hold null or non-finite entries, are left out. Shorter vectors count
    as ending in zeros. Entries whose sums or squares pass 64 bits raise OverflowError. Components without variance are not numbered, so equal vectors alone, a
    single one or none give no rows. Missing and repeated ids and repeated rows stay as they are.
    Other columns are ignored.
    """
    rows = stored(df.where(finite(vector_col)).select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col)).alias("x")), "vectors")
    model = fit(rows)
    error = identity_error(rows, model, count)
    shares = [float(e / model.trace) for e in model.eigenvalues[:count]]
    parts: Sequence[Column] = [F.posexplode("whitened").alias("at", "whitened")]
    return (
        transform(rows, model, count)
        .select("id", "deviation", *parts)
        .select(
            F.col("id").alias(id_col),
            (F.col("at") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(F.array(*(F.lit(s) for s in shares)).cast("array<double>"), F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
