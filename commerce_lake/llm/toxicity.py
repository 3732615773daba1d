"""Toxicity from confirmed toxic texts and unlabelled ones.

A linear classifier on words and their beginnings, trained in numpy by the non-negative
positive-unlabelled risk: the risk of the negatives is that of the unlabelled texts less the
share of the positives in it, and is held at zero where it would fall below. Only features that
clearly stand in more of the confirmed texts than of the unlabelled ones are trained on.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, text_or_empty

BUCKETS = 1 << 20
MAX_POSITIVE = 4_000
MAX_UNLABELLED = 12_000
PREFIXES = (5, 6, 7)
LEVELS = (1, 3, 8)
FEATURES = 600
MIN_Z = 3.5
MIN_POSITIVE = 4
EPOCHS = 400
RATE = 0.05
DECAY = 1e-3
THRESHOLD = 0.3
HELD_OUT = 2
FOLDS = 4
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 4; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def features(text: str) -> np.ndarray:
    """Hash buckets of a text's words, and of word beginnings by how often they stand there.

    Words are lower-case and without punctuation around. A beginning of five to seven letters
    gives a bucket for each of the LEVELS that its count reaches.
    """
    counts = Counter(text.lower().split())
    words: Counter[str] = Counter()
    for word, n in counts.items():
        words[word.strip(_PUNCTUATION)] += n
    starts: Counter[str] = Counter()
    for word, n in words.items():
        for k in PREFIXES:
            if len(word) > k:
                starts[word[:k]] += n
    names = [w for w in words if w]
    for level in LEVELS:
        names += [f"{level}|{s}" for s, n in starts.items() if n >= level]
    return np.unique(np.fromiter((zlib.crc32(n.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) for n in names), np.int32, len(names)))


@dataclass
class Model:
    """Weights of the buckets that count, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[features(text)].sum(dtype=np.float64)))))


def _telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """The buckets whose log ratio of shares, in standard errors, is highest."""
    a, b = (np.bincount(np.concatenate(x), minlength=BUCKETS) for x in (positive, unlabelled))
    ratio = np.log((a + 0.5) / (len(positive) + 1)) - np.log((b + 0.5) / (len(unlabelled) + 1))
    z = np.where(a >= MIN_POSITIVE, ratio / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)), 0)
    best = np.argsort(-z, kind="stable")[:FEATURES]
    return np.sort(best[z[best] >= MIN_Z])


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Full-batch training on the bucket lists of confirmed and unlabelled texts.

    Without positives everything scores near zero.
    """
    weights = np.zeros(BUCKETS, np.float32)
    if not positive or not unlabelled:
        return Model(weights, float(np.log(max(prior, 1e-3) / (1 - min(prior, 0.999)))))
    flat = np.concatenate([*positive, *unlabelled])
    rows = np.repeat(np.arange(len(positive) + len(unlabelled)), [len(x) for x in [*positive, *unlabelled]])
    used = _telling(positive, unlabelled)
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    kept = column[flat] >= 0
    rows, columns = rows[kept], column[flat[kept]]
    n, n_pos, m = len(positive) + len(unlabelled), len(positive), len(used)
    is_pos = np.arange(n) < n_pos
    share = np.where(is_pos, 1 / n_pos, 1 / len(unlabelled))
    w, bias = np.zeros(m + 1), float(np.log(prior / (1 - prior)))
    w[m] = bias
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, EPOCHS + 1):
        z = np.bincount(rows, w[columns], minlength=n) + w[m]
        p = sigmoid(z)
        loss_neg = np.logaddexp(0, z)  # as if negative
        negative_risk = (loss_neg * share)[~is_pos].sum() - prior * (loss_neg * share)[is_pos].sum()
        g_positive = np.where(is_pos, prior * share * (p - 1), 0.0)
        g_negative = np.where(is_pos, -prior * share * p, share * p)
        # a negative risk below zero is overfitting: step back on that part alone
        g = g_positive + g_negative if negative_risk >= 0 else -g_negative
        grad = np.append(np.bincount(columns, g[rows], minlength=m) + DECAY * w[:m], g.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[used] = w[:m]
    # the bias at which the unlabelled texts score the class prior in the mean
    z = np.bincount(rows, w[columns], minlength=n)[~is_pos]
    low, high = -30.0, 30.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if sigmoid(z + middle).mean() < prior else (low, middle)
    return Model(weights, low)


def _bucket_rows(df: DataFrame, text_col: str) -> list[np.ndarray]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int32()))], ["b"])

    rows = df.select(text_or_empty(text_col).alias("text")).distinct().mapInArrow(find, "b array<int>").toArrow().column("b")
    return [np.asarray(x.values, np.int32) for chunk in rows.chunks for x in chunk if x.is_valid]


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of the texts that `labels` marks toxic, without the labels of the held-out fold.

    It is fitted on samples of at most about MAX_POSITIVE confirmed and MAX_UNLABELLED other
    texts, drawn by a hash of the id. The class prior is the share of toxic rows among all labels
    that may be used.
    """
    usable = labels.where((fold(id_col) != HELD_OUT) & F.col("toxic").isNotNull() & F.col(id_col).isNotNull()).select(id_col, "toxic")
    n, n_pos = usable.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    prior = min(max(n_pos / n, 1e-3), 0.5) if n else 1e-3

    def drawn(df: DataFrame, total: int, most: int) -> DataFrame:
        unit = F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return df.where(unit < (most / total if total else 1.0))

    confirmed = drawn(usable.where("toxic = 1"), n_pos, MAX_POSITIVE).select(id_col).distinct()
    # at most about MAX_POSITIVE ids, so sending them to all tasks has a bound
    positive = documents.join(F.broadcast(confirmed), id_col, "left_semi")
    others = documents.where(fold(id_col) != HELD_OUT)
    unlabelled = drawn(others, others.count(), MAX_UNLABELLED)
    return train(_bucket_rows(positive, text_col), _bucket_rows(unlabelled, text_col), prior)


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted for each row; a missing text counts as empty."""
    weights = documents.sparkSession.sparkContext.broadcast(model.weights)
    bias = model.bias

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights.value, bias)
        for batch in slices(batches):
            scores = [own.score(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    rows = documents.select(F.col(id_col).cast("long").alias("id"), (fold(id_col) == HELD_OUT).alias("held_out"), text_or_empty(text_col).alias("text"))
    out = rows.mapInArrow(scored, "id long, held_out boolean, score double")
    return out.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
