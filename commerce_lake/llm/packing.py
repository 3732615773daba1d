"""Packing of token sequences into rows of fixed length.

Only the histogram over the lengths reaches the driver, at most one count for each length. There
the configuration linear program is solved by multiplicative weights: a knapsack dynamic program
prices the ways to fill a sequence, and lengths covered less get dearer. The amounts are rounded
down, then up in the order of their fractions while pieces last, and the program is solved again for
what is left. A share of each length is kept back for the end: it goes, with the last few pieces,
best-fit-decreasing into the room left in sequences. Pieces then find their sequence by their rank
among pieces of the same length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.bpe import vocabulary
from commerce_lake.llm.common import slices, stored, text_or_empty

CAPACITY = 2048
END_OF_TEXT = b"\0\0\0\0"
RATE = 4.0  # of the weights
PASSES, MOST_PASSES = 2.0, 10.0  # how often the program covers every length before it is scaled down; few lengths: more often
BATCH = 0.1  # coverage between two runs of the dynamic program
NEAR_BEST = 0.999  # of the best value, among which the least covered length is taken
OPENS = 0.9  # of the best value: a filling for a length is made from there on; below, its price has to rise first
KEPT_BACK = 0.07
LAST = 0.02  # share of the pieces that is left to best-fit
CLOSE = 0.995  # best-fit alone replaces the program only where it needs less than this share of its sequences

Pattern = tuple[int, ...]


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray:
    """Best value for each capacity."""
    best = np.zeros(capacity + 1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            best[c] = max(best[c], (prices[:n] + best[c - lengths[:n]]).max())
    return best


def _fill(first: int, amount: float, lengths: np.ndarray, demand: np.ndarray, cover: np.ndarray, prices: np.ndarray, best: np.ndarray) -> np.ndarray:
    """How often each length stands in a filling of near the best value around length number `first`.

    `amount` of it must not need more of a length than there is, so a rare length does not narrow
    the step of the others.
    """
    used, most = np.zeros(len(lengths)), demand // amount
    used[first] = 1
    room = len(best) - 1 - int(lengths[first])
    while n := int(np.searchsorted(lengths, room, side="right")):
        value = np.where(used[:n] < most[:n], prices[:n] + best[room - lengths[:n]], 0)
        if (top := value.max()) <= 0:
            break
        near = np.flatnonzero(value >= NEAR_BEST * top)
        k = near[(cover[near] + used[near] * amount / demand[near]).argmin()]
        used[k] += 1
        room -= int(lengths[k])
    return used


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[Pattern, float]:
    """Fractional numbers of filled sequences that cover the histogram.

    Each filling is made for the length covered least and adds a step of its demand, or one
    sequence where that is more.
    """
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return {}
    demand = np.array([histogram[int(n)] for n in lengths], float)
    step = min(0.1, max(0.02, len(lengths) / 5_000))
    passes = max(PASSES, min(MOST_PASSES, 400 / len(lengths)))
    cover, x = np.zeros(len(lengths)), Counter()
    while cover.min() < passes:
        # a length's weight is its share of the tokens, times exp(-rate x coverage)
        prices = lengths / capacity * np.exp(-RATE * (cover - cover.min()))
        best = _knapsack(lengths, prices, capacity)
        value = prices + best[capacity - lengths]
        open_ = np.flatnonzero(value >= OPENS * value.max())
        goal = cover[open_].min() + BATCH
        while cover[k := int(open_[cover[open_].argmin()])] < goal:
            amount = max(1.0, step * demand[k])
            used = _fill(k, amount, lengths, demand, cover, prices, best)
            on = np.flatnonzero(used)[::-1]
            cover[on] += amount * used[on] / demand[on]
            x[tuple(int(lengths[i]) for i in on for _ in range(int(used[i])))] += amount
    return {pattern: amount / cover.min() for pattern, amount in x.items()}


def _take(pattern: Pattern, left: Counter, most: int) -> int:
    need = Counter(pattern)
    times = min(most, *(left[n] // k for n, k in need.items()))
    if times > 0:
        for n, k in need.items():
            left[n] -= k * times
    return max(times, 0)


def best_fit(histogram: Counter, capacity: int, begun: dict[Pattern, int] | None = None) -> Counter:
    """Best-fit-decreasing over counts: sequences by what they hold, with how many there are.

    Sequences that have `begun` take in what fits.
    """
    rooms: list[dict[Pattern, int]] = [{} for _ in range(capacity + 1)]
    for pattern, count in (begun or {}).items():
        rooms[capacity - sum(pattern)][pattern] = count
    for n in sorted((n for n in histogram if histogram[n] > 0), reverse=True):
        left, room = histogram[n], n
        while left and room <= capacity:
            if not rooms[room]:
                room += 1
                continue
            pattern, count = rooms[room].popitem()
            take = min(count, left)
            left -= take
            if count > take:
                rooms[room][pattern] = count - take
            fuller = rooms[room - n]
            fuller[(*pattern, n)] = fuller.get((*pattern, n), 0) + take
            room = n  # a fuller sequence may now fit better
        each = capacity // n
        for size, count in ((each, left // each), (left % each, 1)):
            if size and count:
                rest = rooms[capacity - size * n]
                rest[(n,) * size] = rest.get((n,) * size, 0) + count
    out: Counter[Pattern] = Counter()
    for room in rooms:
        for pattern, count in room.items():
            out[pattern] += count
    return out


def filled(histogram: Counter, capacity: int) -> Counter:
    """Sequences by the rounded linear program; takes what they hold out of `histogram`.

    KEPT_BACK of the pieces, spread over the lengths, stay, and at most LAST of them besides.
    """
    kept, share = Counter(), 0.0
    for n in sorted(histogram):
        share += histogram[n] * KEPT_BACK
        kept[n] = min(int(share), histogram[n])
        share -= kept[n]
    histogram.subtract(kept)
    few = LAST * histogram.total()
    out: Counter[Pattern] = Counter()
    while histogram.total() > few:
        x = solve(+histogram, capacity)
        for pattern in sorted(x, key=lambda p: (-x[p], p)):
            out[pattern] += _take(pattern, histogram, int(x[pattern]))
        for pattern in sorted(x, key=lambda p: (int(x[p]) - x[p], p)):
            out[pattern] += _take(pattern, histogram, 1)
    histogram.update(kept)
    return +out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Sequences by content, with how many of each, that hold exactly the pieces of the histogram.

    With a handful of lengths the weights may stop short of the program's optimum; then best-fit
    alone is taken.
    """
    pieces = Counter({n: c for n, c in histogram.items() if c > 0 and n < capacity})
    left = pieces.copy()
    out = best_fit(left, capacity, filled(left, capacity))
    alone = best_fit(pieces, capacity)
    if alone.total() < CLOSE * out.total():
        out = alone
    if histogram.get(capacity):
        out[(capacity,)] += histogram[capacity]
    return sorted((p, c) for p, c in out.items() if c)


def _places(sequences: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces in one sequence, offset of the first)."""
    rows, rank, sequence = [], Counter(), 0
    for pattern, count in sequences:
        offset = 0
        for n, each in sorted(Counter(pattern).items(), reverse=True):
            rows.append((n, rank[n], sequence, each, offset))
            rank[n] += each * count
            offset += n * each
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def token_pieces(df: DataFrame, path: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """id, piece, start, length, ids_crc32: each text's ids and the end of text, cut to the capacity."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voc = vocabulary(path)
        width = 4 * capacity
        for batch in slices(batches):
            out: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = voc.encode(text) + END_OF_TEXT
                out += [(i, k, k * capacity, len(ids[a : a + width]) // 4, zlib.crc32(ids[a : a + width])) for k, a in enumerate(range(0, len(ids), width))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], _NAMES)

    return df.select(F.col(id_col).cast("long"), text_or_empty(text_col)).mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long")


_NAMES = ["id", "piece", "start", "length", "ids_crc32"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id, offset: a row for each piece.

    A text's ids end with id 0; only longer ones than `capacity` are cut. A missing text is that
    id alone. Repeated rows are packed as often as they stand there. Other columns are ignored.
    """
    pieces = stored(token_pieces(df, path, id_col, text_col, capacity), "pieces")
    # A length may have any share of the rows: ranks are counted in parts, dealt by a hash.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(parts)))
    counts = dealt.groupBy("length", "part").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    first = counts.select("length", "part", before.alias("before"))
    nth = F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("nth", nth).join(first, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before")).drop("part", "nth", "before")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = _places(plan(histogram, capacity))
    keys = table[:, 0] << 44 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in _NAMES), pa.array(sequence), pa.array(offset)], [*_NAMES, "sequence_id", "offset"])

    placed = ranked.select(*_NAMES, "rank").mapInArrow(
        place, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return placed.withColumnRenamed("id", id_col)
