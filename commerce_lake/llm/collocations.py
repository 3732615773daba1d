"""Phrases whose words stand together far more often than apart, by branch and bound.

Phrases grow word by word from counted prefixes. A pass over the texts counts one length, and only
below open prefixes. No phrase that begins with the words p of a counted prefix can occur more
often than p, so none scores over 1000000 f(p) / f(first word of p): that bound is admissible.
Each language has a threshold; prefixes with a bound at or above it are open. A two-word phrase
can be dropped for a longer one, so those at or above the threshold also open the phrases that end
with them. When 2000 phrases at or above the threshold survive, nothing below it can be among the
first 2000, and ties are complete. Otherwise the threshold falls and the prefixes newly
open are counted.

Tasks tell open prefixes by a bit map of fixed size, set from their hashes. A chance hit costs a
count that is not needed and changes no result, as a phrase is counted everywhere or nowhere.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count as counting

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored

LEAST = 10
BEST = 2000
SCORE = 1_000_000
UNKNOWN = "und"
# Bigrams above the first threshold, for each phrase wanted; each round that is not enough asks for GROWTH times as many.
FIRST = 2
GROWTH = 4
MAP_BITS = 26
PARTS = 32
TASK_TOKENS = 1 << 18
CHUNK = 1 << 20
_BREAK = b"."
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 9)
_GAP = re.compile(rb"[ \t.]")
_ONE, _TWO, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(64 - MAP_BITS)
_COUNTED = "lang string, phrase string, n long"


def tokens(text: str, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The lower-case words of a text in parts of about `size` bytes, with a full stop at each break."""
    data = text.encode("utf-8", "surrogatepass").translate(_PLAIN)
    start = 0
    while start < len(data):
        gap = _GAP.search(data, start + size)
        end = gap.start() if gap else len(data)
        yield data[start:end].replace(_BREAK, b" . ").split()
        start = end


def _hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def _places(first: np.ndarray, second: np.ndarray | None = None) -> np.ndarray:
    """Bits of words, or of pairs of words, in a map."""
    mixed = first * _ONE if second is None else (first ^ (first >> np.uint64(29))) * _ONE + (second ^ (second >> np.uint64(31))) * _TWO
    return ((mixed ^ (mixed >> np.uint64(32))) * _ONE) >> _SHIFT


def _set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1) == 1


def bit_map(phrases: DataFrame) -> np.ndarray:
    """The map of the words or word pairs in `phrases` (lang, phrase): 8 MB, whatever their number."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            places = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = _hashes(lang, phrase.encode("utf-8", "surrogatepass").split(b" "))
                places.append(_places(*(h[k : k + 1] for k in range(len(h))))[0])
            at = np.array(places, np.uint64)
            bits = np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(bits)], ["at", "bits"])

    words = phrases.select("lang", "phrase").mapInArrow(hashed, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


#: Takes the word ids of a phrase of each position and the word hashes; False where it need not be counted.
Wanted = Callable[[list[np.ndarray], np.ndarray], np.ndarray]


def _count(lang: str, words: list[bytes], order: int, wanted: Wanted | None) -> tuple[list[bytes], np.ndarray]:
    """The phrases of `order` words between breaks, with their counts."""
    number = defaultdict(counting(1).__next__, {_BREAK: 0})
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    names = list(number)
    columns = [ids[k : len(ids) - order + k + 1] for k in range(order)]
    use = np.logical_and.reduce([c > 0 for c in columns])
    if wanted is not None:
        columns = [c[use] for c in columns]
        use = wanted(columns, _hashes(lang, names))
    columns = [c[use] for c in columns]
    code = columns[0].copy()
    for c in columns[1:]:
        code = code * len(names) + c
    distinct, times = np.unique(code, return_counts=True)
    parts = []
    for _ in range(order):
        parts.append((distinct % len(names)).tolist())
        distinct = distinct // len(names)
    return [b" ".join(map(names.__getitem__, at)) for at in zip(*reversed(parts))], times


def count_phrases(docs: DataFrame, order: int, wanted: Wanted | None = None) -> DataFrame:
    """lang, phrase, n: occurrences of the phrases of `order` words in `docs` (lang, text), those with LEAST or more.

    For single words there is also a row without a phrase for each language: the number of all words.
    Tasks sum what they read before the shuffle, a quarter of a million words at a time, so a common
    phrase sends few rows; the shuffle comes straight after, as a second sum in the task finds little left to add.
    """
    limit, size = TASK_TOKENS, CHUNK

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        held = 0

        def flushed(lang: str) -> pa.RecordBatch:
            words = waiting[lang]
            phrases, times = _count(lang, words, order, wanted) if len(words) >= order else ([], np.zeros(0, np.int64))
            names = pa.array(phrases, pa.binary()).cast(pa.string())
            if order == 1:
                names, times = pa.concat_arrays([names, pa.nulls(1, pa.string())]), np.append(times, times.sum())
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, pa.array(times, pa.int64())], ["lang", "phrase", "n"])

        for batch in slices(batches, 256):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in tokens(text, size):
                    waiting.setdefault(lang, []).extend(part)
                    held += len(part)
                    if held >= limit:
                        for each in waiting:
                            yield flushed(each)
                        # a long text goes on: its last words begin the next phrases
                        waiting = {lang: waiting[lang][len(waiting[lang]) - order + 1 :]}
                        held = 0
                if lang in waiting:
                    waiting[lang].append(_BREAK)
        for each in waiting:
            yield flushed(each)

    partial = docs.select("lang", "text").mapInArrow(counted, _COUNTED)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = partial.repartition(parts, "lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return total.where((F.col("n") >= LEAST) | F.col("phrase").isNull())


def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), exact below 10^16 occurrences: the products are decimals of 38 digits."""
    wide = lambda c: f"CAST({c} AS DECIMAL(18, 0))"
    return F.expr(f"({wide(a)} * {wide(a)} * {SCORE}BD) div ({wide(left)} * {wide(right)})").cast("long")


def _pairs(found: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score, bound of two-word phrases."""
    first = words.select("lang", F.col("phrase").alias("w1"), F.col("n").alias("l"))
    second = words.select("lang", F.col("phrase").alias("w2"), F.col("n").alias("r"))
    split = F.split("phrase", " ")
    rows = found.select("lang", "phrase", F.col("n").alias("a"), F.get(split, F.lit(0)).alias("w1"), F.get(split, F.lit(1)).alias("w2"))
    rows = rows.join(first, ["lang", "w1"]).join(second, ["lang", "w2"])
    bound = F.expr(f"(CAST(a AS DECIMAL(18, 0)) * {SCORE}BD) div CAST(l AS DECIMAL(18, 0))").cast("long")
    return rows.select("lang", "phrase", "a", "l", "r", _score("a", "l", "r").alias("score"), bound.alias("bound"))


def _triples(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score, head, tail, head_a, tail_a of three-word phrases; the lower-scoring cut counts."""
    space = F.substring_index("phrase", " ", 1)
    rows = found.select("lang", "phrase", F.col("n").alias("a"), F.substring_index("phrase", " ", 2).alias("head"), F.substring_index("phrase", " ", -2).alias("tail"), space.alias("w1"))
    heads = pairs.select("lang", F.col("phrase").alias("head"), F.col("a").alias("head_a"), F.col("l").alias("w1_n"))
    tails = pairs.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("tail_a"), F.col("r").alias("w3_n"))
    rows = rows.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    rows = rows.withColumn("s1", _score("a", "w1_n", "tail_a")).withColumn("s2", _score("a", "head_a", "w3_n"))
    first = F.col("s1") <= F.col("s2")
    return rows.select(
        "lang", "phrase", "a",
        F.when(first, F.col("w1_n")).otherwise(F.col("head_a")).alias("l"),
        F.when(first, F.col("tail_a")).otherwise(F.col("w3_n")).alias("r"),
        F.least("s1", "s2").alias("score"), "head", "tail", "head_a", "tail_a",
    )


def _thresholds(pairs: DataFrame, langs: DataFrame, place: int) -> DataFrame:
    """lang, least: a score that `place` two-word phrases or more reach; -1, which opens everything, where there are fewer.

    Scores are counted by their first five binary digits, so a language has a few hundred counts.
    """
    digits = "greatest(0, length(bin(score)) - 5)"
    counts = pairs.groupBy("lang", F.expr(f"shiftleft(shiftright(score, {digits}), {digits})").alias("low")).count()
    above = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("low")))
    at = counts.withColumn("above", above).where(F.col("above") >= place).groupBy("lang").agg(F.max("low").alias("least"))
    return langs.join(at, "lang", "left").fillna(-1, ["least"])


def _surviving(pairs: DataFrame, triples: DataFrame, least: DataFrame) -> DataFrame:
    """The phrases at or above their language's threshold that no longer one replaces."""
    names = ["lang", "phrase", "a", "l", "r", "score"]
    covered = lambda side: triples.where(F.col("a") * 2 >= F.col(f"{side}_a")).select("lang", F.col(side).alias("phrase"))
    dropped = covered("head").union(covered("tail")).distinct()
    above = lambda df: df.join(least, "lang").where(F.col("score") >= F.col("least")).select(names)
    return above(pairs).join(dropped, ["lang", "phrase"], "left_anti").unionByName(above(triples))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two or three words in each language.

    A missing language is `und`, a missing text is empty. Texts end every phrase; repeated rows
    count each time. A language without phrases that stand ten times has no rows. Texts of any
    length are read in parts, whose phrases go on across the cuts. Other columns are ignored.
    """
    docs = df.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = stored(count_phrases(docs, 1), "words")
    totals = words.where(F.col("phrase").isNull()).select("lang", F.col("n").alias("total"))
    words = words.where(F.col("phrase").isNotNull())
    often = bit_map(words)

    def of_frequent_words(columns: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
        good = _set(often, _places(hashes))
        return good[columns[0]] & good[columns[1]]

    pairs = stored(_pairs(count_phrases(docs, 2, of_frequent_words), words), "pairs")
    frequent = bit_map(pairs)
    langs = totals.select("lang")
    place, least, triples = FIRST * best, None, None
    while True:
        lower = _thresholds(pairs, langs, place)
        if least is not None:  # languages that are settled keep their threshold
            lower = lower.withColumnRenamed("least", "lower").join(least.join(unsettled.withColumn("open", F.lit(True)), "lang", "left"), "lang")
            lower = lower.select("lang", F.when(F.col("open"), F.col("lower")).otherwise(F.col("least")).alias("least"))
        new = stored(lower, "thresholds")
        opened = _opened(pairs, new, "bound"), _opened(pairs, new, "score")
        if least is not None:
            opened = tuple(o.join(_opened(pairs, least, c), ["lang", "phrase"], "left_anti") for o, c in zip(opened, ("bound", "score")))
        least = new
        heads, tails = map(bit_map, opened)

        def below_open(columns: list[np.ndarray], hashes: np.ndarray, heads=heads, tails=tails) -> np.ndarray:
            first, second, third = (hashes[c] for c in columns)
            head, tail = _places(first, second), _places(second, third)
            return _set(frequent, head) & _set(frequent, tail) & (_set(heads, head) | _set(tails, tail))

        found = stored(_triples(count_phrases(docs, 3, below_open), pairs), "triples")
        triples = found if triples is None else stored(triples.unionByName(found).dropDuplicates(["lang", "phrase"]), "triples")
        surviving = stored(_surviving(pairs, triples, least), "surviving")
        counts = surviving.groupBy("lang").agg(F.count("*").alias("n"))
        unsettled = stored(least.join(counts, "lang", "left").where((F.col("least") >= 0) & (F.coalesce("n", F.lit(0)) < best)).select("lang"), "unsettled")
        if unsettled.isEmpty():
            break
        place *= GROWTH
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    # first within parts of a language, of which a final task sees the best alone
    part = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = surviving.withColumn("part", part).where(F.col("part") <= best).withColumn("rank", rank).where(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )


def _opened(pairs: DataFrame, least: DataFrame, by: str) -> DataFrame:
    return pairs.join(least, "lang").where(F.col(by) >= F.col("least")).select("lang", "phrase")
