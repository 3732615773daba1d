"""Packing: every token in one place, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from corpus_helpers import DATA

from commerce_lake.llm import bpe, packing, queries

PATH = bpe.public_vocabulary()


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_the_histogram(seed):
    rng = random.Random(seed)
    capacity = rng.choice([8, 60, 2048])
    histogram = {n: rng.choice([1, 3, 500, 100_000]) for n in rng.sample(range(1, capacity + 1), rng.randrange(1, min(capacity, 80)))}
    plan = packing.plan(histogram, capacity)
    held = Counter()
    for pattern, count in plan:
        assert sum(pattern) <= capacity
        for n in pattern:
            held[n] += count
    assert held == Counter(histogram)
    best_fit = sum(packing.best_fit(Counter(histogram), capacity).values())
    assert sum(c for _, c in plan) <= best_fit * 1.01 + 2


def fewest(pieces, capacity):
    """The least number of sequences, by trying every place of every piece."""
    best = len(pieces)

    def place(k, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if k == len(pieces):
            best = len(loads)
            return
        for i in range(len(loads)):
            if loads[i] + pieces[k] <= capacity and loads[i] not in loads[:i]:
                place(k + 1, [*loads[:i], loads[i] + pieces[k], *loads[i + 1 :]])
        place(k + 1, [*loads, pieces[k]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(10))
def test_small_histograms_against_all_packings(seed):
    rng = random.Random(seed)
    pieces = sorted((rng.randrange(1, 21) for _ in range(11)), reverse=True)
    assert sum(c for _, c in packing.plan(Counter(pieces), 20)) <= fewest(pieces, 20) + 1


def test_the_program_places_nearly_all():
    rng = random.Random(5)
    for pieces in ([rng.randrange(600, 1201) for _ in range(20_000)], [min(2047, int(rng.lognormvariate(6, 1)) + 1) for _ in range(5000)]):
        left = Counter(pieces)
        placed = packing.filled(left, 2048)
        held = Counter()
        for pattern, count in placed.items():
            for n in pattern:
                held[n] += count
        assert held + left == Counter(pieces) and held.total() >= 0.9 * len(pieces)
        fitted = sum(packing.best_fit(Counter(pieces), 2048).values())
        assert sum(c for _, c in packing.plan(Counter(pieces))) <= fitted * 1.003 + 1


def test_better_than_best_fit_where_pieces_are_large():
    rng = random.Random(6)
    pieces = Counter(rng.randrange(600, 1201) for _ in range(20_000))
    assert sum(c for _, c in packing.plan(pieces)) < sum(packing.best_fit(pieces, 2048).values())


def test_empty_histogram():
    assert packing.plan({}) == []


def check(rows, texts, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in texts:
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            want[i, k // capacity, k, len(part), zlib.crc32(b"".join(v.to_bytes(4, "little") for v in part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_edge_cases(docs, no_docs):
    rows = packing.pack(docs, PATH, capacity=64).collect()
    check(rows, [(r.doc_id, r.text or "") for r in docs.collect()], 64)
    assert packing.pack(no_docs, PATH).count() == 0


def test_query(spark):
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows = queries.op6_best_fit_packing(spark, str(DATA)).collect()
    assert check(rows, texts, 2048) <= 1.02 * sum(r.length for r in rows) / 2048 + 1
