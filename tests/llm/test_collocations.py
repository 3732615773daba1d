"""Collocations against a count of every phrase in Python."""

import random
import re
from collections import Counter

import compare
import numpy as np
import pytest
from corpus_helpers import DATA

from commerce_lake.llm import collocations, queries
from commerce_lake.llm.collocations import _score

SCHEMA = "doc_id long, text string, lang string, a long, n string, phrase string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def reference(rows, best=2000):
    counts = {}
    for lang, text in rows:
        c = counts.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                c.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        good = [p for p, v in c.items() if len(p) > 1 and v >= 10]
        covered = {s for t in good if len(t) == 3 for s in (t[:2], t[1:]) if 100 * c[t] >= 50 * c[s]}
        found = []
        for p in good:
            if p not in covered:
                cuts = [(1000000 * c[p] ** 2 // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return Counter(out)


def check(df, rows, **options):
    got = Counter(tuple(r) for r in collocations.collocations(df, **options).collect())
    want = reference(rows, options.get("best", 2000))
    assert got == want, ((got - want).most_common(3), (want - got).most_common(3))
    return want


def frame(spark, rows):
    return spark.createDataFrame([(k, text, lang, 1, "x", "y") for k, (lang, text) in enumerate(rows)], SCHEMA)


def made_up(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "Ünder", "\x1c", "日本", "a\x85b", "U.S."]
    fixed = ["new york city", "As Well As", "to be", "w1 w2 w3", "w2 w3", "x y z"]
    rows = []
    for _ in range(n):
        words = [rng.choice(fixed) if rng.random() < 0.3 else vocabulary[min(int(rng.expovariate(0.12)), 30)] for _ in range(rng.randrange(40))]
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), "".join(w + rng.choice([" ", " ", "  ", "\t", ", ", "\n", "! ", "\x0b", "\r\n"]) for w in words)))
    return rows


def test_edge_cases(spark):
    rows = made_up(1, 400) + [("en", None), (None, None), ("de", ""), ("nl", " \t. ,"), ("it", "uno due tre " * 9), ("pt", "um dois " * 10)]
    rows += rows[:20]
    assert len(check(frame(spark, rows), rows)) > 30
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("best", [1, 3, 10, 25])
def test_thresholds_fall_until_enough_survive(spark, best):
    rows = made_up(best, 120)
    check(frame(spark, rows), rows, best=best)


def test_chance_hits_and_full_maps_change_nothing(spark, monkeypatch):
    """A full map prunes nothing, and one with chance hits little; the result stays."""
    full = np.full(1 << (collocations.MAP_BITS - 6), (1 << 64) - 1, np.uint64)
    chance = np.random.default_rng(1).integers(0, 1 << 64, len(full), np.uint64)
    real = collocations.bit_map
    for extra in (full, chance):
        monkeypatch.setattr(collocations, "bit_map", lambda phrases, extra=extra: real(phrases) | extra)
        small = made_up(9, 100)
        check(frame(spark, small), small, best=5)


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 50)
    monkeypatch.setattr(collocations, "TASK_TOKENS", 37)
    rows = made_up(3, 60) + [("en", "alpha beta gamma delta. " * 500), ("en", "z" * 5000 + " alpha beta")]
    check(frame(spark, rows), rows)


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(9 * 10**15 + 1, 10**16, 10**16 + 7), (3 * 10**12, 7 * 10**12, 5 * 10**12), (10, 10, 10), (10, 3 * 10**9, 10**9)]
    got = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", _score("a", "l", "r").alias("s")).collect()
    assert all(r.s == 1000000 * r.a**2 // (r.l * r.r) for r in got)


def test_query(spark):
    df = queries.op12_collocations(spark, str(DATA))
    assert compare.differences(df, compare.connect(str(DATA)), queries.COLLOCATIONS_SQL) == []
