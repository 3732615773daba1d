"""Fingerprints and their join against brute force."""

import numpy as np
import pytest
import xxhash
from corpus_helpers import DATA, WORD

from commerce_lake.llm import queries, simhash


def reference(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, budget=2):
    label = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for p in label:
            for q in label:
                if (p ^ q).bit_count() <= budget and label[q] < label[p]:
                    label[p], changed = label[q], True
    return label


def test_links_of_clustered_fingerprints():
    rng = np.random.default_rng(1)
    for size in (1, 2, 50, 700):
        centre = rng.integers(0, 1 << 63, max(1, size // 20), dtype=np.uint64)
        flips = np.uint64(1) << rng.integers(0, 64, (size, 4), dtype=np.uint64)
        values = np.unique(np.bitwise_xor.reduce(np.where(rng.random((size, 4)) < 0.5, flips, np.uint64(0)), axis=1) ^ rng.choice(centre, size))
        want = components([int(v) for v in values])
        parts = {int(v): int(v) for v in values}
        links = simhash.links_of(values, None)
        for a, b in sorted(links.T.tolist(), key=lambda x: -x[0]):
            parts[a] = b
        group = lambda labels: sorted(sorted(v for v in labels if labels[v] == k) for k in set(labels.values()))
        assert group(parts) == group(want)


@pytest.mark.parametrize("node_size", [4, 1 << 14])
def test_edge_cases(docs, no_docs, node_size):
    rows = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, node_size=node_size).collect()]
    assert len(rows) == docs.count()
    prints = {p for _, p, _ in rows}
    label = components([int(p, 16) for p in prints])
    for i, p, c in rows:
        mine = [j for j, q, _ in rows if label[int(q, 16)] == label[int(p, 16)] and j is not None]
        assert c == (min(mine) if mine else None)
    assert sorted(p for _, p, _ in rows) == sorted(f"{reference(r.text or ''):016x}" for r in docs.collect())
    assert simhash.near_duplicates(no_docs).count() == 0


def test_one_row_of_each_component_stays(docs):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # the two texts under id 5 are components of their own with the same smallest id
    label = components({reference(r.text or "") for r in docs.collect()})
    assert kept.count() == len(set(label.values()))


def test_query(spark):
    rows = queries.op3_simhash_near_dedup(spark, str(DATA)).collect()
    label = components({int(r.fingerprint, 16) for r in rows})
    least = {}
    for r in rows:
        key = label[int(r.fingerprint, 16)]
        least[key] = min(least.get(key, r.doc_id), r.doc_id)
    assert all(r.component_id == least[label[int(r.fingerprint, 16)]] for r in rows)
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert all(f"{reference(texts[r.doc_id]):016x}" == r.fingerprint for r in rows) and len(rows) == len(texts)
