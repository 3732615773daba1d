"""Near duplicates by SimHash: fingerprints, and their self-join along a binary trie.

The distinct fingerprints are the leaves of a trie. A node is cut off where it holds few
enough of them for one task; pairs of such nodes whose prefixes differ in no more bits than
allowed are the tasks. In a task the trie is walked on from a pair of nodes, both one bit
deeper at a time, with the differing bits added up; a pair over the budget is dropped with
all below it. A task returns a spanning forest of the links it found.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored, text_or_empty
from commerce_lake.llm.components import components

BITS = 64
SEED = 42
SHINGLE = 3
MAX_DIFFERENT = 2
NODE_SIZE = 16_384
LEAST_DEPTH = 5
MAX_NODES = 4096
CUT_STEP = 12
FRONTIER = 1 << 18
_FLIP = np.uint64(1 << 63)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None) -> int:
    """SimHash of the three-word shingles of a text; zero for one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = [b"%b %b %b" % w for w in zip(words, words[1:], words[2:])]
    hash_ = xxhash.xxh64_intdigest
    hashes = np.array([hash_(s, SEED) for s in shingles], dtype=">u8")
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 8192):
        ones += np.unpackbits(hashes[start : start + 8192].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.fromiter((fingerprint(t) for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["id", "hash", "print"])


def _prefix(depth: int) -> Column:
    """The first `depth` bits of the fingerprint, as a number."""
    return F.shiftrightunsigned("print", BITS - depth)


def cut_nodes(prints: DataFrame, size: int) -> list[tuple[int, int]]:
    """(first fingerprint, depth) of the trie nodes that share out the distinct fingerprints.

    Nodes hold `size` fingerprints at most, and share their first LEAST_DEPTH bits, so that there
    are tasks enough for small inputs too. Only counts of prefixes reach the driver, CUT_STEP
    bits deeper each time and there only below nodes that are still too large.
    """
    nodes: list[tuple[int, int]] = []
    open_: list[tuple[int, int]] = [(0, 0)]
    depth = 0
    while open_:
        deeper = min(depth + CUT_STEP, BITS)
        below = prints if depth == 0 else prints.where(_prefix(depth).isin([start >> (BITS - depth) for start, _ in open_]))
        counted = below.groupBy(_prefix(deeper).alias("p")).count().collect()
        starts = np.array([r["p"] % (1 << deeper) << (BITS - deeper) for r in counted], dtype=np.uint64)
        order = np.argsort(starts)
        starts, totals = starts[order], np.concatenate([[0], np.cumsum(np.array([r["count"] for r in counted])[order])])
        stack, open_ = open_, []
        while stack:
            start, d = stack.pop()
            lo = np.searchsorted(starts, np.uint64(start))
            hi = np.searchsorted(starts, np.uint64(start + (1 << (BITS - d)) - 1), side="right")
            held = totals[hi] - totals[lo]
            if held <= size and d >= LEAST_DEPTH or d == BITS:
                nodes.append((start, d))
            elif d < deeper:
                stack += [(start, d + 1), (start + (1 << (BITS - d - 1)), d + 1)]
            else:
                open_.append((start, d))
        depth = deeper
    return sorted(nodes)


def node_pairs(nodes: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs (i, j), i <= j, of nodes whose common bits differ in `budget` places at most.

    Walks down the cut trie with pairs of nodes, as the tasks do below it.
    """
    starts = [s for s, _ in nodes]

    def inside(start: int, d: int) -> tuple[int, int]:
        return bisect_left(starts, start), bisect_left(starts, start + (1 << (BITS - d)))

    pairs = []
    stack = [(0, 0, 0, 0, 0)]  # start and depth of both, differing bits
    while stack:
        a, da, b, db, bits = stack.pop()
        (alo, ahi), (blo, bhi) = inside(a, da), inside(b, db)
        if alo == ahi or blo == bhi:
            continue
        a_cut, b_cut = ahi - alo == 1 and nodes[alo] == (a, da), bhi - blo == 1 and nodes[blo] == (b, db)
        if a_cut and b_cut:
            pairs.append((alo, blo))
            continue
        # deeper on each side that is not at its cut; bits are compared once both have them
        halves = lambda s, d, cut: [(s, d)] if cut else [(s, d + 1), (s + (1 << (BITS - d - 1)), d + 1)]
        for na, nda in halves(a, da, a_cut):
            for nb, ndb in halves(b, db, b_cut):
                if (a, da) == (b, db) and na > nb:
                    continue
                common = min(nda, ndb)
                different = ((na ^ nb) >> (BITS - common)).bit_count() if common else 0
                if different <= budget:
                    stack.append((na, nda, nb, ndb, different))
    return sorted(set((min(p), max(p)) for p in pairs))


def _walk(a: np.ndarray, b: np.ndarray, same: bool, budget: int) -> Iterator[np.ndarray]:
    """Index pairs (into sorted `a` and `b`) of fingerprints within `budget` bits of each other."""
    first = np.array([[0], [len(a)], [0], [len(b)], [0]], np.int64)
    stack = [(first, 0)]
    while stack:
        nodes, depth = stack.pop()
        alo, ahi, blo, bhi, bits = nodes
        few = (ahi - alo) * (bhi - blo) <= 16
        if few.any() or depth == BITS:
            small = nodes[:, few] if depth < BITS else nodes
            width = small[3] - small[2]
            counts = (small[1] - small[0]) * width
            owner = np.repeat(np.arange(small.shape[1]), counts)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            i, j = small[0][owner] + nth // width[owner], small[2][owner] + nth % width[owner]
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            yield np.stack([i[near], j[near]])
            nodes = nodes[:, ~few] if depth < BITS else nodes[:, :0]
        if not nodes.shape[1]:
            continue
        if nodes.shape[1] > FRONTIER:
            for part in np.array_split(nodes, -(-nodes.shape[1] // FRONTIER), axis=1):
                stack.append((part, depth))
            continue
        alo, ahi, blo, bhi, bits = nodes
        bit = np.uint64(1 << (BITS - 1 - depth))
        clear = ~np.uint64((1 << (BITS - depth)) - 1) if depth else np.uint64(0)
        amid = np.searchsorted(a, (a[alo] & clear) | bit)
        bmid = np.searchsorted(b, (b[blo] & clear) | bit)
        one = bits + 1
        below = [(alo, amid, blo, bmid, bits), (amid, ahi, bmid, bhi, bits), (alo, amid, bmid, bhi, one), (amid, ahi, blo, bmid, one)]
        if same:  # a pair of a node with itself has one mixed pair, not two
            below[3] = tuple(np.where(alo == blo, 0, x) for x in below[3])
        nodes = np.concatenate([np.stack(x) for x in below], axis=1)
        nodes = nodes[:, (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (nodes[4] <= budget)]
        if nodes.shape[1]:
            stack.append((nodes, depth + 1))


def _forest(n: int, found: Iterator[np.ndarray]) -> np.ndarray:
    """A spanning forest, as links of each node to the smallest of its part."""
    label = np.arange(n)
    for i, j in found:
        while len(i):
            x, y = label[i], label[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                after = label[label]
                if (after == label).all():
                    break
                label = after
    moved = np.flatnonzero(label != np.arange(n))
    return np.stack([moved, label[moved]])


def links_of(a: np.ndarray, b: np.ndarray | None, budget: int = MAX_DIFFERENT) -> np.ndarray:
    """Links of the sorted distinct fingerprints `a` (and `b`), reduced to a spanning forest."""
    if b is None:
        return a[_forest(len(a), _walk(a, a, True, budget))]
    both = np.concatenate([a, b])
    shifted = (np.stack([i, j + len(a)]) for i, j in _walk(a, b, False, budget))
    return both[_forest(len(both), shifted)]


def _tasks(nodes: list[tuple[int, int]], pairs: list[tuple[int, int]]):
    """Sends each fingerprint to every pair of nodes that its node is part of."""
    starts = np.array([s for s, _ in nodes], np.uint64)
    of_node: list[list[tuple[int, int]]] = [[] for _ in nodes]
    for k, (i, j) in enumerate(pairs):
        of_node[i].append((k, 0))
        if j != i:
            of_node[j].append((k, 1))
    counts = np.array([len(x) for x in of_node])
    flat = np.array([y for x in of_node for y in x], np.int64).reshape(-1, 2)
    first = np.cumsum(counts) - counts

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            node = np.searchsorted(starts, values.view(np.uint64), side="right") - 1
            n = counts[node]
            rows = np.repeat(np.arange(len(values)), n)
            at = first[node][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[at, 0]), pa.array(flat[at, 1].astype(np.int32)), pa.array(values[rows])], ["pair", "side", "print"]
            )

    return send


def fingerprint_links(prints: DataFrame, budget: int = MAX_DIFFERENT, node_size: int = NODE_SIZE) -> DataFrame:
    """a, b: links whose components are those of all fingerprints within `budget` bits.

    `prints` has distinct fingerprints in the column `print`. A task joins two nodes of `node_size`
    fingerprints, or more where there would be over MAX_NODES nodes to pair on the driver.
    """
    nodes = cut_nodes(prints, max(node_size, prints.count() // MAX_NODES))
    pairs = node_pairs(nodes, budget)
    sent = prints.select("print").mapInArrow(_tasks(nodes, pairs), "pair long, side int, print long")

    def join(table: pa.Table) -> pa.Table:
        values = table.column("print").to_numpy().view(np.uint64)
        side = table.column("side").to_numpy()
        a, b = np.sort(values[side == 0]), np.sort(values[side == 1])
        i = int(table.column("pair")[0].as_py())
        same = pairs[i][0] == pairs[i][1]
        links = links_of(a, None if same else b, budget).view(np.int64)
        return pa.table({"a": links[0], "b": links[1]})

    return sent.groupBy("pair").applyInArrow(join, "a long, b long")


def _grouped(df: DataFrame, id_col: str, text_col: str, budget: int, node_size: int) -> tuple[DataFrame, DataFrame]:
    """Stored rows (id, hash of the text, print), and print, root: the component of each fingerprint."""
    columns = (F.col(id_col).cast("long").alias("id"), F.xxhash64(text_or_empty(text_col)).alias("hash"), text_or_empty(text_col).alias("text"))
    rows = stored(df.select(*columns).mapInArrow(_fingerprints, "id long, hash long, print long"), "simhash")
    prints = stored(rows.select("print").distinct(), "simhash_distinct")
    roots = components(fingerprint_links(prints, budget, node_size)).withColumnRenamed("node", "print")
    return rows, prints.join(roots, "print", "left").select("print", F.coalesce("root", "print").alias("root"))


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = MAX_DIFFERENT, node_size: int = NODE_SIZE
) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id: a row for each row of `df`.

    A component is what links of `budget` bits or fewer connect; its id is the smallest id in it
    (missing ids do not count). Texts without words, missing ones too, have fingerprint zero and
    are linked by it. Copies share a fingerprint, so only distinct ones are joined.
    """
    rows, rooted = _grouped(df, id_col, text_col, budget, node_size)
    rooted = rooted.join(rows.groupBy("print").agg(F.min("id").alias("least")), "print")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    return rows.join(named, "print").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, rows: DataFrame, rooted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The first row of `df` in each group: `rows` has id, hash and print of each, `rooted` the root of each print."""
    order = F.struct(F.col("id").isNull().alias("_no_key"), F.coalesce("id", F.lit(-1)).alias("_key"), "hash")
    least = rows.groupBy("print").agg(F.min(order).alias("first"))
    keep = least.join(rooted, "print").groupBy("root").agg(F.min("first").alias("first")).select("first.*").withColumnRenamed("hash", "_hash")
    keys = ["_no_key", "_key", "_hash"]
    keyed = df.withColumns(
        {"_no_key": F.col(id_col).isNull(), "_key": F.coalesce(F.col(id_col).cast("long"), F.lit(-1)), "_hash": F.xxhash64(text_or_empty(text_col))}
    )
    nth = F.row_number().over(Window.partitionBy(keys).orderBy(F.lit(1)))
    return keyed.join(keep, keys, "left_semi").withColumn("_nth", nth).where("_nth = 1").drop(*keys, "_nth")


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = MAX_DIFFERENT, node_size: int = NODE_SIZE
) -> DataFrame:
    """The first row of each component, with all its columns: that with the smallest id.

    Missing ids come last. Of repeated rows one stays.
    """
    rows, rooted = _grouped(df, id_col, text_col, budget, node_size)
    return keep_first(df, rows, rooted, id_col, text_col)
