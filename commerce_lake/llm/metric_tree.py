"""Exact search for the highest inner products, by an M-tree.

A further coordinate, sqrt(M^2 - |x|^2) for a vector and 0 for a query, gives all vectors the norm
M, so that the nearest ones by Euclidean distance are those with the highest inner product. The
tree over these points consists of pages, rows of a table. Each has a router, a covering radius
and the distance to its parent's router; a leaf holds vectors with their distances to its router.

The root's routers come from a bounded sample. Every vector goes to the nearest one, and a router
with many of them gets several subtrees, each of a bounded number of vectors and built by one
task. A query first searches one subtree near it. Its last place there then decides which others
it is sent to, and in them it opens pages nearest first. Stored distances give bounds by the
triangle inequality, so most routers and vectors that cannot matter are never compared. The bounds
are distances; the scores themselves are exact integers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commerce_lake.llm.common import slices, stored
from commerce_lake.llm.vectors import finite, matrix

SCALE = 1024
BEST = 10
QUERY_STEP = 100
ROUTE_SAMPLE = 1024
ROUTES = 64
ROUTE_ROWS = 2048
SUBTREE_ROWS = 16_384
PAGE_ROWS = 128
FANOUT = 16
QUERY_BLOCK = 8192
# Bounds are compared as squares with this share of the squared norms to spare for rounding.
SLACK = 1e-9
_NO_ID = (1 << 63) - 1

PAGE_SCHEMA = (
    "tree int, page int, parent int, distance double, radius double, router array<double>, "
    "vectors array<long>, ids array<array<long>>, distances array<double>"
)
_HIT_SCHEMA = "vno long, id long, score long"


@dataclass(frozen=True)
class MTree:
    """The pages of all subtrees, and the root page: its routers, their radii, first subtrees and numbers of them."""

    pages: DataFrame
    dims: int
    square: float
    routers: np.ndarray
    radii: np.ndarray
    first: np.ndarray
    subtrees: np.ndarray


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    """Integer rows as points of squared norm `square`."""
    points = x.astype(np.float64)
    rest = np.maximum(square - np.einsum("ij,ij->i", points, points), 0.0)
    return np.hstack([points, np.sqrt(rest)[:, None]])


def _distances(points: np.ndarray, router: np.ndarray) -> np.ndarray:
    return np.linalg.norm(points - router, axis=1)


def _nearest(points: np.ndarray, routers: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", routers, routers) - 2 * points @ routers.T).argmin(axis=1)


def _spread(points: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other, each the farthest from those before it."""
    chosen = [0]
    apart = _distances(points, points[0])
    while len(chosen) < count and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, _distances(points, points[chosen[-1]]))
    return np.array(chosen)


def grow(
    tree: int, x: np.ndarray, ids: list[list[int]], router: np.ndarray, square: float, page_rows: int = PAGE_ROWS, fanout: int = FANOUT
) -> list[tuple]:
    """The pages of a subtree over the rows of `x`, as rows of PAGE_SCHEMA; page 0 is its root."""
    points, pages = lifted(x, square), []
    rng = np.random.default_rng(len(x))
    open_pages = [(np.arange(len(x)), router, -1, 0.0)]
    while open_pages:
        rows, router, parent, distance = open_pages.pop()
        apart = _distances(points[rows], router)
        order = np.argsort(apart, kind="stable")
        rows, apart = rows[order], apart[order]
        page = len(pages)
        head = (tree, page, parent, distance, float(apart[-1]), router)
        if len(rows) <= page_rows:
            pages.append((*head, x[rows].ravel(), [ids[k] for k in rows], apart))
            continue
        pages.append((*head, None, None, None))
        chosen = rng.choice(len(rows), min(fanout, -(-len(rows) // page_rows)), replace=False)
        near = _nearest(points[rows], points[rows[chosen]])
        groups = [rows[near == k] for k in range(len(chosen))]
        if max(map(len, groups)) > 0.9 * len(rows):
            groups = np.array_split(rows, len(chosen))
            chosen = [np.flatnonzero(rows == g[0])[0] for g in groups]
        for group, k in zip(groups, chosen):
            if len(group):
                inner = points[rows[k]]
                open_pages.append((group, inner, page, float(np.linalg.norm(inner - router))))
    return pages


def _padded(df: DataFrame, dims: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(dims) - F.size("x")))
    return df.withColumn("x", F.concat("x", zeros))


def build(vectors: DataFrame, keep: int = BEST + 1) -> MTree:
    """The tree over `vectors` (id long, x array<long>), stored page by page.

    Equal vectors are one entry with the `keep` smallest of their ids, which is all that a search
    for so many can return. Shorter vectors end with zeros.
    """
    squares = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    n, dims, most = vectors.agg(F.count("*"), F.max(F.size("x")), F.max(squares)).first()
    dims, square = dims or 0, float(np.ceil((most or 0.0) * (1 + 1e-12)))
    nth = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    distinct = _padded(vectors, dims).withColumn("nth", nth).where(F.col("nth") <= keep)
    entries = stored(distinct.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")

    sample = entries.select("x").orderBy(F.xxhash64("x"), "x").limit(ROUTE_SAMPLE).collect()
    points = lifted(np.array([r["x"] for r in sample], np.int64).reshape(len(sample), dims), square)
    routers = points[_spread(points, min(ROUTES, -(-n // ROUTE_ROWS)))] if len(points) else points

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = lifted(matrix(batch.column("x"), dims), square)
            route = _nearest(rows, routers)
            apart = np.linalg.norm(rows - routers[route], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(route, pa.int32()), pa.array(apart)], ["x", "ids", "route", "apart"])

    routed = stored(entries.mapInArrow(assign, "x array<long>, ids array<long>, route int, apart double"), "routed")
    sizes = {r["route"]: r for r in routed.groupBy("route").agg(F.count("*").alias("n"), F.max("apart").alias("radius")).collect()}
    subtrees = np.array([-(-sizes[k]["n"] // SUBTREE_ROWS) if k in sizes else 0 for k in range(len(routers))], np.int64)
    radii = np.array([sizes[k]["radius"] if k in sizes else 0.0 for k in range(len(routers))])
    first = np.concatenate([[0], np.cumsum(subtrees)])[:-1] if len(subtrees) else subtrees
    firsts, counts = (F.array(*(F.lit(int(v)) for v in a)).cast("array<int>") for a in (first, subtrees))
    tree = F.get(firsts, F.col("route")) + F.pmod(F.xxhash64("x"), F.get(counts, F.col("route"))).cast("int")

    page_rows, fanout = PAGE_ROWS, FANOUT

    def pages_of(table: pa.Table) -> pa.Table:
        x = matrix(table.column("x").combine_chunks(), dims)
        route = int(table.column("route")[0].as_py())
        rows = grow(int(table.column("tree")[0].as_py()), x, table.column("ids").to_pylist(), routers[route], square, page_rows, fanout)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _PAGE_TYPES)], _PAGE_NAMES)

    grouped = routed.withColumn("tree", tree).groupBy("tree") if len(routers) else routed.withColumn("tree", F.lit(0)).groupBy("tree")
    pages = stored(grouped.applyInArrow(pages_of, PAGE_SCHEMA), "pages")
    return MTree(pages, dims, square, routers, radii, first, subtrees)


_PAGE_NAMES = [part.split()[0] for part in PAGE_SCHEMA.split(", ")]
_LONGS, _DOUBLES = pa.list_(pa.int64()), pa.list_(pa.float64())
_PAGE_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), _DOUBLES, _LONGS, pa.list_(_LONGS), _DOUBLES]


def _parts(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


class Subtree:
    """The pages of one subtree in a task. `compared` counts the vectors and routers compared with a query."""

    def __init__(self, table: pa.Table, dims: int, square: float):
        self.square, self.compared = square, 0
        table = table.sort_by("page")
        plain = lambda name: table.column(name).to_numpy()
        lists = {name: _parts(table.column(name).combine_chunks()) for name in ("router", "vectors", "distances")}
        routers, radii, distances = np.array(lists["router"]), plain("radius"), plain("distance")
        below: dict[int, list[int]] = {}
        for page, parent in enumerate(plain("parent").tolist()):
            below.setdefault(parent, []).append(page)
        self.root = float(radii[0]), routers[0]
        self.inner, self.leaves = {}, {}
        self.largest = 0
        for page, ids in enumerate(table.column("ids").to_pylist()):
            if ids is None:
                at = np.array(below[page])
                self.inner[page] = at, routers[at], radii[at], distances[at]
            else:
                x = lists["vectors"][page].reshape(len(ids), dims)
                self.largest = max(self.largest, int(x.max(initial=0)), -int(x.min(initial=0)))
                self.leaves[page] = x, ids, lists["distances"][page]

    def _scores(self, x: np.ndarray, query: np.ndarray, most: int) -> np.ndarray:
        self.compared += len(x)
        if most * self.largest * max(1, len(query)) < 2**63:
            return x @ query
        out = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in x]
        if any(abs(s) >= 2**63 for s in out):
            raise OverflowError("an inner product does not fit in 64 bits")
        return np.array(out, np.int64)

    def search(self, query: np.ndarray, k: int, bound: int | None) -> list[tuple[int, int]]:
        """Up to k pairs (score, id), best first, of score `bound` or more; equal scores by id."""
        point = np.append(query.astype(np.float64), 0.0)
        both = float(point @ point) + self.square
        spare = SLACK * both
        most = max(int(query.max(initial=0)), -int(query.min(initial=0)))
        # squared distance beyond which nothing counts, spare included
        reach = both - 2.0 * bound + spare if bound is not None else np.inf
        best: list[tuple[int, int]] = []
        radius, router = self.root
        apart = float(np.linalg.norm(point - router))
        waiting = [(max(0.0, apart - radius), 0, apart)]
        while waiting:
            low, page, apart = heapq.heappop(waiting)
            if low * low > reach:
                break
            if page in self.inner:
                below, routers, radii, distances = self.inner[page]
                may = np.maximum(np.abs(apart - distances) - radii, 0.0) ** 2 <= reach
                self.compared += int(may.sum())
                apart_each = _distances(routers[may], point)
                low_each = np.maximum(apart_each - radii[may], 0.0)
                for child, least, d in zip(below[may].tolist(), low_each.tolist(), apart_each.tolist()):
                    if least * least <= reach:
                        heapq.heappush(waiting, (least, child, d))
                continue
            x, ids, distances = self.leaves[page]
            may = np.flatnonzero((apart - distances) ** 2 <= reach)
            scores = self._scores(x[may], query, most)
            for j in np.flatnonzero(scores >= bound) if bound is not None else range(len(may)):
                score = int(scores[j])
                if bound is not None and score < bound:
                    continue
                for i in ids[may[j]]:
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                    else:
                        break
                if len(best) == k and (bound is None or best[0][0] > bound):
                    bound = best[0][0]
                    reach = both - 2.0 * bound + spare
        return [(score, -i) for score, i in sorted(best, reverse=True)]


def _hits(pages: DataFrame, queries: DataFrame, tree: MTree, k: int, blocks: int) -> DataFrame:
    """vno, id, score: what each query (tree, vno, x, bound) finds in the subtree it is sent to."""
    dims, square = tree.dims, tree.square

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            subtree = Subtree(left, dims, square)
            rows = matrix(right.column("x").combine_chunks(), dims)
            for vno, x, bound in zip(right.column("vno").to_pylist(), rows, right.column("bound").to_pylist()):
                out += [(vno, i, score) for score, i in subtree.search(x, k, bound)]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((), (), ()))], ["vno", "id", "score"])

    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vno"), F.lit(blocks)).cast("int"))
    each = pages.withColumn("block", F.explode(numbers))
    return each.groupBy("tree", "block").cogroup(dealt.groupBy("tree", "block")).applyInArrow(look, _HIT_SCHEMA)


def _best(hits: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("vno").orderBy(F.desc("score"), "id"))
    return hits.withColumn("nth", nth).where(F.col("nth") <= k)


def search(tree: MTree, queries: DataFrame, k: int = BEST) -> DataFrame:
    """vno, id, score, nth: the k best rows for each of `queries` (vno long, x array<long>), numbered from 1."""
    routers, radii, first, subtrees, dims, square = tree.routers, tree.radii, tree.first, tree.subtrees, tree.dims, tree.square
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            points = np.hstack([matrix(batch.column("x"), dims).astype(np.float64), np.zeros((batch.num_rows, 1))])
            near = _nearest(points, routers[subtrees > 0])
            near = np.flatnonzero(subtrees > 0)[near]
            home = first[near] + batch.column("vno").to_numpy() % subtrees[near]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32())], ["vno", "x", "home"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The subtrees that may hold more, by the radii of the root page."""
        for batch in slices(batches):
            x = matrix(batch.column("x"), dims).astype(np.float64)
            points = np.hstack([x, np.zeros((len(x), 1))])
            both = np.einsum("ij,ij->i", x, x) + square
            out = []
            for point, norm, bound, home in zip(points, both, batch.column("bound").to_pylist(), batch.column("home").to_pylist()):
                low = np.maximum(_distances(routers, point) - radii, 0.0)
                open_routes = np.arange(len(routers)) if bound is None else np.flatnonzero(low**2 <= norm - 2.0 * bound + SLACK * norm)
                out.append([int(t) for r in open_routes for t in range(first[r], first[r] + subtrees[r]) if t != home])
            columns = [batch.column("vno"), batch.column("x"), batch.column("bound"), pa.array(out, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["vno", "x", "bound", "trees"])

    if not subtrees.sum():
        return queries.sparkSession.createDataFrame([], "vno long, id long, score long, nth int")
    at_home = stored(queries.select("vno", "x").mapInArrow(route, "vno long, x array<long>, home int"), "routed_queries")
    alone = at_home.select(F.col("home").alias("tree"), "vno", "x", F.lit(None).cast("long").alias("bound"))
    near = stored(_hits(tree.pages, alone, tree, k, blocks), "near_hits")
    last = near.groupBy("vno").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    sent = at_home.join(last, "vno", "left").select("vno", "x", "bound", "home")
    spread = sent.mapInArrow(others, "vno long, x array<long>, bound long, trees array<int>")
    far = _hits(tree.pages, spread.select(F.explode("trees").alias("tree"), "vno", "x", "bound"), tree, k, blocks)
    return _best(near.unionByName(far), k)


def nearest(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = BEST, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: for each row with an id divisible by `step`, the k other rows of highest score.

    Entries x count as floor(1024 x); the score is the integer inner product, and a smaller id wins
    a tie. Vectors that are null, or hold null or non-finite entries, take no part. Shorter
    vectors end with zeros. Rows without an id are found, after all others of equal score, but are
    no queries. Rows that repeat an id, or are repeated whole, are rows of their own: each is a
    query, and finds the others. A score beyond 64 bits raises OverflowError. Other columns are
    ignored. Equal query vectors are searched once, for one row more than asked for.
    """
    entries = F.transform(vector_col, lambda c: F.floor(c.cast("double") * SCALE))
    ids = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID))
    rows = stored(df.where(finite(vector_col)).select(ids.alias("id"), entries.alias("x")), "vectors")
    tree = build(rows, k + 1)
    asked = _padded(rows.where((F.col("id") % step == 0) & (F.col("id") != _NO_ID)), tree.dims)
    distinct = stored(asked.select("x").distinct().withColumn("vno", F.monotonically_increasing_id()), "queries")
    found = search(tree, distinct, k + 1).groupBy("vno").agg(F.sort_array(F.collect_list(F.struct("nth", "id", "score"))).alias("hits"))
    own = F.aggregate("x", F.lit(0).cast("long"), lambda a, c: a + c * c)
    mine = lambda h: (h["id"] == F.col("id")) & (h["score"] == F.col("own"))
    place = F.coalesce(F.array_min(F.transform(F.filter("hits", mine), lambda h: h["nth"])), F.lit(k + 1))
    others = F.filter("hits", lambda h: h["nth"] != F.col("place"))
    return (
        asked.join(distinct.join(found, "vno").select("x", "hits"), "x")
        .withColumn("own", own)
        .withColumn("place", place)
        .select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, k)).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), F.nullif("hit.id", F.lit(_NO_ID)).alias("vec_id"), F.col("hit.score").alias("score"))
    )
