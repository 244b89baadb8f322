"""Exact top-k inner products with M-trees, searched best first.

Vectors are dealt into blocks of bounded size and each block becomes an M-tree:
pages of routing objects with covering radii and parent distances above pages
of vectors with parent distances. Inner product isn't a metric, so a tree holds
each vector with one more coordinate that gives all of a block the same length
``L``; a query gets 0 there. Then ``distance**2 = |q|**2 + L**2 - 2 q.x`` orders
vectors as the inner product does.

Every group of queries meets every tree, by a cartesian product of the two
written tables: no copies of queries are shuffled or broadcast, whatever their
number. A search opens pages in the order of their least possible distance and
leaves out entries whose stored parent distance already rules them out, before
their distance is computed. Trees that a task meets later are searched only for
what may be among the best of those before.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismcube.llm.common import written

#: Vectors of a tree, of a leaf page, and entries of a page above.
BLOCK = 8192
LEAF = 1024
FANOUT = 16
#: Queries of a group, or a few more: those of its last tree stay together.
QUERIES = 4096
#: Components are floored after multiplication by this.
SCALE = 64
#: Where a NULL id stands among ties: last.
NO_ID = np.iinfo(np.int64).max

RESULT = "query_block long, query_place long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Page:
    """A page of routing objects with their ``children``, or of the vectors from ``begin`` to ``end``.

    Vectors of a page stand in the order of their distances to the page's
    routing object, so those that a bound leaves over are a slice.
    """

    objects: np.ndarray  # places of the routing objects
    parent_distances: np.ndarray | None  # None in the root, which has no routing object
    radii: np.ndarray | None = None
    children: list[int] | None = None
    begin: int = 0
    end: int = 0


class MTree:
    """An M-tree over the rows of ``vectors`` with ids ``ids``, which are put into the order of its pages."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        squares = (vectors * vectors).sum(axis=1)
        self.length2 = float(squares.max()) if len(squares) else 0.0
        self.vectors = vectors
        self.lift = np.sqrt(np.maximum(self.length2 - squares, 0))
        self.pages: list[Page] = []
        self._order: list[np.ndarray] = []
        self._placed = 0
        self.root = self._build(np.arange(len(ids)), None)
        order = np.concatenate(self._order)
        del self._order
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.ids, self.vectors, self.lift = ids[order], vectors[order], self.lift[order]
        self.pages = [replace(p, objects=place[p.objects]) for p in self.pages]

    def _distances(self, to: int, places: np.ndarray) -> np.ndarray:
        """Distances of vectors of the block to one of them."""
        apart = self.vectors[places] - self.vectors[to]
        lifted = self.lift[places] - self.lift[to]
        return np.sqrt((apart * apart).sum(axis=1) + lifted * lifted)

    def _build(self, places: np.ndarray, routing: int | None) -> int:
        """Add the pages of ``places`` below a routing object and return the topmost one."""
        from_parent = None if routing is None else self._distances(routing, places)
        if len(places) <= LEAF:
            if from_parent is not None:
                order = np.argsort(from_parent, kind="stable")
                places, from_parent = places[order], from_parent[order]
            self._order.append(places)
            begin = self._placed
            self._placed += len(places)
            self.pages.append(Page(places, from_parent, begin=begin, end=self._placed))
            return len(self.pages) - 1
        # Routing objects far from one another: each next one is the farthest from those before.
        chosen = [0]
        nearest = self._distances(places[0], places)
        owner = np.zeros(len(places), dtype=np.int64)
        while len(chosen) < FANOUT and nearest.max() > 0:
            far = int(nearest.argmax())
            distances = self._distances(places[far], places)
            owner[distances < nearest] = len(chosen)
            nearest = np.minimum(nearest, distances)
            chosen.append(far)
        if len(chosen) == 1:  # equal vectors: cut anywhere
            owner = np.arange(len(places)) * FANOUT // len(places)
            chosen = [int(np.flatnonzero(owner == k)[0]) for k in range(FANOUT)]
        children, radii = [], []
        for k, first in enumerate(chosen):
            own = owner == k
            radii.append(float(nearest[own].max()))
            children.append(self._build(places[own], int(places[first])))
        at = np.array(chosen)
        self.pages.append(Page(places[at], None if from_parent is None else from_parent[at], np.array(radii), children))
        return len(self.pages) - 1

    def search(self, query: np.ndarray, k: int, own: int | None = None, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` highest inner products of ``floor`` or more, ties to smaller ids; ``own`` is left out."""
        squares = float(query @ query) + self.length2
        slack = 1e-7 * (1 + np.sqrt(squares))
        best_ids, best_scores = np.zeros(0, dtype=np.int64), np.zeros(0)
        # Beyond which nothing can be among the k.
        worst, least_score = float(np.sqrt(max(squares - 2 * floor, 0))), floor
        waiting: list[tuple[float, int, float]] = [(0.0, self.root, np.nan)]
        while waiting:
            least, number, to_routing = heapq.heappop(waiting)
            if least > worst + slack:
                break
            page = self.pages[number]
            if page.children is None:
                begin, end = page.begin, page.end
                if page.parent_distances is not None and worst < np.inf:
                    # Others are farther from the query than their distances to the routing object allow.
                    around = np.searchsorted(page.parent_distances, (to_routing - worst - slack, to_routing + worst + slack))
                    begin, end = begin + int(around[0]), begin + int(around[1])
                scores = self.vectors[begin:end] @ query
                wanted = np.flatnonzero(scores >= least_score)
                if own is not None:
                    wanted = wanted[wanted != own - begin]
                if len(wanted):
                    ids = np.concatenate((best_ids, self.ids[begin + wanted]))
                    both = np.concatenate((best_scores, scores[wanted]))
                    order = np.lexsort((ids, -both))[:k]
                    best_ids, best_scores = ids[order], both[order]
                    if len(best_scores) == k:
                        least_score = best_scores[-1]
                        worst = float(np.sqrt(max(squares - 2 * least_score, 0)))
                continue
            objects, radii, children = page.objects, page.radii, page.children
            keep = np.arange(len(objects))
            if page.parent_distances is not None and worst < np.inf:
                keep = np.flatnonzero(np.abs(to_routing - page.parent_distances) - radii <= worst + slack)
                objects = objects[keep]
            distances = np.sqrt(np.maximum(squares - 2 * (self.vectors[objects] @ query), 0))
            bounds = np.maximum(distances - radii[keep], 0)
            near = np.flatnonzero(bounds <= worst + slack)
            for i, bound, distance in zip(keep[near].tolist(), bounds[near].tolist(), distances[near].tolist(), strict=True):
                heapq.heappush(waiting, (bound, children[i], distance))
        return best_ids, best_scores


def scaled(vectors: list[list[float]]) -> np.ndarray:
    """Floored multiples of the components as rows; shorter vectors end in zeros."""
    wide = max(map(len, vectors), default=0)
    rows = np.zeros((len(vectors), wide))
    for row, v in zip(rows, vectors, strict=True):
        row[: len(v)] = v
    return np.floor(SCALE * rows)


def _trees(block: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        vectors: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            tree = MTree(np.array(ids, dtype=np.int64), scaled(vectors))
            return pa.RecordBatch.from_pydict({"block": [part << 32 | seq], "tree": [pickle.dumps(tree)]})

        for batch in batches:
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                ids.append(NO_ID if vec_id is None else vec_id)
                vectors.append(vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if len(ids) == block:
                    yield close()
                    seq, ids, vectors = seq + 1, [], []
        if ids:
            yield close()

    return each


def _widened(vectors: np.ndarray, wide: int) -> np.ndarray:
    """The rows, ended with zeros."""
    return np.pad(vectors, ((0, 0), (0, max(0, wide - vectors.shape[1]))))


def _queries(every: int, group: int):
    """The rows of the trees that are queries: groups of ``group`` or a few more as one row, with each one's tree and place."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def close() -> pa.RecordBatch:
            wide = max(vectors.shape[1] for *_, vectors in held)
            blocks, places, ids, vectors = zip(*held, strict=True)
            rows = np.concatenate([_widened(v, wide) for v in vectors])
            packed = pickle.dumps((np.concatenate(blocks), np.concatenate(places), np.concatenate(ids), rows))
            return pa.RecordBatch.from_pydict({"query_group": [int(blocks[0][0])], "queries": [packed]})

        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("tree").to_pylist(), strict=True):
                tree = pickle.loads(packed)
                own = np.flatnonzero((tree.ids % every == 0) & (tree.ids != NO_ID))
                if len(own):
                    held.append((np.full(len(own), block), own, tree.ids[own], tree.vectors[own]))
                if sum(len(h[0]) for h in held) >= group:
                    yield close()
                    held = []
        if held:
            yield close()

    return each


def _search(k: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The highest scores of each query in the trees that this task met, by group of queries.
        highest: dict[int, np.ndarray] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "tree", "query_group", "queries"))
            for block, packed, group, queries in zip(*columns, strict=True):
                tree = pickle.loads(packed)
                blocks, places, query_ids, vectors = pickle.loads(queries)
                wide = tree.vectors.shape[1]
                best = highest.setdefault(group, np.full((len(places), k), -np.inf))
                rows = []
                for i, query in enumerate(_widened(vectors, wide)):
                    # Components beyond the tree's meet zeros only.
                    ids, scores = tree.search(query[:wide], k, int(places[i]) if block == blocks[i] else None, best[i, -1])
                    best[i] = -np.sort(-np.concatenate((best[i], scores)))[:k]
                    rows.append((np.full(len(ids), blocks[i]), np.full(len(ids), places[i]), np.full(len(ids), query_ids[i]), ids, scores.astype(np.int64)))
                of, at, query, ids, scores = (np.concatenate(c) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(of), pa.array(at), pa.array(query), pa.array(ids, mask=ids == NO_ID), pa.array(scores)],
                    ["query_block", "query_place", "query_id", "vec_id", "score"],
                )

    return each


def top_products(vectors: DataFrame, every: int = 20, k: int = 20, block: int = BLOCK, group: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of each query among all other rows.

    Queries are the rows of ``vec_id, embedding`` whose id is divisible by
    ``every``. Components become ``floor(64 * x)``; the score is the inner
    product, exact while its parts stay below 2**53. Ties go to smaller ids, a
    NULL id last. Vectors that are NULL or hold a NULL, NaN or infinity take no
    part; shorter vectors, empty ones too, count as ending in zeros. Rows
    with one id are separate queries.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    valid = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("embedding")).where(
        F.col("embedding").isNotNull() & finite
    )
    blocks = max(1, -(-valid.count() // block))
    trees = written(valid.repartition(blocks).mapInArrow(_trees(block), "block long, tree binary"), "trees")
    queries = written(trees.mapInArrow(_queries(every, group), "query_group long, queries binary"), "queries")
    # Every group of queries meets every tree. Without the hint the queries, small by Spark's estimate, may go through the driver.
    pairs = trees.hint("shuffle_replicate_nl").crossJoin(queries)
    found = pairs.mapInArrow(_search(k), RESULT)
    order = Window.partitionBy("query_block", "query_place").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = """
with parts as (
  select row_number() over () as row, vec_id, embedding from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scaled as (
  select row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from parts
), scored as (
  select q.row as query_row, q.vec_id as query_id, c.vec_id,
         list_inner_product(q.v, c.v)::bigint as score
  from scaled q join scaled c on q.row <> c.row where q.vec_id % 20 = 0
), ranked as (
  select query_id, vec_id, score,
         row_number() over (partition by query_row order by score desc, vec_id nulls last)::int as rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""
