"""Hard negatives by Strassen products of anchor and candidate tiles.

Vectors are packed into blocks of bounded size as int64 matrices. A tile is a
block of anchors times a block of candidates, multiplied by Strassen's
recursion: seven half-size products instead of eight, with sums and differences
of quarters, all in exact integers, where an odd side is padded with a row or
column of zeros. Below ``LEAF`` the product is numpy's.

Of a tile each anchor keeps a heap of its best rows of its own label, and the
heaps of tiles merge into the anchor's positives. A second pass over the tiles
keeps, per positive, a heap of the best rows of other labels whose score lies in
the positive's window; those heaps merge alike. Heaps are merged in the task
that made them before they are shuffled.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prismcube.llm.common import written

#: Rows of a block of anchors and of a block of candidates.
ANCHORS, CANDIDATES = 512, 4096
#: Components of blocks: longer vectors make blocks of fewer rows.
COMPONENTS = 1 << 19
#: A product with a side of at most so many isn't halved any more.
LEAF = 64
#: Components are floored after multiplication by this; beyond the bound they are cut, so that sums stay exact.
SCALE, BOUND = 256, 1 << 24
#: Where a NULL id stands among ties: last.
NO_ID = np.iinfo(np.int64).max
#: A negative's score is at least this share of the positive's, as numerator and denominator.
LEAST = (4, 5)

BLOCK = "part int, block long, rows binary"
POSITIVE = "block long, place int, anchor_id long, vec_id long, score long"
NEGATIVE = "block long, place int, positive int, anchor_id long, positive_id long, vec_id long, positive_score long, score long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    if rows % 2 or inner % 2 or columns % 2:
        a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
        b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
        return strassen(a, b, leaf)[:rows, :columns]
    r, i, c = rows // 2, inner // 2, columns // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((rows, columns), dtype=np.int64)
    out[:r, :c] = m1 + m4 - m5 + m7
    out[:r, c:] = m3 + m5
    out[r:, :c] = m2 + m4
    out[r:, c:] = m1 - m2 + m3 + m6
    return out


def scaled(vectors: list[np.ndarray]) -> np.ndarray:
    """Floored multiples of the components as int64 rows; shorter vectors end in zeros."""
    wide = max(map(len, vectors), default=0)
    rows = np.zeros((len(vectors), wide))
    for row, v in zip(rows, vectors, strict=True):
        row[: len(v)] = v
    return np.clip(np.floor(SCALE * rows), -BOUND, BOUND).astype(np.int64)


def _blocks(anchors: int, candidates: int, every: int):
    """The candidates of a partition in blocks, and its anchors (``part`` NULL) in blocks of their own."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: dict[bool, list[tuple[int, int, np.ndarray]]] = {True: [], False: []}
        taken = {True: 0, False: 0}

        def close(of_anchors: bool) -> pa.RecordBatch:
            nonlocal seq
            ids, labels, vectors = zip(*held[of_anchors], strict=True)
            # Each row keeps its place among all candidates, by which an anchor knows itself.
            packed = pickle.dumps((np.array(ids), np.array(labels), scaled(vectors), np.array(places[of_anchors])))
            held[of_anchors], places[of_anchors], taken[of_anchors] = [], [], 0
            seq += 1
            row = [pa.array([None if of_anchors else part], pa.int32()), pa.array([part << 32 | seq]), pa.array([packed], pa.binary())]
            return pa.RecordBatch.from_arrays(row, ["part", "block", "rows"])

        places: dict[bool, list[int]] = {True: [], False: []}
        most, number = {True: anchors, False: candidates}, 0
        for batch in batches:
            columns = (batch.column(c) for c in ("vec_id", "label", "embedding"))
            for vec_id, label, vector in zip(*columns, strict=True):
                row = (NO_ID if vec_id.as_py() is None else vec_id.as_py(), label.as_py(), vector.values.to_numpy(zero_copy_only=False))
                for of_anchors in (False, True):
                    if of_anchors and (row[0] == NO_ID or row[0] % every):
                        continue
                    held[of_anchors].append(row)
                    places[of_anchors].append(part << 32 | number)
                    taken[of_anchors] += len(row[2])
                    if len(held[of_anchors]) == most[of_anchors] or taken[of_anchors] > COMPONENTS:
                        yield close(of_anchors)
                number += 1
        for of_anchors in (False, True):
            if held[of_anchors]:
                yield close(of_anchors)

    return each


def tile_scores(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows; components that one side lacks meet zeros."""
    wide = max(anchors.shape[1], candidates.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (anchors, candidates))
    return strassen(a, b.T)


def best(scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest wanted scores, ties to smaller ids."""
    at = np.flatnonzero(wanted)
    if len(at) > 4 * k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


class Heaps:
    """The best ``(score, id)`` of each key, merged as tiles come."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.held: dict[object, tuple[np.ndarray, np.ndarray]] = {}

    def push(self, key: object, ids: np.ndarray, scores: np.ndarray) -> None:
        if key in self.held:
            ids, scores = np.concatenate((self.held[key][0], ids)), np.concatenate((self.held[key][1], scores))
            order = np.lexsort((ids, -scores))[: self.k]
            ids, scores = ids[order], scores[order]
        if len(ids):
            self.held[key] = (ids, scores)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list]]:
    """The tiles of a partition: number of the anchors' block, the anchors, the candidates."""
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "rows", "candidates"))
        for block, anchors, candidates in zip(*columns, strict=True):
            yield block, pickle.loads(anchors), pickle.loads(candidates)


def _id_array(ids: list[int]) -> pa.Array:
    array = np.array(ids, dtype=np.int64)
    return pa.array(array, mask=array == NO_ID)


def _positives(k: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, now = Heaps(k), None

        def rows() -> pa.RecordBatch:
            keys = [(key, len(ids)) for key, (ids, _) in heaps.held.items()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([block for (block, _, _), n in keys for _ in range(n)], pa.int64()),
                    pa.array([place for (_, place, _), n in keys for _ in range(n)], pa.int32()),
                    pa.array([anchor for (_, _, anchor), n in keys for _ in range(n)], pa.int64()),
                    _id_array([i for ids, _ in heaps.held.values() for i in ids.tolist()]),
                    pa.array([s for _, scores in heaps.held.values() for s in scores.tolist()], pa.int64()),
                ],
                [part.split()[0] for part in POSITIVE.split(", ")],
            )

        for block, (anchor_ids, anchor_labels, anchors, anchor_places), (ids, labels, candidates, places) in _tiles(batches):
            if now != block and heaps.held:
                yield rows()
                heaps = Heaps(k)
            now = block
            scores = tile_scores(anchors, candidates)
            for place, (anchor, label, own) in enumerate(zip(anchor_ids.tolist(), anchor_labels.tolist(), anchor_places.tolist(), strict=True)):
                found = best(scores[place], ids, (labels == label) & (places != own), k)
                heaps.push((block, place, anchor), ids[found], scores[place][found])
        if heaps.held:
            yield rows()

    return each


def _negatives(k: int):
    above, below = LEAST

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, now = Heaps(k), None

        def rows() -> pa.RecordBatch:
            keys = [(key, len(ids)) for key, (ids, _) in heaps.held.items()]
            block, place, positive, anchor, positive_id, positive_score = zip(*(key for key, n in keys for _ in range(n)), strict=True)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(block, pa.int64()),
                    pa.array(place, pa.int32()),
                    pa.array(positive, pa.int32()),
                    pa.array(anchor, pa.int64()),
                    _id_array(list(positive_id)),
                    _id_array([i for ids, _ in heaps.held.values() for i in ids.tolist()]),
                    pa.array(positive_score, pa.int64()),
                    pa.array([s for _, scores in heaps.held.values() for s in scores.tolist()], pa.int64()),
                ],
                [part.split()[0] for part in NEGATIVE.split(", ")],
            )

        for block, (anchor_ids, anchor_labels, anchors, windows), (ids, labels, candidates, _) in _tiles(batches):
            if now != block and heaps.held:
                yield rows()
                heaps = Heaps(k)
            now = block
            scores = tile_scores(anchors, candidates)
            for place, (anchor, label) in enumerate(zip(anchor_ids.tolist(), anchor_labels.tolist(), strict=True)):
                other = labels != label
                for positive, (positive_id, most) in enumerate(windows[place]):
                    least = -(-above * most // below)
                    found = best(scores[place], ids, other & (scores[place] >= least) & (scores[place] <= most), k)
                    heaps.push((block, place, positive, anchor, positive_id, most), ids[found], scores[place][found])
        if heaps.held:
            yield rows()

    return each


def _with_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of anchors with each anchor's positives in place of its own place."""
    for batch in batches:
        for block, packed, found in zip(*(batch.column(c).to_pylist() for c in ("block", "rows", "found")), strict=True):
            ids, labels, vectors, _ = pickle.loads(packed)
            windows: list[list[tuple[int, int]]] = [[] for _ in ids]
            for p in sorted(found, key=lambda p: (p["place"], p["rank"])):
                windows[p["place"]].append((NO_ID if p["vec_id"] is None else p["vec_id"], p["score"]))
            keep = [i for i, w in enumerate(windows) if w]
            rows = pickle.dumps((ids[keep], labels[keep], vectors[keep], [windows[i] for i in keep]))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([rows], pa.binary())], ["block", "rows"])


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, anchors: int = ANCHORS, candidates: int = CANDIDATES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Reads ``vec_id, embedding, label``. Rows with a NULL label, a NULL vector,
    or a NULL, NaN or infinity in it take no part. Anchors are the rows whose
    id is divisible by ``every``; rows with one id are anchors of their own.
    A row's score is its inner product with the anchor, of components that
    become ``floor(256 * x)`` and are cut at ``BOUND`` on either side; shorter
    vectors, empty ones too, count as ending in zeros. Ties go to smaller ids,
    a NULL id last. The positives are an anchor's best other rows of its
    label, the negatives of each the best rows of other labels that score
    between four fifths of the positive and the positive.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.cast("array<double>").alias("embedding")
    )
    valid = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    size = valid.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("embedding")), F.lit(0)).alias("components")).first()
    parts = max(1, -(-size["rows"] // candidates), -(-size["components"] // COMPONENTS))
    blocks = written(valid.repartition(parts).mapInArrow(_blocks(anchors, candidates, every), BLOCK), "vector-blocks")
    of_anchors = blocks.where("part is null").select("block", "rows")
    of_candidates = blocks.where("part is not null").select("part", F.col("rows").alias("candidates"))
    parts_array = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")

    def tiles(sides: DataFrame) -> DataFrame:
        # Every block of anchors meets every part of the candidates; a task has the tiles of a block of anchors in a row.
        paired = sides.select("block", "rows", parts_array).hint("merge").join(of_candidates, "part")
        return paired.select("block", "rows", "candidates")

    tops = tiles(of_anchors).mapInArrow(_positives(positives), POSITIVE)
    order = (F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = tops.withColumn("rank", F.row_number().over(Window.partitionBy("block", "place").orderBy(*order))).where(F.col("rank") <= positives)
    found = written(ranked.groupBy("block").agg(F.collect_list(F.struct("place", "rank", "vec_id", "score")).alias("found")), "positives")
    windows = written(
        of_anchors.join(found, "block").select("block", "rows", "found").mapInArrow(_with_windows, "block long, rows binary"), "anchor-windows"
    )
    near = tiles(windows).mapInArrow(_negatives(negatives), NEGATIVE)
    each = Window.partitionBy("block", "place", "positive").orderBy(*order)
    best_ = near.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= negatives)
    return best_.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def with_wrong_labels(vectors: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """The label of each row whose id is divisible by ``every`` moved on by one, as wrong labels to mine around."""
    wrong = (F.col("label") + 1) % labels
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % every == 0, wrong).otherwise(F.col("label")).alias("label"))


ORACLE = """
with parts as (
  select row_number() over () as row, vec_id, embedding,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scaled as (
  select row, vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from parts
), scored as (
  select q.row as anchor_row, q.vec_id as anchor_id, q.label = c.label as same, c.row, c.vec_id,
         list_inner_product(q.v, c.v)::bigint as score
  from scaled q join scaled c on q.row <> c.row where q.vec_id % 100 = 0
), positives as (
  select anchor_row, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_row order by score desc, vec_id nulls last) as positive
  from scored where same
), near as (
  select p.anchor_row, p.positive, p.anchor_id, p.positive_id, p.positive_score, n.vec_id as negative_id, n.score as negative_score,
         row_number() over (partition by p.anchor_row, p.positive order by n.score desc, n.vec_id nulls last)::int as rank
  from positives p join scored n on p.anchor_row = n.anchor_row
  where p.positive <= 5 and not n.same
    and 80 * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from near where rank <= 5
"""
