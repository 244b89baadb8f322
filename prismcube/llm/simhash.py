"""SimHash near-duplicates with covering locality-sensitive hashing.

For radius ``r`` there are ``2**(r+1) - 1`` bit masks, one for each non-zero
vector of ``r + 1`` bits: bit ``i`` has a fixed vector ``m(i)`` and belongs to
the mask of ``v`` if ``m(i)`` and ``v`` have an odd product. Up to ``r``
vectors never span the whole space, so some ``v`` is orthogonal to those of
all differing bits, and the two fingerprints agree under its mask: every pair
within the radius collides in some table, not just most pairs.

Copies collapse to one fingerprint first. A bucket is read as a sorted run and
yields a spanning forest of its links, never all of its pairs; a bucket too
large for that is dealt out again by the masks of a second covering.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prismcube.llm.common import text_chunks, texts_of, written
from prismcube.llm.components import components

#: Words in a shingle, the hash's seed, and the largest number of differing bits of a link.
SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
#: Fingerprints of a bucket that a task compares at once; larger buckets are dealt out again.
BUCKET = 4096


@lru_cache(maxsize=1)
def _spread() -> np.ndarray:
    """For each byte, its eight bits as the eight bytes of one number."""
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return bits.reshape(-1).view(np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The text's fingerprint; bit ``i`` is set if over half of the shingles' hashes have it.

    Words are runs without blanks, tabs and line ends, A-Z lower-cased. Fewer
    words than a shingle are one shingle; without words it is 0.
    """
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [len(joined)]
    starts = [0]
    if len(words) > shingle:
        blanks = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
        starts += (blanks[: len(words) - shingle] + 1).tolist()
        ends = blanks[shingle - 1 :].tolist() + ends
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], dtype=np.uint64)
    # Eight counters of one byte per number hold the sums of up to 255 hashes.
    packed = np.add.reduceat(_spread()[hashes.view(np.uint8).reshape(-1, 8)], np.arange(0, len(hashes), 255), axis=0)
    counts = packed.view(np.uint8).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` for each row of ``docs``; a NULL text is empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            found = np.array([fingerprint(t, shingle) for t in texts_of(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast("int64"), batch.column("text_hash"), pa.array(found.view(np.int64))],
                ["doc_id", "text_hash", "fp"],
            )

    columns = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return columns.mapInArrow(each, "doc_id long, text_hash long, fp long")


def masks(radius: int = RADIUS, level: int = 0) -> list[int]:
    """The masks of a covering; each level deals the vectors to the bits in another order."""
    vectors = (1 << (radius + 1)) - 1
    order = np.random.default_rng(level).permutation(BITS) if level else np.arange(BITS)
    given = {int(bit): place % vectors + 1 for place, bit in enumerate(order)}
    return [sum(1 << i for i in range(BITS) if (given[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly what all links within the radius connect: at most one per member."""
    rest, left, right = members, [], []
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                left.append(np.full(len(found), x))
                right.append(found)
                reached.extend(found)
    if not left:
        return members[:0], members[:0]
    return np.concatenate(left), np.concatenate(right)


def _linked(radius: int, most: int):
    """Links of the sorted runs of a partition; rows of runs over ``most`` come back as they are, without ``b``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, large = None, np.zeros(0, dtype=np.uint64), False

        def rows(left: np.ndarray, right: np.ndarray | None, bucket: int | None) -> pa.RecordBatch:
            n = len(left)
            links = pa.nulls(n, pa.int64()) if right is None else pa.array(right.view(np.int64))
            of = pa.nulls(n, pa.int64()) if bucket is None else pa.array(np.full(n, bucket))
            return pa.RecordBatch.from_arrays([of, pa.array(left.view(np.int64)), links], ["bucket", "a", "b"])

        def close() -> Iterator[pa.RecordBatch]:
            """What the run that has ended yields."""
            if large:
                if len(held):
                    yield rows(held, None, key)
            elif len(held) > 1:
                left, right = forest(held, radius)
                if len(left):
                    yield rows(left, right, None)

        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            members = batch.column("fp").to_numpy().view(np.uint64)
            cuts = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
            begins, ends = np.append(0, cuts), np.append(cuts, len(buckets))
            if key is not None and len(buckets) and buckets[0] != key:
                yield from close()
                key = None
            # A run of one that neither continues nor may go on holds no link.
            wanted = np.flatnonzero((ends - begins > 1) | (begins == 0) | (ends == len(buckets)))
            for begin, end in zip(begins[wanted], ends[wanted], strict=True):
                if buckets[begin] != key:
                    yield from close() if key is not None else ()
                    key, held, large = int(buckets[begin]), members[:0], False
                held = np.concatenate((held, members[begin:end]))
                if len(held) > most or large:
                    large = True
                    yield rows(held, None, key)
                    held = members[:0]
        if key is not None:
            yield from close()

    return each


def links(prints: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """``a, b``: links between the distinct values of ``fp``, enough to connect all that lie within ``radius``."""
    found, level = [], 0
    rows = prints.select(F.lit(0).cast("long").alias("bucket"), "fp")
    while True:
        keys = F.array(*[
            F.xxhash64(F.col("bucket"), F.lit(v), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")))
            for v, m in enumerate(masks(radius, level))
        ])
        dealt = rows.select(F.explode(keys).alias("bucket"), "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")
        result = written(dealt.mapInArrow(_linked(radius, most), "bucket long, a long, b long"), f"covering-{level}")
        found.append(result.where(F.col("b").isNotNull()).select("a", "b"))
        rows = result.where(F.col("b").isNull()).select("bucket", F.col("a").alias("fp"))
        if rows.isEmpty():
            break
        level += 1
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _group_labels(prints: DataFrame, least, name: str, radius: int) -> DataFrame:
    """``fp, name``: the minimum ``name`` over all rows whose fingerprints are connected with ``fp``."""
    distinct = written(prints.groupBy("fp").agg(least.alias(name)), "fingerprints")
    roots = components(links(distinct, radius)).select(F.col("node").alias("fp"), "root")
    tops = roots.select(F.col("root").alias("fp"), "root").distinct()
    member = written(distinct.join(roots.unionByName(tops), "fp"), "members")
    lowest = member.groupBy("root").agg(F.min(name).alias("low"))
    known = member.join(lowest, "root").select("fp", "low")
    return distinct.join(known, "fp", "left").select("fp", F.coalesce("low", name).alias(name))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at
    most ``radius`` differing bits; rows without an id link, but don't name a
    group. Texts without words all have fingerprint 0. Repeated rows come back
    as often as they are there.
    """
    prints = written(fingerprints(docs, shingle).select("doc_id", "fp"), "prints")
    labels = _group_labels(prints, F.min("doc_id"), "component_id", radius)
    shown = F.lower(F.lpad(F.hex("fp"), BITS // 4, "0"))
    return prints.join(labels, "fp").select("doc_id", shown.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group, the one with the smallest id stays.

    Rows are told apart by id and text; of rows equal in both, one stays. The
    texts are read twice but shuffled only if the rows to drop are too many to
    broadcast.
    """
    columns = docs.columns
    prints = written(fingerprints(docs, shingle), "prints")
    row = F.struct("doc_id", "text_hash")
    labels = _group_labels(prints, F.min(row), "kept", radius)
    judged = written(prints.join(labels, "fp").select("doc_id", "text_hash", "kept"), "judged")
    drop = judged.where(~row.eqNullSafe(F.col("kept"))).select("doc_id", "text_hash").distinct()

    def same(rows: DataFrame, marks: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(marks["doc_id"]) & (F.xxhash64(rows["text"]) == marks["text_hash"])

    kept = docs.join(drop, same(docs, drop), "left_anti")
    repeated = judged.where(row.eqNullSafe(F.col("kept"))).groupBy("doc_id", "text_hash").count().where("count > 1")
    repeated = written(repeated.select("doc_id", "text_hash"), "repeated")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, same(kept, repeated), "left_anti")
    again = kept.join(repeated, same(kept, repeated), "left_semi")
    # One row each of those equal in id and text, by place so that no column's name can clash.
    keys = [F.coalesce(again["doc_id"].cast("string"), F.lit("")), F.xxhash64(again["text"])]
    values = again.select(F.struct(*keys).alias("k"), F.struct(*[again[f"`{c}`"] for c in columns]).alias("r"))
    one = values.groupBy("k").agg(F.first("r").alias("r")).select("r.*")
    return single.unionByName(one)
