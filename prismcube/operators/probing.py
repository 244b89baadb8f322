"""Lookups of a batch's keys in a large stored table that is laid out by a hash of the key.

A stored part is sorted by the hash, with statistics and bloom filters per row
group. A batch with few keys names their hashes in the filter, so only the row
groups that may hold one are read; a larger one meets all hashes in a
semi-join, against narrow rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from .joins import measured

HASH = "key_hash"
#: Most keys of a batch that are named in a filter.
MOST_NAMED = 1000
#: Values that one IN may list and still reach the row groups, whatever the session's threshold.
LISTED = 10
#: Bytes of a row group: small ones leave more out.
ROW_GROUP = 8 << 20
#: Of stored tables: ids and other texts with many values take half of what they take in Spark's default.
COMPRESSION = "zstd"
#: Rows of a file.
FILE_ROWS = 4_000_000


def key_hash(*columns: str | Column) -> Column:
    return F.xxhash64(*columns).alias(HASH)


def by_hash(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` in the order of its hash, in files of about ``FILE_ROWS`` where it is known how many ``rows`` there are."""
    if rows is None:
        laid = df.repartition(HASH)
    elif rows <= FILE_ROWS:
        laid = df.coalesce(1)
    else:
        laid = df.repartitionByRange(-(-rows // FILE_ROWS), HASH)
    return laid.sortWithinPartitions(HASH)


def hashed_writer(df: DataFrame) -> DataFrameWriter:
    """A writer of small row groups with bloom filters on the hash."""
    options = {"parquet.block.size": str(ROW_GROUP), f"parquet.bloom.filter.enabled#{HASH}": "true", "compression": COMPRESSION}
    return df.write.options(**options)


def one_of(hashes: Sequence[int]) -> Column:
    """Whether the hash is listed, as a filter that Parquet's row groups can answer."""
    lists = [F.col(HASH).isin(list(hashes[i : i + LISTED])) for i in range(0, len(hashes), LISTED)]
    while len(lists) > 1:  # pairwise, so that the filter stays flat
        lists = [reduce(lambda a, b: a | b, lists[i : i + 2]) for i in range(0, len(lists), 2)]
    return lists[0] if lists else F.lit(False)


def near(stored: DataFrame, batch: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of ``stored`` whose hash one of ``batch`` has, which may have ``rows`` rows."""
    hashes = batch.select(HASH).distinct()
    if rows is None or rows <= MOST_NAMED:
        named = [r[0] for r in hashes.limit(MOST_NAMED + 1).collect()]
        if len(named) <= MOST_NAMED:
            return stored.where(one_of(sorted(named)))
    return stored.join(measured(hashes) if rows is None else hashes, HASH, "left_semi")
