"""Scans of Parquet tables: projected, by row range, resumed."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; Parquet reads no others."""
    return table.select(*columns)


def scan_range(
    table: DataFrame, columns: Sequence[str], start: int, end: int, position: str = "row_id"
) -> DataFrame:
    """Rows with a position in ``[start, end)``; the bounds reach the Parquet row-group statistics."""
    in_range = (F.col(position) >= F.lit(start)) & (F.col(position) < F.lit(end))
    return table.where(in_range).select(*columns)


def resume_scan(source: DataFrame, offset: int | str, position: str) -> DataFrame:
    """Rows from ``offset`` on: a number, or a column that holds the offset of each row."""
    start = F.col(offset) if isinstance(offset, str) else F.lit(offset)
    return source.where(F.col(position) >= start)


def split_ranges(
    table: DataFrame, columns: Sequence[str], cuts: Sequence[tuple[int, int]], position: str = "row_id"
) -> list[DataFrame]:
    """Consecutive ranges that hold every row, cut at the given fractions between the least and greatest position.

    Positions may have gaps: the bounds come from the positions themselves.
    The first range has no lower bound and takes rows without a position, the
    last one no upper bound.
    """
    low, high = table.agg(F.min(position), F.max(position)).first()
    low, end = (0, 0) if low is None else (low, high + 1)
    bounds = [low + (end - low) * a // b for a, b in cuts]
    first = table.where((F.col(position) < F.lit(bounds[0])) | F.col(position).isNull()).select(*columns)
    middle = [scan_range(table, columns, a, b, position) for a, b in pairwise(bounds)]
    return [first, *middle, resume_scan(table, bounds[-1], position).select(*columns)]


def warn_if_short(length: int, offset: int, what: str) -> None:
    """Warn when a source has fewer rows than were read from it before."""
    if length < offset:
        warnings.warn(f"{what} has {length} rows, fewer than the offset {offset}", stacklevel=3)
