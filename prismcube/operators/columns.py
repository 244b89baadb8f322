"""Renames, key dropping, positional binding and equality filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_suffix(df: DataFrame, suffix: str = "_sk") -> DataFrame:
    """Drop every column whose name ends with ``suffix``."""
    return df.drop(*[c for c in df.columns if c.endswith(suffix)])


def suffix_right(left: DataFrame, right: DataFrame, suffix: str, keep: Iterable[str] = ()) -> DataFrame:
    """Add ``suffix`` to the columns of ``right`` that ``left`` also has, except ``keep``."""
    clash = set(left.columns) - set(keep)
    return right.withColumnsRenamed({c: c + suffix for c in right.columns if c in clash})


def bind_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The nth column takes the nth name."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, got {len(df.columns)}")
    return df.toDF(*names)


def filter_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows that match every given value; ``None`` matches NULL."""
    tests = [F.col(c).eqNullSafe(F.lit(v)) if v is None else F.col(c) == F.lit(v) for c, v in values.items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df
