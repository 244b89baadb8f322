"""Code tables ``(column, value, code)``: dense codes in first-seen order that never change."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import checkpointed
from .joins import left_join, salted_left_joins, size_columns, within_limits
from .numbering import dense_number
from .probing import HASH, key_hash, near

SCHEMA = "`column` string, value string, code bigint"
INVALID = "<INVALID>"


def first_seen(df: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """Distinct values of all columns in one pass, each with the position it first occurs at."""
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]
    long = df.select(position, *values).unpivot([position], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.min(position).alias("first_pos"))


def build_dictionary(df: DataFrame, columns: Sequence[str], position: str = "row_id") -> DataFrame:
    """Codes 0, 1, 2, ... per column in first-seen order; the empty string is a value."""
    coded = dense_number(first_seen(df, columns, position), "first_pos", ["column"], "code")
    return coded.select("column", "value", "code")


def new_entries(
    dictionary: DataFrame, batch: DataFrame, columns: Sequence[str], position: str = "row_id", sizes: Mapping[str, int] | None = None
) -> DataFrame:
    """Entries for the values of ``batch`` that the dictionary lacks; codes go on where it ends.

    ``sizes`` are the entries of each column where they are known, so that
    they needn't be counted. Of a dictionary with the ``probing.key_hash`` of
    column and value only what may be a value of the batch is read.
    """
    seen = first_seen(batch, columns, position)
    if HASH in dictionary.columns:
        seen = checkpointed(seen.withColumn(HASH, key_hash("column", "value")))
        known = near(dictionary, seen)
        unseen = seen.join(known, [HASH, "column", "value"], "left_anti").drop(HASH)
    else:
        unseen = seen.join(dictionary, ["column", "value"], "left_anti")
    coded = dense_number(unseen, "first_pos", ["column"], "code")
    if sizes is not None:
        listed = [F.lit(x) for c in columns for x in (c, sizes.get(c, 0))]
        return coded.select("column", "value", (F.col("code") + F.create_map(*listed)[F.col("column")]).alias("code"))
    counted = dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("size"))
    start = F.coalesce(F.col("size"), F.lit(0))
    return coded.join(F.broadcast(counted), "column", "left").select(
        "column", "value", (F.col("code") + start).alias("code")
    )


def extend_dictionary(
    dictionary: DataFrame, batch: DataFrame, columns: Sequence[str], position: str = "row_id"
) -> DataFrame:
    """The dictionary with the new values of a batch; old codes stay."""
    old = dictionary.select("column", "value", "code")
    return old.unionByName(new_entries(dictionary, batch, columns, position))


def small_columns(dictionary: DataFrame, columns: Sequence[str]) -> set[str]:
    """The columns whose entries are few enough to broadcast, measured in one group-by."""
    entries = dictionary.where(F.col("column").isin(list(columns)))
    sizes = {r["column"]: r for r in entries.groupBy("column").agg(*size_columns(dictionary)).collect()}
    return {c for c in columns if c not in sizes or within_limits(sizes[c])}


def translate(df: DataFrame, sides: dict[str, DataFrame], small: set[str]) -> DataFrame:
    """Replace each column by what its side ``(column, _new)`` says, NULL where it says nothing.

    Small sides are broadcast; for the others the rows are written once and
    all their hot values found in one pass.
    """
    fresh = {c: side.withColumnRenamed("_new", f"_new_{i}") for i, (c, side) in enumerate(sides.items())}
    large = {c: side for c, side in fresh.items() if c not in small}
    if large:
        df = salted_left_joins(df, large)
    for c in fresh:
        if c in small:
            df = left_join(df, F.broadcast(fresh[c]), c)
    return df.withColumns({c: F.col(f"_new_{i}") for i, c in enumerate(fresh)})


def encode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values to codes in the listed columns; other columns pass through."""
    sides = {
        c: dictionary.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias("_new"))
        for c in columns
    }
    values = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})
    return translate(values, sides, small_columns(dictionary, columns)).select(*df.columns)


def decode(df: DataFrame, dictionary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Codes to values; a code without an entry becomes ``<INVALID>``; other columns pass through."""
    sides = {
        c: dictionary.where(F.col("column") == c).select(F.col("code").alias(c), F.col("value").alias("_new"))
        for c in columns
    }
    values = translate(df, sides, small_columns(dictionary, columns))
    return values.withColumns({c: F.coalesce(c, F.lit(INVALID)) for c in columns}).select(*df.columns)
