"""Row checks against a contract: width, missing values, uniqueness; one reason per rejected row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.conversion import convert, is_missing
from ..sources.csv import BAD_WIDTH
from .joins import left_join_derived, size_columns, within_limits, written_measured
from .probing import HASH, MOST_NAMED, key_hash, near

REASON = "reject_reason"
EARLY, LATE = "_early_reason", "_late_reason"


def check_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Refuse a batch that lacks a contract column."""
    absent = missing_columns(df, contract)
    if absent:
        raise ValueError(f"batch lacks contract columns: {', '.join(absent)}")
    return df


def missing_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [n for n in contract.names if n not in df.columns]


def first_claims(rows: DataFrame, key: str, position: str, eligible: Column) -> DataFrame:
    """For each repeated key, the position of its first eligible row.

    Keys that occur once are left out. The group-by reduces a hot key to one
    row per task before the shuffle.
    """
    seen = rows.groupBy(F.col(key)).agg(
        F.min(F.when(eligible, F.col(position))).alias("first_pos"), F.count(F.lit(1)).alias("rows")
    )
    return seen.where((F.col("rows") > 1) & F.col("first_pos").isNotNull()).select(key, "first_pos")


def key_text(column: str) -> Column:
    """A unique value as it is compared: as text, a missing one as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def stored_claims(rows: DataFrame, key: str, stored: DataFrame, size: Mapping[str, int] | None = None) -> DataFrame:
    """Keys of this batch that the table already holds, claimed before position 0.

    ``stored`` has the stored values in its first column. With a second one,
    the ``probing.key_hash`` of the value's text, only the row groups that may
    hold one of a small batch's keys are read. ``size`` are the batch's
    ``rows`` and the ``bytes`` of its keys, where they are known.
    """
    name = stored.columns[0]
    keys = rows.select(key).distinct()
    size = size or keys.agg(*size_columns(keys)).first().asDict()
    if HASH in stored.columns and size["rows"] <= MOST_NAMED:
        stored = near(stored, keys.select(key_hash(key)), size["rows"])
    side = F.broadcast(keys) if within_limits(size) else keys
    taken = stored.select(key_text(name).alias(key)).join(side, key, "left_semi")
    return taken.distinct().select(key, F.lit(-1).cast("bigint").alias("first_pos"))


def mark_duplicates(
    rows: DataFrame, key: str, position: str, eligible: Column, stored: DataFrame | None = None, size: Mapping[str, int] | None = None
) -> DataFrame:
    """Add ``is_duplicate``: a stored row or an earlier eligible row has the same value.

    A missing value counts as the empty string. Rejected rows claim nothing.
    """
    keyed = rows.withColumn("_key", key_text(key))
    claims = first_claims(keyed, "_key", position, eligible)
    if stored is not None:
        claims = claims.unionByName(stored_claims(keyed, "_key", stored, size))
        claims = claims.groupBy("_key").agg(F.min("first_pos").alias("first_pos"))
    claims, small = written_measured(claims, "claims")
    marked = left_join_derived(keyed, claims, "_key", small)
    duplicate = F.coalesce(F.col(position) > F.col("first_pos"), F.lit(False))
    return marked.select(*rows.columns, duplicate.alias("is_duplicate"))


def row_checks(rows: DataFrame, contract: Contract) -> list[Column]:
    """The checks that need no other row, as two reasons: those before and those after the unique check."""
    bad_width = F.col(BAD_WIDTH).isNotNull() if BAD_WIDTH in rows.columns else F.lit(False)
    early, late = [F.when(bad_width, F.lit("width"))], [F.lit(None).cast("string")]
    reasons = early
    for spec in contract.columns:
        if spec.not_null:
            reasons.append(F.when(is_missing(F.col(spec.name)), F.lit(f"not_null:{spec.name}")))
        if spec.unique:
            reasons = late
    return [F.coalesce(*early).alias(EARLY), F.coalesce(*late).alias(LATE)]


def judge(
    rows: DataFrame, contract: Contract, position: str, key: str | None = None, stored: DataFrame | None = None,
    size: Mapping[str, int] | None = None,
) -> DataFrame:
    """Replace the two reasons of ``row_checks`` by ``reject_reason``, which includes the unique check.

    ``key`` holds the text of the unique column, by default under its own
    name; ``stored`` and ``size`` are those of ``stored_claims``.
    """
    kept = [c for c in rows.columns if c not in (EARLY, LATE)]
    if not contract.unique_columns:
        return rows.select(*kept, F.coalesce(EARLY, LATE).alias(REASON))
    name = contract.unique_columns[0]
    eligible = F.col(EARLY).isNull() & F.col(LATE).isNull()
    marked = mark_duplicates(rows, key or name, position, eligible, stored, size)
    duplicate = F.when(F.col("is_duplicate"), F.lit(f"unique:{name}"))
    return marked.select(*kept, F.coalesce(F.col(EARLY), duplicate, F.col(LATE)).alias(REASON))


def check_rows(
    rows: DataFrame, contract: Contract, position: str = "source_pos", stored: DataFrame | None = None
) -> DataFrame:
    """Add ``reject_reason``: NULL, ``width`` or ``<check>:<column>`` of the first failing column.

    ``stored`` holds the values of the unique column that are already loaded,
    see ``stored_claims``.
    """
    check_columns(rows, contract)
    return judge(rows.select("*", *row_checks(rows, contract)), contract, position, stored=stored)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNull()).drop(REASON, BAD_WIDTH)


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(REASON).isNotNull())


def summary(checked: DataFrame) -> DataFrame:
    """Rows per outcome; accepted rows count under ``accepted``."""
    reason = F.coalesce(F.col(REASON), F.lit("accepted")).alias("outcome")
    return checked.groupBy(reason).agg(F.count(F.lit(1)).alias("rows"))


def typed(rows: DataFrame, contract: Contract, extra: Sequence[str | Column] = ()) -> DataFrame:
    """Text columns converted to contract types, in contract order, after ``extra`` columns."""
    columns = [
        convert(F.col(spec.name), contract.spark_type(spec), contract.null_policy).alias(spec.name)
        for spec in contract.columns
    ]
    return rows.select(*extra, *columns)


def reconcile(table_rows: DataFrame, recorded_rows: int) -> DataFrame:
    """Compare the rows of a table with the number recorded when it was loaded."""
    counted = table_rows.agg(F.count(F.lit(1)).alias("table_rows"))
    recorded = F.lit(recorded_rows).cast("bigint").alias("recorded_rows")
    return counted.select("table_rows", recorded).withColumn(
        "matches", F.col("table_rows") == F.col("recorded_rows")
    )


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Per contract column: whether ``df`` has it and how many rows lack a value; one pass."""
    present = [n for n in contract.names if n in df.columns]
    gaps = [F.count(F.when(is_missing(F.col(n).cast("string")), 1)).alias(n) for n in present]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *gaps)
    counted = counted.withColumns({n: F.col("_rows") for n in contract.names if n not in present})
    long = counted.unpivot([], contract.names, "column_name", "missing_rows")
    return long.select("column_name", F.col("column_name").isin(present).alias("present"), "missing_rows")
