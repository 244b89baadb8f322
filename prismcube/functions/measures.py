"""The mergeable state behind SUM, COUNT, AVG, MIN and MAX of one measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ("sum_amount", "count", "min_amount", "max_amount")
MEASURES = ("sum_amount", "count", "avg_amount", "min_amount", "max_amount")


def measure_state(measure: str) -> list[Column]:
    """Aggregates of raw rows; ``count`` counts rows, also those without a measure."""
    col = F.col(measure)
    return [
        F.sum(col).alias("sum_amount"),
        F.count(F.lit(1)).alias("count"),
        F.min(col).alias("min_amount"),
        F.max(col).alias("max_amount"),
    ]


def merge_state() -> list[Column]:
    """Aggregates of partial states; merging is associative and commutative."""
    return [
        F.sum("sum_amount").alias("sum_amount"),
        F.sum("count").alias("count"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    ]


def average() -> Column:
    """Sum over count, 0 for an empty group, NULL for one without any measure."""
    total = F.col("sum_amount").cast("double")
    return F.when(F.col("count") > 0, total / F.col("count")).otherwise(F.lit(0.0))


def finish(state: DataFrame) -> DataFrame:
    """State columns to the five served measures (doubles and a long)."""
    keys = [c for c in state.columns if c not in STATE]
    served = {
        "sum_amount": F.col("sum_amount").cast("double"),
        "count": F.col("count"),
        "avg_amount": average(),
        "min_amount": F.col("min_amount").cast("double"),
        "max_amount": F.col("max_amount").cast("double"),
    }
    return state.select(*keys, *[served[m].alias(m) for m in MEASURES])
