"""A generated date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def date_dimension(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day; ``date_sk`` counts from 1, ``weekday`` is ISO (Monday = 1)."""
    days = spark.range(1, (last - first).days + 2).select(F.col("id").cast("int").alias("date_sk"))
    full_date = F.date_add(F.lit(first), F.col("date_sk") - 1)
    return days.select(full_date.alias("full_date"), "date_sk").select(
        "full_date",
        "date_sk",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.day("full_date").alias("day"),
        (F.weekday("full_date") + 1).alias("weekday"),
        F.quarter("full_date").alias("quarter"),
    )
