"""Two-decimal rounding of exported aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(amount: Column) -> Column:
    """Half-up rounding of an exact (decimal) amount to two decimals."""
    return F.round(amount, 2)


def round_binary(amount: Column) -> Column:
    """Round a double by its exact binary value, ties to even, as fixed-point printing does."""
    return F.call_function("format_number", amount, F.lit("#0.00")).cast("double")
