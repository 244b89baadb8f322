"""Lenient text-to-number conversion and the notion of a missing value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The numeric prefix that is read; the rest of the text is ignored.
INT_PREFIX = r"^\s*([+-]?[0-9]+)"
FLOAT_PREFIX = r"^\s*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"
SMALLEST_NORMAL_FLOAT = 1.17549435e-38


def is_missing(col: Column) -> Column:
    """NULL and the empty string are missing; a blank is a value."""
    return col.isNull() | (col == F.lit(""))


def to_int_lenient(text: Column) -> Column:
    """Leading integer of ``text``; 0 when there is none or it does not fit.

    A text that begins with a digit and is an integer as a whole, as most are,
    needs no regular expression.
    """
    text = text.cast("string")
    whole = F.when(F.ascii(text).between(ord("0"), ord("9")), text.try_cast("int"))
    return F.coalesce(whole, F.regexp_extract(text, INT_PREFIX, 1).try_cast("int"), F.lit(0))


def to_float_lenient(text: Column) -> Column:
    """Leading number of ``text`` as a 32-bit float; 0 when absent or out of range."""
    value = F.regexp_extract(text, FLOAT_PREFIX, 1).try_cast("float")
    size = F.abs(value)
    in_range = (size < F.lit(float("inf"))) & (size >= F.lit(SMALLEST_NORMAL_FLOAT).cast("float"))
    return F.when(in_range, value).otherwise(F.lit(0.0).cast("float"))


def to_decimal_lenient(text: Column, decimal_type: str = "decimal(18,2)") -> Column:
    """Leading number of ``text`` as an exact decimal; 0 when absent or too large."""
    value = F.regexp_extract(text, FLOAT_PREFIX, 1).try_cast(decimal_type)
    return F.coalesce(value, F.lit(0).cast(decimal_type))


def convert(text: Column, spark_type: str, null_policy: str) -> Column:
    """Text to the contract type under a null policy (see ``Contract``)."""
    if spark_type == "string":
        if null_policy == "zero":
            return F.coalesce(text, F.lit(""))
        return F.when(~is_missing(text), text)
    if spark_type == "int":
        value = to_int_lenient(text)
    elif spark_type == "float":
        value = to_float_lenient(text)
    else:
        value = to_decimal_lenient(text, spark_type)
    return value if null_policy == "zero" else F.when(~is_missing(text), value)
