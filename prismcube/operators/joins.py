"""Left outer equi joins.

Dimension joins carry no hint: Spark broadcasts a side whose size it puts
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both
sides, where adaptive execution splits the partition of a hot key. A derived
table, whose size Spark cannot estimate, is measured before it is broadcast
(``measured``, ``left_join_derived``). Where adaptive execution cannot help,
the left rows of hot keys are salted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import checkpointed, written

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
SALTS = 64
MOST_HOT_KEYS = 25_000


def value_bytes(field: T.StructField) -> Column:
    """Bytes one value takes in a row."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + F.lit(8)
    return F.lit(16)


def size_columns(df: DataFrame) -> list[Column]:
    """Aggregates that measure ``df``."""
    width = sum((value_bytes(f) for f in df.schema.fields), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")]


def written_measured(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``df`` as a written table, and whether it is small enough to broadcast, measured while it is written."""
    seen = Observation()
    table = written(df.observe(seen, *size_columns(df)), name)
    return table, within_limits({"rows": 0, "bytes": 0} | seen.get)


def within_limits(size: Row | Mapping[str, int]) -> bool:
    """Whether a measured table is small enough to broadcast."""
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    """Measure ``df`` and say whether it is small enough to broadcast."""
    return within_limits(df.agg(*size_columns(df)).first())


def measured(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it was measured and is small enough."""
    return F.broadcast(df) if fits_broadcast(df) else df


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast if it is small although Spark's estimate says otherwise.

    The estimate of a join or a group-by follows the size of its inputs, not
    of its result. Only a dimension that Spark would not broadcast by itself
    is measured, in a job of its own.
    """
    spark = df.sparkSession
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = int(str(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()))
    return df if estimate <= limit else measured(df)


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``key, item`` (as text) of the values that hold more rows than an average shuffle partition.

    One pass over ``df`` with a fixed-size frequency sketch per key; the
    sketches keep as many values as there are partitions. The answer only
    steers how rows are spread, so an estimate is enough.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, min(partitions, MOST_HOT_KEYS))
    texts = df.select(*[F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(keys)])
    sketch = texts.agg(
        *[F.expr(f"approx_top_k(k{i}, {most}, {most * 40})").alias(f"k{i}") for i in range(len(keys))],
        F.count(F.lit(1)).alias("rows"),
    )
    tops = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"k{i}").alias("top")) for i, k in enumerate(keys)]))
    entries = sketch.select("rows", tops.alias("t")).select("rows", "t.key", F.explode("t.top").alias("e"))
    hot = entries.where((F.col("e.count") * partitions > F.col("rows")) & F.col("e.item").isNotNull())
    return hot.select("key", F.col("e.item").alias("item"))


def salted_left_joins(left: DataFrame, sides: Mapping[str, DataFrame]) -> DataFrame:
    """Shuffle joins, one after another, with the left rows of hot keys spread.

    ``left`` is written once; that table gives the sketches of all keys in one
    pass and numbers its rows. The salt is drawn from the number, so equal
    rows are spread too, and a recomputed task reads the same numbers. Rows
    without a key match nothing and are spread as well.
    """
    left = written(left.withColumn("_row", F.monotonically_increasing_id()), "left")
    hot = checkpointed(hot_keys(left, list(sides)))
    for key, right in sides.items():
        own = F.broadcast(hot.where(F.col("key") == key).select(F.col("item").alias("_item"), F.lit(True).alias("_hot")))
        spread = F.pmod(F.xxhash64(F.lit(key), "_row"), F.lit(SALTS)).cast("int")
        marked = left.join(own, left[key].cast("string") == F.col("_item"), "left").withColumn(
            "_salt", F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(F.lit(0))
        )
        copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        copied = right.join(own, right[key].cast("string") == F.col("_item"), "left").withColumn("_salt", F.explode(copies))
        left = marked.drop("_hot", "_item").join(copied.drop("_hot", "_item"), [key, "_salt"], "left").drop("_salt")
    return left.drop("_row")


def left_join(left: DataFrame, right: DataFrame, key: str, salted: bool = False) -> DataFrame:
    """Keep every left row; a repeated right key multiplies rows; NULL matches nothing.

    ``salted`` asks for explicit salting, for sessions or plans in which
    adaptive execution cannot split a hot key.
    """
    joined = salted_left_joins(left, {key: right}) if salted else left.join(right, key, "left")
    return joined.select(*left.columns, *[c for c in right.columns if c != key])


def left_join_derived(left: DataFrame, right: DataFrame, key: str, small: bool | None = None) -> DataFrame:
    """``left_join`` with a derived table: broadcast or salted, as it was or is now measured."""
    if fits_broadcast(right) if small is None else small:
        return left_join(left, F.broadcast(right), key)
    return left_join(left, right, key, salted=True)


def renamed_role(dim: DataFrame, names: dict[str, str]) -> DataFrame:
    """A dimension in a role: only the listed columns, under their role names."""
    return dim.select(*[F.col(old).alias(new) for old, new in names.items()])
