"""Stored cubes: full generation, incremental refresh, lookups.

A version of a cube is a list of parts: the cube as it was last generated and
the deltas since, which readers merge. A refresh writes its delta; parts of like
size are merged as ``versions`` says, so the large ones are seldom written again.

Rows of a part are sorted by cuboid, bucket and key, where the bucket is a hash
of the key: files are ranges of that order, and statistics lead to a group.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import versions
from ..contract import CUBE_DIMENSIONS, CUBE_MEASURE, Contract
from ..functions.measures import STATE, merge_state
from ..operators.columns import filter_equal
from ..operators.cube import MASK, full_cube
from .load import fact_table, new_rows, observed_write

BUCKET = "bucket"
BUCKETS = 4096
#: Bytes of a row group: a lookup reads one per part.
ROW_GROUP = 16 << 20


def bucket_of(*values: str | Column) -> Column:
    """The bucket of a group; NULL values and rolled-up dimensions don't count."""
    return F.pmod(F.xxhash64(*values), F.lit(BUCKETS)).cast("int")


def stored_types(state: DataFrame) -> DataFrame:
    """State in the column types of a stored cube, so that all versions have one schema."""
    exact = dict(state.dtypes)["sum_amount"].startswith("decimal")
    return state.withColumn("sum_amount", F.col("sum_amount").cast("decimal(38,2)" if exact else "double"))


def dimensions(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in (MASK, BUCKET, *STATE)]


def laid_out(state: DataFrame) -> DataFrame:
    """Rows in the order of cuboid, bucket and key; adaptive execution joins small ranges to one file."""
    dims = dimensions(state.columns)
    rows = state if BUCKET in state.columns else state.withColumn(BUCKET, bucket_of(*dims))
    return rows.repartitionByRange(MASK, BUCKET).sortWithinPartitions(MASK, BUCKET, *dims)


def parquet_writer(df: DataFrame):
    return df.write.option("parquet.block.size", str(ROW_GROUP))


def write_part(spark: SparkSession, root: str, last: dict, state: DataFrame) -> dict:
    """Write rows as a part: its path, how many rows, the rows of the fact table that they hold, and their cuboids."""
    path = versions.new_part(root, last, "cube")
    apex = F.coalesce(F.sum(F.when(F.col(MASK) == 0, F.col("count"))), F.lit(0))
    found = observed_write(parquet_writer, laid_out(state), path, facts=apex, cuboids=F.size(F.collect_set(MASK)))
    return {"path": path, "rows": found["rows"], "facts": found.get("facts") or 0, "cuboids": found.get("cuboids") or 0}


def commit_cube(
    spark: SparkSession, root: str, parts: Sequence[dict], new: dict, delta: dict | None, schema: str, last: dict, watermark: int, **origin
) -> dict:
    """Commit parts as a version; ``delta`` is what it adds to the version before, unless that is replaced."""
    listed = json.dumps({"cube": list(parts), "delta": [delta] if delta else []})
    record = versions.commit(
        spark, root, "cube", last, watermark=watermark, parts=listed, schema=schema, rows=new["facts"], cuboids=new["cuboids"], **origin
    )
    versions.expire(spark, root, record)
    return record


def write_cube(spark: SparkSession, root: str, state: DataFrame, last: dict, watermark: int, **origin) -> dict:
    """Commit ``state`` as the whole cube."""
    typed = stored_types(state)
    whole = write_part(spark, root, last, typed)
    return commit_cube(spark, root, [whole], whole, None, typed.schema.json(), last, watermark, **origin)


def add_delta(spark: SparkSession, root: str, delta: DataFrame, last: dict, watermark: int, **origin) -> dict:
    """Commit the ``last`` cube with a delta merged; of its parts only those of the delta's size are read."""
    typed = stored_types(delta)
    parts = versions.parts_of(last, "cube")
    if not parts:
        return write_cube(spark, root, delta, last, watermark, **origin)
    new = write_part(spark, root, last, typed)
    schema = typed.schema.json()
    n = versions.to_merge(parts, new["rows"])
    kept = [*parts, new]
    if n:
        due = kept[-1 - n :]
        merged = write_part(spark, root, last, merged_rows(read_stored(spark, due, schema)))
        kept = [*kept[: -1 - n], merged]
    return commit_cube(spark, root, kept, new, new, schema, last, watermark, **origin)


def read_stored(spark: SparkSession, parts: Sequence[dict], schema: str) -> DataFrame:
    """The rows of parts, not merged, with their bucket."""
    fields = T.StructType.fromJson(json.loads(schema))
    return versions.read_parts(spark, parts, T.StructType([*fields.fields, T.StructField(BUCKET, T.IntegerType())]))


def stored_parts(spark: SparkSession, last: dict) -> DataFrame:
    """The rows of all parts of a version, not merged, with their bucket."""
    return read_stored(spark, versions.parts_of(last, "cube"), last["schema"])


def merged_rows(rows: DataFrame) -> DataFrame:
    """One row per group of rows of several parts."""
    return stored_types(rows.groupBy(MASK, BUCKET, *dimensions(rows.columns)).agg(*merge_state()))


def stored_cube(spark: SparkSession, root: str, last: dict | None = None) -> DataFrame | None:
    """State of the ``last`` (by default the newest) cube version, ``None`` before the first one.

    Raises ``LookupError`` for a version that has expired.
    """
    last = last or versions.latest(spark, root, "cube")
    if last["parts"] is None:
        return None
    rows = stored_parts(spark, last)
    if len(versions.parts_of(last, "cube")) > 1:
        rows = merged_rows(rows)
    return rows.drop(BUCKET)


def stored_lookup(spark: SparkSession, root: str, dims: Sequence[str], key: dict[str, object], last: dict | None = None) -> DataFrame:
    """The row of one group; ``key`` names the cuboid by the dimensions it gives.

    Cuboid, bucket and key reach the statistics of every part.
    """
    last = last or versions.latest(spark, root, "cube")
    rows = stored_parts(spark, last)
    kinds = dict(rows.dtypes)
    mask = sum(1 << i for i, d in enumerate(dims) if d in key)
    bucket = bucket_of(*[F.lit(key.get(d)).cast(kinds[d]) for d in dims])
    found = filter_equal(rows.where((F.col(MASK) == mask) & (F.col(BUCKET) == bucket)), key)
    return merged_rows(found).drop(BUCKET)


def generate_cube(
    spark: SparkSession,
    root: str,
    contract: Contract,
    dims: Sequence[str] = CUBE_DIMENSIONS,
    measure: str = CUBE_MEASURE,
) -> dict:
    """Compute all cuboids of the whole fact table; returns the commit record."""
    heads = versions.heads(spark, root)
    loaded, last = heads["load", None], heads["cube", None]
    rows = fact_table(spark, root, contract, loaded).select(*dims, measure)
    return write_cube(spark, root, full_cube(rows, dims, measure), last, loaded["watermark"], of_version=loaded["version"])


def refresh_cube(
    spark: SparkSession,
    root: str,
    contract: Contract,
    dims: Sequence[str] = CUBE_DIMENSIONS,
    measure: str = CUBE_MEASURE,
) -> dict:
    """Merge the rows loaded since the last cube version; does nothing when there are none."""
    heads = versions.heads(spark, root)
    loaded, last = heads["load", None], heads["cube", None]
    if not versions.has_new(loaded, last):
        return last
    rows = new_rows(spark, root, contract, [*dims, measure], last, loaded)
    delta = full_cube(rows, dims, measure)
    return add_delta(spark, root, delta, last, loaded["watermark"], of_version=loaded["version"])


def merge_batch(
    batch: DataFrame, batch_id: int, root: str, dims: Sequence[str], measure: str, source: str
) -> dict:
    """Merge one micro-batch of fact rows, unless ``source`` committed it before."""
    spark = batch.sparkSession
    heads = versions.heads(spark, root)
    last = heads["cube", None]
    if batch_id <= heads["cube", source]["batch_id"]:
        return last
    delta = full_cube(batch, dims, measure)
    return add_delta(spark, root, delta, last, last["watermark"], source=source, batch_id=batch_id, of_version=last["of_version"])


def refresh_report(spark: SparkSession, root: str) -> DataFrame:
    """One row per cube version: rows merged, cuboids they touch, watermark before and after."""
    cubes = versions.commits(spark, root).where(F.col("kind") == "cube")
    return cubes.select("version", "rows", "cuboids", "watermark_before", "watermark", "committed_at")
