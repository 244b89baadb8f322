"""Publish a cube as one CSV folder and one catalog table per cuboid."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.measures import MEASURES, average
from ..functions.naming import cuboid_names, mask_dimensions
from ..functions.rounding import round_binary, round_exact
from ..operators.cube import MASK, key_order, one_cuboid
from ..scratch import written
from ..sources.csv import discover, read_csv
from ..versions import listed, remove, rename
from .csv import write_csv

CONCURRENT_JOBS = 16
REPORT = "table_name string, published boolean, error string"


def rounded(state: DataFrame) -> DataFrame:
    """Served measures rounded to two decimals, after the other columns of ``state``."""
    exact = dict(state.dtypes)["sum_amount"].startswith("decimal")
    two = round_exact if exact else round_binary
    keys = [c for c in state.columns if c not in ("sum_amount", "count", "min_amount", "max_amount")]
    return state.select(
        *keys,
        two(F.col("sum_amount")).cast("decimal(38,2)").alias("sum_amount"),
        "count",
        round_binary(average()).cast("decimal(38,2)").alias("avg_amount"),
        two(F.col("min_amount")).cast("decimal(38,2)").alias("min_amount"),
        two(F.col("max_amount")).cast("decimal(38,2)").alias("max_amount"),
    )


def ordered_cuboid(cube: DataFrame, dims: Sequence[str], mask: int) -> DataFrame:
    """One cuboid as exported: its dimensions, rounded measures, groups in key order."""
    kept = mask_dimensions(dims, mask)
    table = rounded(one_cuboid(cube, dims, mask))
    return table.orderBy(key_order(kept)) if kept else table


def numbered_cuboid(cube: DataFrame, dims: Sequence[str], mask: int) -> DataFrame:
    """``ordered_cuboid`` with ``position``, the place of each row in the export, from 0.

    The sorted rows are written with their place in their partition; what
    precedes a partition is a sum over one row per partition.
    """
    number = F.monotonically_increasing_id()
    inside = F.lit((1 << 33) - 1)  # the low bits count the rows of a partition
    rows = written(ordered_cuboid(cube, dims, mask).withColumn("_number", number), "ordered")
    part = F.shiftright("_number", 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    placed = rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
    position = (F.col("_start") + F.col("_number").bitwiseAND(inside)).alias("position")
    return placed.select(*[c for c in rows.columns if c != "_number"], position)


def checked(report: DataFrame) -> DataFrame:
    """The report of ``run_jobs``; raises if any job failed."""
    failed = report.where(~F.col("published")).collect()
    if failed:
        raise RuntimeError("; ".join(f"{r['table_name']}: {r['error']}" for r in failed))
    return report


def run_jobs(spark: SparkSession, jobs: Iterable[tuple[str, Callable[[], None]]]) -> DataFrame:
    """Run independent Spark jobs a few at a time; a failed one is reported, the others go on."""

    def attempt(job):
        name, action = job
        try:
            action()
            return name, True, None
        except Exception as error:  # noqa: BLE001 - reported per table
            return name, False, str(error).splitlines()[0]

    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        results = list(pool.map(attempt, jobs))
    return spark.createDataFrame(results, REPORT)


def csv_field(column: str, kind: str) -> Column:
    """A value as a CSV field: quoted only where it must be, a missing one empty."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    if kind != "string":
        return text
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(text.rlike('[,"\r\n]|^#'), quoted).otherwise(text)


def lines(cube: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Each row of a cube as the line of its cuboid's file, with the ``key`` that lines are sorted by."""
    table = rounded(cube)
    kinds = dict(table.dtypes)
    kept = {d: F.col(MASK).bitwiseAND(F.lit(1 << i)) != 0 for i, d in enumerate(dims)}
    fields = [F.when(kept[d], csv_field(d, kinds[d])) for d in dims]  # one that is rolled up is NULL and left out
    own = [F.when(kept[d], F.coalesce(F.col(d).cast("string"), F.lit(""))) for d in dims]
    measures = [csv_field(m, kinds[m]) for m in MEASURES]
    return table.select(MASK, F.concat_ws("|", *own).alias("key"), F.concat_ws(",", *fields, *measures).alias("line"))


def _with_headers(names: Sequence[str], headers: Sequence[str]):
    """The lines of a task, numbered, with the header of each file before its first one."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, number = None, 0
        for batch in batches:
            masks = batch.column(MASK).to_numpy()
            cuts = np.flatnonzero(np.r_[True, masks[1:] != masks[:-1]]) if len(masks) else []
            for begin, end in zip(cuts, [*cuts[1:], len(masks)], strict=True):
                mask = int(masks[begin])
                text = batch.column("line").slice(begin, end - begin)
                if mask != last:
                    text, last = pa.concat_arrays([pa.array([headers[mask]], text.type), text]), mask
                numbers = pa.array(range(number, number + len(text)), pa.int64())
                number += len(text)
                yield pa.RecordBatch.from_arrays([pa.array([names[mask]] * len(text)), numbers, text], ["table_name", "number", "line"])

    return each


def export_cuboids(cube: DataFrame, dims: Sequence[str], folder: str) -> DataFrame:
    """Write ``<folder>/<cuboid name>.csv`` for every cuboid; returns a report per table.

    One job: the lines of all cuboids are dealt out by ranges of cuboid and
    key, sorted within them and written by cuboid; a large cuboid has several
    files, whose names are in key order. Then the folders get their names.
    """
    spark, names = cube.sparkSession, cuboid_names(dims)
    if cube.isEmpty():

        def job(mask: int, name: str):
            return name, lambda: write_csv(ordered_cuboid(cube, dims, mask), f"{folder}/{name}.csv")

        return run_jobs(spark, [job(m, n) for m, n in enumerate(names)])
    headers = [",".join([*mask_dimensions(dims, m), *MEASURES]) for m in range(len(names))]
    ranged = lines(cube, dims).repartitionByRange(MASK, "key").sortWithinPartitions(MASK, "key")
    named = ranged.select(MASK, "line").mapInArrow(_with_headers(names, headers), "table_name string, number long, line string")
    # Sorted by what the writer parts them by, and within that as they came.
    written_lines = named.sortWithinPartitions("table_name", "number").select("table_name", "line")
    attempt = f"{folder}/_attempt-{uuid.uuid4().hex}"
    written_lines.write.partitionBy("table_name").text(attempt)

    def move(name: str):
        def action():
            own = f"{attempt}/table_name={name}"
            for file, _ in listed(spark, own):
                rename(spark, f"{own}/{file}", f"{own}/{file.removesuffix('.txt')}.csv")
            rename(spark, own, f"{folder}/{name}.csv")

        return name, action

    report = run_jobs(spark, [move(n) for n in names])
    remove(spark, attempt)
    return report


def publish_tables(spark: SparkSession, folder: str, location: str, database: str | None = None) -> DataFrame:
    """Replace one typed catalog table per CSV table found in ``folder``; returns a report per table.

    Table files go below ``location``, a folder every executor can reach. CSV
    can't tell NULL from the empty text; ``plans.publish`` keeps both apart.
    """

    def job(name, path, schema):
        full_name = f"{database}.{name}" if database else name

        def action():
            rows = read_csv(spark, path, schema)
            # An empty field is an empty text: the files don't tell it from a missing one.
            texts = [c for c, kind in rows.dtypes if kind == "string"]
            writer = rows.fillna("", texts).write.mode("overwrite")
            writer.option("path", f"{location}/{name}").saveAsTable(full_name)

        return name, action

    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    return run_jobs(spark, [job(*found) for found in discover(spark, folder)])
