"""Dense numbers in an order, without sorting a whole table in one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import written
from ..sources.csv import COORDINATES
from ..sources.tables import warn_if_short
from .joins import size_columns, within_limits

RUN = 1 << 20


def dense_number(df: DataFrame, order: str, by: Sequence[str] = (), name: str = "number") -> DataFrame:
    """Number rows 0, 1, 2, ... by the distinct non-negative integers in ``order``, per ``by``.

    Rows are numbered within runs of ``RUN`` consecutive order values, so no
    window partition exceeds ``RUN`` rows, and each run starts where the
    counts of the earlier ones end.
    """
    runs = df.withColumn("_run", F.floor(F.col(order) / F.lit(RUN)))
    keys = [*by, "_run"]
    before = W.partitionBy(*by).orderBy("_run").rowsBetween(W.unboundedPreceding, -1)
    starts = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    within = F.row_number().over(W.partitionBy(*keys).orderBy(order)) - 1
    numbered = runs.join(starts, keys).withColumn(name, F.col("_start") + within)
    return numbered.select(*df.columns, name)


@dataclass(frozen=True)
class Blocks:
    """The blocks of a written source, with what one pass over them told."""

    table: DataFrame
    new_lines: int
    small: bool


def source_blocks(rows: DataFrame, consumed: DataFrame | None = None, mark: str | None = None) -> Blocks:
    """One row per block of the source: where its lines stand in their file and among all new lines.

    ``consumed (source_file, lines, began)`` says how many lines of a file to
    skip, and how many there are before the first block that was read. Warns
    about a file that has fewer lines than that. ``block_last`` is the column
    ``mark`` of a block's last row. Blocks are input splits, so the running
    totals go over a small table.
    """
    blocks = rows.groupBy("source_file", "source_block").agg(
        F.count(F.lit(1)).alias("block_rows"),
        F.min("source_row").alias("block_first"),
        (F.max_by(mark, "source_row") if mark else F.lit(None).cast("bigint")).alias("block_last"),
    )
    everything = W.orderBy("source_file", "source_block").rowsBetween(W.unboundedPreceding, -1)
    in_file = W.partitionBy("source_file").orderBy("source_block").rowsBetween(W.unboundedPreceding, -1)
    if consumed is None:
        blocks = blocks.withColumns({c: F.lit(0).cast("bigint") for c in ("lines", "began")})
    else:
        blocks = blocks.join(consumed, "source_file", "left")
    blocks = blocks.withColumns(
        {
            "line_start": F.coalesce("began", F.lit(0)) + F.coalesce(F.sum("block_rows").over(in_file), F.lit(0)),
            "skipped": F.coalesce("lines", F.lit(0)),
        }
    )
    line_end = F.col("line_start") + F.col("block_rows")
    blocks = blocks.withColumn("block_new", F.greatest(line_end - F.greatest("line_start", "skipped"), F.lit(0)))
    blocks = blocks.withColumn("new_start", F.coalesce(F.sum("block_new").over(everything), F.lit(0)))
    of_file = F.max(line_end).over(W.partitionBy("source_file"))
    short = F.max_by(F.struct("source_file", "file_lines", "skipped"), F.col("skipped") - F.col("file_lines")).alias("short")
    seen = Observation()
    counted = blocks.drop("lines", "began").withColumn("file_lines", of_file)
    found = counted.observe(seen, F.sum("block_new").alias("new"), short, *size_columns(counted))
    table = written(found, "blocks")
    totals = seen.get
    if totals.get("short"):
        name, lines, skipped = totals["short"]
        warn_if_short(lines, skipped, name)
    return Blocks(table.drop("file_lines"), totals.get("new") or 0, within_limits({"rows": 0, "bytes": 0} | totals))


def with_position(rows: DataFrame, blocks: Blocks, base: int = 0) -> DataFrame:
    """Add ``source_line``, ``skipped`` and ``source_pos``.

    ``source_line`` is the line number in the file, ``source_pos`` is
    ``base`` plus the ordinal among the lines that are not skipped. Files
    count in path order and lines in file order, however Spark cuts and
    schedules the files. ``rows`` must come from a written table.
    """
    side = blocks.table.drop("block_rows", "block_new", "block_last")
    placed = rows.join(F.broadcast(side) if blocks.small else side, ["source_file", "source_block"], "left")
    line = F.col("line_start") + F.col("source_row") - F.col("block_first")
    position = F.lit(base) + F.col("new_start") + line - F.greatest("line_start", "skipped")
    kept = [c for c in rows.columns if c not in COORDINATES]
    return placed.select(position.alias("source_pos"), line.alias("source_line"), "skipped", *kept)
