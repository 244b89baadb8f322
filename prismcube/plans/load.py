"""Incremental load: landing CSV -> checked, typed, appended rows, rejects, code tables, audit.

A load adds a part to each of its tables: the rows, the keys (the unique
column's values by hash), the dictionary and the files it read. Their parts are
merged as ``versions`` says, so many small loads leave few files.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import versions
from ..contract import Contract
from ..operators import dictionary
from ..operators.joins import size_columns
from ..operators.numbering import Blocks, source_blocks, with_position
from ..operators.probing import COMPRESSION, HASH, by_hash, hashed_writer, key_hash
from ..operators.validation import REASON, check_columns, judge, key_text, reconcile, row_checks, typed
from ..scratch import checkpointed, scratch_path
from ..session import OPTIONS, with_options
from ..sources import csv
from ..sources.csv import BAD_WIDTH, COORDINATES, list_files, read_rows, read_tails, with_row, with_splits
from ..sources.tables import resume_scan, scan_range

ROW_ID = "row_id"
KEY = "unique_text"
LINE_HASH = "line_hash"
FILES = (
    "source_file string, file_size bigint, modified timestamp, lines bigint, "
    "tail_start bigint, tail_line bigint, tail_hash bigint, load_version bigint"
)
CODES = f"{dictionary.SCHEMA}, {HASH} bigint, load_version bigint"
KEYS = f"key string, {HASH} bigint"
#: A code table of so many entries is read whole.
FEW_CODES = 100_000
#: Rows of a file when parts are merged.
FILE_ROWS = 1_000_000
#: Conversions of dozens of columns make methods that the JVM would only interpret.
SHORT_METHODS = {"spark.sql.codegen.hugeMethodLimit": OPTIONS["spark.sql.codegen.hugeMethodLimit"]}
#: Accepted and rejected rows are written side by side, rather than after a sort of the wide rows.
BOTH_WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "2"}


def stored_schema(contract: Contract) -> T.StructType:
    head = T.StructType([T.StructField(ROW_ID, T.LongType())])
    tail = T.StructType.fromDDL(f"{REASON} string, raw_line string, load_version bigint")
    return T.StructType([*head.fields, *contract.schema.fields, *tail.fields])


def init_tables(spark: SparkSession, root: str, contract: Contract) -> None:
    """Create the fact table, key table, code table and file list empty and reset all watermarks.

    What was there before, and what a load still running writes, is out of
    reach from then on; ``versions.sweep`` deletes it.
    """
    versions.reset(spark, root)


def stored_rows(spark: SparkSession, root: str, contract: Contract, last: dict | None = None, after: int = 0) -> DataFrame:
    """Rows of the loads after version ``after`` up to ``last`` (the newest commit), with ``load_version`` and ``rejected``."""
    last = last or versions.latest(spark, root, "load")
    parts = [p for p in versions.parts_of(last, "rows") if p["last"] > after]
    rows = versions.read_parts(spark, parts, stored_schema(contract), "rejected boolean")
    # A part that was merged may begin before the loads that are asked for.
    return rows if all(p["first"] > after for p in parts) else rows.where(F.col("load_version") > after)


def fact_table(spark: SparkSession, root: str, contract: Contract, last: dict | None = None, after: int = 0) -> DataFrame:
    """Committed accepted rows: ``row_id`` and the contract columns."""
    return stored_rows(spark, root, contract, last, after).where(~F.col("rejected")).select(ROW_ID, *contract.names)


def reject_report(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """Committed rejects with their source position, reason and, for width errors, the raw line."""
    rows = stored_rows(spark, root, contract).where(F.col("rejected"))
    return rows.select("load_version", F.col(ROW_ID).alias("source_pos"), REASON, "raw_line")


def code_table(spark: SparkSession, root: str, last: dict | None = None) -> DataFrame:
    """Committed dictionary entries of all columns."""
    last = last or versions.latest(spark, root, "load")
    return versions.read_parts(spark, versions.parts_of(last, "dictionary"), CODES).select("column", "value", "code")


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """One row per load: rows appended, total so far, errors, width errors, new and all dictionary entries."""
    loads = versions.commits(spark, root).where(F.col("kind") == "load")
    counts = ("rows", "total_rows", "errors", "width_errors", "codes", "total_codes")
    return loads.select("version", "watermark", *counts, "committed_at")


def check_load(spark: SparkSession, root: str, contract: Contract) -> DataFrame:
    """Whether the fact table holds as many rows as the loads recorded."""
    last = versions.latest(spark, root, "load")
    return reconcile(fact_table(spark, root, contract, last), last["total_rows"])


def consumed_files(spark: SparkSession, root: str, last: dict) -> DataFrame:
    """Files that loads up to ``last`` read, however their source was spelled, as they were then."""
    files = versions.read_parts(spark, versions.parts_of(last, "files"), FILES)
    names = [c for c in files.columns if c != "source_file"]
    newest = files.groupBy("source_file").agg(F.max_by(F.struct(*names), "load_version").alias("f"))
    return newest.select("source_file", "f.*").withColumnsRenamed({"file_size": "seen_size", "modified": "seen_modified"})


# Parts -----------------------------------------------------------------------


def observed_write(writer_of, df: DataFrame, path: str, **measures: Column) -> dict:
    """Write ``df`` and return what was measured on the way; ``rows`` always is.

    The measures belong to the job that writes, so a task that is tried again
    counts once, as its files do.
    """
    seen = Observation()
    found = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(name) for name, m in measures.items()])
    with with_options(df.sparkSession, BOTH_WRITERS):
        writer_of(found).parquet(path)
    return {"rows": 0} | seen.get


def plain(df: DataFrame):
    return df.write.option("compression", COMPRESSION)


def split_rejects(df: DataFrame):
    return plain(df).partitionBy("rejected")


def in_files(df: DataFrame, rows: int) -> DataFrame:
    """Merged rows in the order of their ids, in files of about ``FILE_ROWS``."""
    files = max(1, -(-rows // FILE_ROWS))
    return df.coalesce(1) if files == 1 else df.repartitionByRange(files, ROW_ID)


class Tables:
    """The parts of a load's tables as it makes them, after those of the ``last`` load."""

    def __init__(self, spark: SparkSession, root: str, last: dict, contract: Contract) -> None:
        self.spark, self.root, self.last = spark, root, last
        self.version = last["version"] + 1
        self.parts = {name: versions.parts_of(last, name) for name in ("rows", "keys", "dictionary", "files")}
        self.layouts = {
            "rows": (stored_schema(contract), "rejected boolean", in_files, split_rejects),
            "keys": (KEYS, "", by_hash, hashed_writer),
            "dictionary": (CODES, "", by_hash, hashed_writer),
            "files": (FILES, "", lambda df, rows: newest_files(df), plain),
        }

    def read(self, name: str, parts: Sequence[dict]) -> DataFrame:
        schema, partitions, *_ = self.layouts[name]
        return versions.read_parts(self.spark, parts, schema, partitions)

    def add(self, name: str, df: DataFrame, **measures: Column) -> tuple[dict, DataFrame]:
        """Write the rows of this load as a part; returns what was measured, and the part's rows."""
        path = versions.new_part(self.root, self.last, name)
        found = observed_write(self.layouts[name][3], df, path, **measures)
        part = {"path": path, "rows": found["rows"], "first": self.version, "last": self.version}
        if found["rows"]:
            self.parts[name] = [*self.parts[name], part]
        return found, self.read(name, [part])

    def merge(self) -> None:
        """Merge each table's last parts where they are due; only then are earlier rows written again."""
        for name, parts in self.parts.items():
            n = versions.to_merge(parts[:-1], parts[-1]["rows"]) if parts and parts[-1]["last"] == self.version else 0
            if n:
                due = parts[-1 - n :]
                _, _, laid_out, writer = self.layouts[name]
                path = versions.new_part(self.root, self.last, name)
                rows = sum(p["rows"] for p in due)
                found = observed_write(writer, laid_out(self.read(name, due), rows), path)
                merged = {"path": path, "rows": found["rows"], "first": due[0]["first"], "last": self.version}
                if "low" in due[0]:
                    merged |= {"low": min(p["low"] for p in due), "high": max(p["high"] for p in due)}
                self.parts[name] = [*parts[: -1 - n], merged]

    def commit(self, **fields) -> dict:
        self.merge()
        record = versions.commit(self.spark, self.root, "load", self.last, parts=json.dumps(self.parts), **fields)
        versions.expire(self.spark, self.root, record)
        return record


def newest_files(files: DataFrame) -> DataFrame:
    """One row per file: as the newest load saw it."""
    columns = files.columns
    return files.groupBy("source_file").agg(F.max_by(F.struct(*columns), "load_version").alias("f")).select("f.*")


def meeting(parts: Sequence[dict], low: str, high: str) -> list[dict]:
    """Parts of keys that may hold one from ``low`` to ``high``: none of those before, if ids only grow."""
    return [p for p in parts if p["low"] <= high and p["high"] >= low]


# Loads -----------------------------------------------------------------------


def stage(rows: DataFrame, contract: Contract, path: str) -> DataFrame:
    """Write landing rows once, checked row by row and converted.

    What follows reads columns instead of parsing text again, and only
    passes most of them on.
    """
    check_columns(rows, contract)
    keys = [key_text(c).alias(KEY) for c in contract.unique_columns]
    texts = [c for c in contract.names if c in rows.columns]
    line = F.xxhash64(*texts, BAD_WIDTH).alias(LINE_HASH)
    extra = [*COORDINATES, *row_checks(rows, contract), F.col(BAD_WIDTH).alias("raw_line"), line, *keys]
    prepared = typed(rows, contract, extra)
    with with_options(rows.sparkSession, SHORT_METHODS):
        plain(prepared).mode("append").parquet(path)
    return rows.sparkSession.read.schema(prepared.schema).parquet(path)


def append_positioned(
    spark: SparkSession, root: str, rows: DataFrame, contract: Contract, last: dict, lines: int,
    files: DataFrame | None = None, **origin,
) -> dict:
    """Judge and append ``lines`` staged rows; commit rows, keys, codes, read files and watermark at once.

    ``row_id`` is the position carried by the rows. It continues at the
    watermark of the ``last`` load and grows with every load; rejected rows
    leave gaps. ``origin`` is recorded with the commit.
    """
    tables = Tables(spark, root, last, contract)
    stored = size = None
    if contract.unique_columns and tables.parts["keys"]:
        low, high, *size = rows.agg(F.min(KEY), F.max(KEY), *size_columns(rows.select(KEY))).first()
        stored, size = tables.read("keys", meeting(tables.parts["keys"], low, high)), dict(zip(("rows", "bytes"), size, strict=True))
    checked = judge(rows, contract, "source_pos", KEY, stored, size)
    refused, width = F.col(REASON).isNotNull(), F.col(REASON) == "width"
    version = F.lit(tables.version).cast("bigint").alias("load_version")
    out = checked.select(F.col("source_pos").alias(ROW_ID), *contract.names, REASON, "raw_line", version, refused.alias("rejected"))
    counts, appended = tables.add("rows", out, errors=F.count_if(refused & ~width), width_errors=F.count_if(width))
    accepted = counts["rows"] - counts["errors"] - counts["width_errors"]
    batch = appended.where(~F.col("rejected"))
    if contract.unique_columns and accepted:
        keys = batch.select(key_text(contract.unique_columns[0]).alias("key")).withColumn(HASH, key_hash("key"))
        found, _ = tables.add("keys", by_hash(keys, accepted), low=F.min("key"), high=F.max("key"))
        tables.parts["keys"][-1] |= {"low": found["low"], "high": found["high"]}
    codes, sizes = 0, json.loads(last["schema"] or "{}")
    if contract.dictionary_columns and accepted:
        known = tables.read("dictionary", tables.parts["dictionary"])
        if last["total_codes"] <= FEW_CODES:
            known = known.drop(HASH)  # read whole, it isn't worth looking up where
        entries = dictionary.new_entries(known, batch, contract.dictionary_columns, ROW_ID, sizes)
        coded = entries.withColumns({HASH: key_hash("column", "value"), "load_version": version})
        of_column = {f"_{i}": F.count_if(F.col("column") == c) for i, c in enumerate(contract.dictionary_columns)}
        found, _ = tables.add("dictionary", by_hash(coded), **of_column)
        codes = found["rows"]
        sizes = {c: sizes.get(c, 0) + found[f"_{i}"] for i, c in enumerate(contract.dictionary_columns)}
    if files is not None:
        tables.add("files", files.withColumn("load_version", version))
    return tables.commit(
        watermark=last["watermark"] + lines,
        rows=accepted,
        total_rows=last["total_rows"] + accepted,
        errors=counts["errors"],
        width_errors=counts["width_errors"],
        codes=codes,
        total_codes=last["total_codes"] + codes,
        schema=json.dumps(sizes),
        **origin,
    )


def stage_files(spark: SparkSession, changed: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """The staged rows of files, and the files whose reading began in a later block than their first.

    A file that grew is read from the block on in which the last load ended.
    The last line that it read must still be there; a file that was written
    anew is read from its beginning.
    """
    listed = [r.asDict() for r in changed.select("path", "source_file", "file_size", "seen_size", "tail_start").collect()]
    grown = [
        r["path"]
        for r in listed
        if r["tail_start"] and r["tail_start"] % csv.SPLIT_BYTES == 0 and r["file_size"] > r["seen_size"]
    ]
    resumed = changed.where(F.col("path").isin(grown)) if grown else changed.limit(0)
    path = scratch_path(spark, "staged")
    with with_splits(spark, csv.SPLIT_BYTES):
        if grown:
            tail = stage(read_tails(spark, resumed, contract), contract, path)
            place = F.row_number().over(Window.partitionBy("source_file").orderBy("source_block", "source_row")) - 1
            lines = tail.join(F.broadcast(resumed.select("source_file", "tail_start", "tail_line", "seen_lines", "tail_hash")), "source_file")
            first = lines.where(F.col("source_block") == F.col("tail_start")).withColumn("_place", place + F.col("tail_line"))
            same = first.where((F.col("_place") == F.col("seen_lines") - 1) & (F.col(LINE_HASH) == F.col("tail_hash")))
            unchanged = {r[0] for r in same.join(resumed, "source_file").select("path").distinct().collect()}
            if unchanged != set(grown):
                # Written anew: begin again with those that only grew.
                resumed = changed.where(F.col("path").isin(list(unchanged))) if unchanged else changed.limit(0)
                grown, path = list(unchanged), scratch_path(spark, "staged")
                if grown:
                    tail = stage(read_tails(spark, resumed, contract), contract, path)
        rest = sorted({r["path"] for r in listed} - set(grown))
        staged = stage(read_rows(spark, rest, contract), contract, path) if rest else tail
    return staged, resumed


def append_load(spark: SparkSession, source: str, root: str, contract: Contract) -> dict:
    """Load the lines of ``source`` that were not loaded before; returns the newest load record.

    Files may be added and lines may be appended to files. A file is read
    again if its size or its modification time differs from what a load saw,
    from the line on where that load ended; one without new lines is recorded
    too. Sizes are taken before reading, so lines that arrive meanwhile are
    found by the next load.
    """
    last = versions.latest(spark, root, "load")
    consumed = consumed_files(spark, root, last).drop("load_version")
    listed = list_files(spark, source).join(consumed, "source_file", "left")
    same = F.col("file_size").eqNullSafe(F.col("seen_size")) & F.col("modified").eqNullSafe(F.col("seen_modified"))
    changed = checkpointed(listed.where(~same).withColumnRenamed("lines", "seen_lines"))
    if changed.isEmpty():
        return last

    staged, resumed = stage_files(spark, changed, contract)
    began = resumed.select("source_file", F.col("tail_line").alias("began"))
    skip = changed.select("source_file", F.col("seen_lines").alias("lines")).join(began, "source_file", "left")
    blocks = source_blocks(staged, skip, LINE_HASH)
    placed = with_position(staged, blocks, last["watermark"])
    rows = resume_scan(placed, "skipped", "source_line").drop("skipped", "source_line")
    files = read_files(changed, blocks)
    if not blocks.new_lines:
        tables = Tables(spark, root, last, contract)
        tables.add("files", files.withColumn("load_version", F.lit(tables.version).cast("bigint")))
        record = tables.commit(source=source, **{c: last[c] for c in ("watermark", "total_rows", "total_codes", "schema")})
    else:
        record = append_positioned(spark, root, rows, contract, last, blocks.new_lines, files, source=source)
    remove_staged(spark, staged)
    return record


def read_files(changed: DataFrame, blocks: Blocks) -> DataFrame:
    """What to remember of the files that were read: their lines, and where their last block begins."""
    line_end = F.col("line_start") + F.col("block_rows")
    ends = blocks.table.groupBy("source_file").agg(
        F.max(line_end).alias("read"), F.max_by(F.struct("source_block", "line_start", "block_last"), "source_block").alias("b"), F.max("skipped").alias("had")
    )
    found = changed.select("source_file", "file_size", "modified", "seen_lines").join(ends, "source_file", "left")
    # A file that became shorter keeps its line count, and has no place to resume at.
    shorter = F.coalesce(F.col("read") < F.col("had"), F.lit(True))
    return found.select(
        "source_file",
        "file_size",
        "modified",
        F.coalesce(F.greatest("read", "had"), "seen_lines", F.lit(0)).cast("bigint").alias("lines"),
        F.when(~shorter, F.col("b.source_block")).otherwise(0).cast("bigint").alias("tail_start"),
        F.when(~shorter, F.col("b.line_start")).otherwise(0).cast("bigint").alias("tail_line"),
        F.when(~shorter, F.col("b.block_last")).alias("tail_hash"),
    )


def remove_staged(spark: SparkSession, staged: DataFrame) -> None:
    """Free the staged rows of a committed load."""
    for path in {f.rpartition("/")[0] for f in staged.inputFiles()}:
        versions.remove(spark, path)


def append_batch(batch: DataFrame, batch_id: int, root: str, contract: Contract, source: str) -> dict:
    """Load one micro-batch of landing rows, unless ``source`` committed it before."""
    spark = batch.sparkSession
    heads = versions.heads(spark, root)
    last = heads["load", None]
    if batch_id <= heads["load", source]["batch_id"]:
        return last
    staged = stage(with_row(batch), contract, scratch_path(spark, "staged"))
    blocks = source_blocks(staged)
    rows = with_position(staged, blocks, last["watermark"]).drop("skipped", "source_line")
    record = append_positioned(spark, root, rows, contract, last, blocks.new_lines, source=source, batch_id=batch_id)
    remove_staged(spark, staged)
    return record


def new_rows(
    spark: SparkSession, root: str, contract: Contract, columns: list[str], merged: dict, last: dict
) -> DataFrame:
    """Accepted rows of the loads after the one that ``merged`` holds, up to ``last``; parts of earlier loads alone aren't read."""
    fresh = fact_table(spark, root, contract, last, after=merged["of_version"])
    return scan_range(fresh, columns, merged["watermark"], last["watermark"], ROW_ID)
