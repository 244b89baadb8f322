"""CSV sources: dimension files, positional landing files, published cuboid files."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract
from ..operators.joins import measured
from ..session import with_options

BAD_WIDTH = "_corrupt_record"
COORDINATES = ("source_file", "source_block", "source_row")
#: Header lines that are read at a time.
CONCURRENT_READS = 16
#: Bytes at whose multiples landing files are cut.
SPLIT_BYTES = 32 << 20
#: What the CSV reader skips: lines of blanks and control characters.
BLANK_LINE = r"^[\x00-\x20]*$"

#: Timestamps as text, to the microsecond, with and without a time zone.
TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# Types of published columns by name; any other column is a string.
MEASURE_TYPES = {
    "sum_amount": "double",
    "avg_amount": "double",
    "min_amount": "double",
    "max_amount": "double",
    "count": "bigint",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header; quoted fields may hold commas and doubled quotes, blanks are kept."""
    return spark.read.schema(schema).options(header="true", escape='"', **TIMESTAMPS).csv(path)


def landing_schema(contract: Contract) -> T.StructType:
    """All columns as text, plus the raw line of rows with the wrong number of fields."""
    return T.StructType([*contract.text_schema.fields, T.StructField(BAD_WIDTH, T.StringType())])


def landing_options() -> dict[str, str]:
    """Options of landing files.

    Column pruning is off in the parser because a pruned parse would not
    notice a wrong number of fields.
    """
    return {"header": "true", "escape": '"', "columnPruning": "false", "mode": "PERMISSIVE"}


def with_block(rows: DataFrame) -> DataFrame:
    """Add the file and the block (input split) each row came from."""
    return rows.select(
        *rows.columns,
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_block"),
    )


def with_splits(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Within it, jobs cut files at multiples of ``size`` bytes, whatever else they read and wherever they run.

    So a file is cut alike at every load, and a place in it can be kept as the
    start of a block and the lines before that.
    """
    return with_options(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": str(size)})


def with_row(rows: DataFrame) -> DataFrame:
    """Add a number that grows along the rows of a block."""
    return rows.withColumn("source_row", F.monotonically_increasing_id())


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of a source with their sizes and modification times; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def read_rows(spark: SparkSession, path: str | list[str], contract: Contract) -> DataFrame:
    """Landing rows as text, bound by position, with their coordinates in the source.

    Blank lines are skipped. Write the result to a table before using the
    coordinates twice.
    """
    reader = spark.read.schema(landing_schema(contract)).options(**landing_options())
    return with_row(with_block(reader.csv(path)))


def read_tails(spark: SparkSession, starts: DataFrame, contract: Contract) -> DataFrame:
    """``read_rows`` of the blocks from ``tail_start`` on of the files ``path, source_file, tail_start``.

    Lines of earlier blocks are passed over without being parsed. A tail must
    not begin with its file, whose first line is a header.
    """
    paths = [r["path"] for r in starts.select("path").collect()]
    lines = with_row(with_block(spark.read.text(sorted(paths))).where(~F.col("value").rlike(BLANK_LINE)))
    new = lines.join(measured(starts.select("source_file", "tail_start")), "source_file").where(F.col("source_block") >= F.col("tail_start"))
    ddl = ", ".join(f"`{f.name}` string" for f in landing_schema(contract).fields)
    options = {k: v for k, v in landing_options().items() if k != "header"} | {"columnNameOfCorruptRecord": BAD_WIDTH}
    parsed = new.select(F.from_csv("value", ddl, options).alias("r"), *COORDINATES)
    return parsed.select("r.*", *COORDINATES)


def discover(spark: SparkSession, folder: str) -> list[tuple[str, str, T.StructType]]:
    """Tables below ``folder``: ``(name, path, schema)``, sorted by name.

    A table is a ``.csv`` file or a ``.csv`` folder of part files. Only file
    names, sizes and header lines are read; tables without bytes are skipped.
    """
    root = folder.rstrip("/")
    tail = re.escape(re.sub(r"^[a-z0-9]+:/*", "/", root))
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter="*.csv")
        .load(root)
        .select(F.regexp_extract("path", tail + r"/([^/]+)\.csv(?:/|$)", 1).alias("name"), "length")
    )
    sized = files.groupBy("name").agg(F.sum("length").alias("bytes")).where("bytes > 0")

    def described(name: str) -> tuple[str, str, T.StructType]:
        path = f"{root}/{name}.csv"
        columns = spark.read.csv(path, header=True, escape='"').columns
        return name, path, T.StructType.fromDDL(", ".join(f"`{c}` {MEASURE_TYPES.get(c, 'string')}" for c in columns))

    names = [row["name"] for row in sized.orderBy("name").collect()]
    with ThreadPoolExecutor(CONCURRENT_READS) as pool:
        return list(pool.map(described, names))
