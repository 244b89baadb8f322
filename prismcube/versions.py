"""Commit log: small records that say which data is valid, and the parts of which tables consist.

Data is written first, to a folder of its own that no reader looks at yet;
appending one record then makes it visible. A job that dies earlier leaves the
last record, and with it all readers, as they were. One writer at a time is
assumed.

A log begins with an epoch, which is part of every data path. Creating the log
again begins a new one: data and late commits of the old epoch are out of
reach.

Records go to a generation, a folder with one file each. Once it holds
``GENERATION`` of them, a new one begins with the newest few of each kind in one
file, so the newest records are found in a bounded number of files and records
however many there were; all of them are kept, in one file too, for reports.

A table is a list of parts, which a record names. Once a new part and the ones
before it make ``FAN_IN`` of like size they are merged, so sizes grow
geometrically towards the older ones: a row is rewritten a logarithmic number of
times, and readers meet a logarithmic number of parts.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = (
    "kind string, version bigint, epoch string, watermark bigint, watermark_before bigint, source string, "
    "batch_id bigint, rows bigint, total_rows bigint, errors bigint, width_errors bigint, codes bigint, "
    "total_codes bigint, cuboids bigint, of_version bigint, parts string, schema string, committed_at timestamp"
)
NOTHING = {
    "kind": None,
    "version": 0,
    "epoch": None,
    "watermark": 0,
    "watermark_before": 0,
    "source": None,
    "batch_id": -1,
    "rows": 0,
    "total_rows": 0,
    "errors": 0,
    "width_errors": 0,
    "codes": 0,
    "total_codes": 0,
    "cuboids": 0,
    "of_version": 0,
    "parts": None,
    "schema": None,
}
#: Versions of derived data that stay readable.
KEPT_VERSIONS = 4
#: Records after which a new generation begins.
GENERATION = 32
#: So many parts of like size become one.
FAN_IN = 4


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{SCHEMA}, generation bigint").parquet(path)


def generations(spark: SparkSession, path: str) -> list[int]:
    """The generations of which a folder holds records."""
    return sorted(int(name.partition("=")[2]) for name, _ in listed(spark, path) if name.startswith("generation="))


def recent(spark: SparkSession, root: str) -> list[dict]:
    """The records of the newest generation and epoch, oldest first; each knows its generation and their number."""
    if not generations(spark, f"{root}/commits"):
        raise FileNotFoundError(f"{root} holds no commit log; create the tables first")
    rows = [r.asDict() for r in read_records(spark, f"{root}/commits").collect()]
    newest = max(r["generation"] for r in rows)
    rows = [r for r in rows if r["generation"] == newest]
    epoch = next(r["epoch"] for r in rows if r["kind"] == "init")
    return [r | {"records": len(rows)} for r in sorted(rows, key=lambda r: r["version"]) if r["epoch"] == epoch]


def commits(spark: SparkSession, root: str) -> DataFrame:
    """All records of the current epoch, once each; the log must have been created with ``reset``."""
    newest = recent(spark, root)[0]
    current = read_records(spark, f"{root}/commits").where(F.col("generation") == newest["generation"])
    if newest["generation"] - 1 in generations(spark, f"{root}/history"):
        before = read_records(spark, f"{root}/history").where(F.col("generation") == newest["generation"] - 1)
        current = current.unionByName(before)
    names = T.StructType.fromDDL(SCHEMA).names
    once = Window.partitionBy("kind", "source", "version").orderBy("generation")
    own = current.where(F.col("epoch") == F.lit(newest["epoch"]))
    return own.withColumn("_copy", F.row_number().over(once)).where("_copy = 1").select(*names)


def heads(spark: SparkSession, root: str) -> dict[tuple[str, str | None], dict]:
    """The newest record per ``(kind, source)``, and per ``(kind, None)`` of all sources.

    All-zero, but for the epoch, where there is none.
    """
    rows = recent(spark, root)
    empty_ = NOTHING | {k: rows[0][k] for k in ("epoch", "generation", "records")}
    found = defaultdict(lambda: dict(empty_))
    for row in rows:
        found[row["kind"], row["source"]] = found[row["kind"], None] = row
    return found


def latest(spark: SparkSession, root: str, kind: str) -> dict:
    """The newest record of a kind; an all-zero one when there is none."""
    return heads(spark, root)[kind, None]


def record_rows(spark: SparkSession, records: Iterable[dict]) -> DataFrame:
    fields = T.StructType.fromDDL(SCHEMA)
    rows = F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields]) for r in records])
    return spark.range(1, numPartitions=1).select(F.inline(rows))


def commit(spark: SparkSession, root: str, kind: str, last: dict, **fields) -> dict:
    """Append the record that follows ``last``, one that ``heads`` gave."""
    now = datetime.now(timezone.utc)
    before = {"epoch": last["epoch"], "version": last["version"] + 1, "watermark_before": last["watermark"]}
    record = NOTHING | {"kind": kind, "committed_at": now} | before | fields
    generation = last.get("generation", 0)
    record_rows(spark, [record]).write.mode("append").parquet(f"{root}/commits/generation={generation}")
    record |= {"generation": generation, "records": last.get("records", 1) + 1}
    if record["records"] >= GENERATION:
        begin_generation(spark, root)
    return record


def by_series(rows: Iterable[dict]) -> dict[tuple, list[dict]]:
    """Records by what they are versions of: their kind, and of served tables the database."""
    found: dict[tuple, list[dict]] = defaultdict(list)
    for row in rows:
        found[row["kind"], row["source"] if row["kind"] == "publish" else None].append(row)
    return found


def begin_generation(spark: SparkSession, root: str) -> None:
    """Copy all records to the history and the newest few of each kind and source to a new generation.

    The copies are one file each, and the new generation counts as soon as its
    file is there. The one before it stays until the next, for readers that
    are still at it.
    """
    rows = recent(spark, root)
    old = rows[0]["generation"]
    replace(commits(spark, root).coalesce(1), f"{root}/history/generation={old}")
    newest = {(r["kind"], r["source"]): r for r in rows}
    few = [r for own in by_series(rows).values() for r in own[-2 * KEPT_VERSIONS :]]
    unique = {(r["kind"], r["source"], r["version"]): r for r in [*newest.values(), *few]}
    replace(record_rows(spark, unique.values()), f"{root}/commits/generation={old + 1}")
    for path in (f"{root}/commits/generation={old - 1}", f"{root}/history/generation={old - 1}"):
        remove(spark, path)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """No rows of a schema, in one partition."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
    return spark.range(0, numPartitions=1).select(*columns)


def reset(spark: SparkSession, root: str) -> None:
    """Create an empty log: every watermark is 0 (again), and earlier data is out of reach."""
    record = NOTHING | {"kind": "init", "epoch": uuid.uuid4().hex, "committed_at": datetime.now(timezone.utc)}
    # Late commits go to the generation that their load began in, so the new epoch begins one beyond it.
    old = generations(spark, f"{root}/commits")
    replace(record_rows(spark, [record]), f"{root}/commits/generation={max(old, default=-1) + 1}")
    for path in (*(f"{root}/commits/generation={g}" for g in old), f"{root}/history"):
        remove(spark, path)


def has_new(loaded: dict, merged: dict) -> bool:
    """Whether rows were loaded beyond the watermark of a derived table."""
    return loaded["watermark"] > merged["watermark"]


# Folders ---------------------------------------------------------------------


def folder(root: str, last: dict, name: str) -> str:
    """Where the data called ``name`` of an epoch is."""
    return f"{root}/{last['epoch']}/{name}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    system, place = file_system(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name, in place of what has it."""
    remove(spark, to)
    system, place = file_system(spark, path)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed")


def listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names in a folder with their modification times in milliseconds; none where it is missing."""
    system, place = file_system(spark, path)
    if not system.exists(place):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(place)]


def replace(df: DataFrame, path: str) -> None:
    """Write to a folder, without what a failed attempt left there.

    Unlike mode ``overwrite`` this doesn't depend on how a session overwrites
    partitions.
    """
    remove(df.sparkSession, path)
    df.write.parquet(path)


# Parts -----------------------------------------------------------------------


def new_part(root: str, last: dict, table: str) -> str:
    """The path of a part that no other attempt writes to."""
    return folder(root, last, f"{table}/part={uuid.uuid4().hex}")


def parts_of(record: dict, table: str) -> list[dict]:
    """The parts of a table as of a record, oldest first: ``path``, ``rows`` and what else was noted."""
    return json.loads(record["parts"] or "{}").get(table, [])


def to_merge(parts: Sequence[dict], rows: int) -> int:
    """How many of the last parts a new one of so many rows is merged with: those not larger than all after them, if many."""
    n = 0
    while n < len(parts) and parts[-1 - n]["rows"] <= rows:
        rows += parts[-1 - n]["rows"]
        n += 1
    return n if n + 1 >= FAN_IN else 0


def read_parts(spark: SparkSession, parts: Sequence[dict], schema: T.StructType | str, partitions: str = "") -> DataFrame:
    """The rows of some parts, with the columns of ``schema`` and then ``partitions``."""
    full = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    extra = T.StructType.fromDDL(partitions) if partitions else T.StructType([])
    filled = [p["path"] for p in parts if p["rows"]]
    if not filled:
        return empty(spark, T.StructType([*full.fields, *extra.fields]))
    base = filled[0].rpartition("/")[0]
    try:
        rows = spark.read.schema(T.StructType([*full.fields, *extra.fields])).option("basePath", base).parquet(*filled)
    except AnalysisException as error:
        if is_missing_path(error):
            raise LookupError(f"a part has expired: {error.getMessageParameters().get('path', '')}") from None
        raise
    return rows.select(*full.names, *extra.names)


def paths_in(record: dict) -> set[str]:
    """All paths that a record names."""
    return {p["path"] for parts in json.loads(record["parts"] or "{}").values() for p in parts}


def expire(spark: SparkSession, root: str, record: dict, source: str | None = None) -> None:
    """Delete the parts that only versions before the last ``KEPT_VERSIONS`` refer to, after a new ``record``.

    Versions are those of the record's kind, or of one ``source`` of it. The
    last few before them are looked at, as older ones expired before.
    """
    if record["version"] <= KEPT_VERSIONS:
        return
    same = by_series(recent(spark, root))[record["kind"], source]
    kept = {path for r in same[-KEPT_VERSIONS:] for path in paths_in(r)}
    for path in {path for r in same[:-KEPT_VERSIONS] for path in paths_in(r)} - kept:
        remove(spark, path)


def sweep(spark: SparkSession, root: str) -> list[str]:
    """Delete what no kept version of the current epoch reaches: earlier epochs and parts of failed attempts.

    A writer's task, like a load: what an unfinished one wrote counts as left
    over. Returns the paths.
    """
    rows = recent(spark, root)
    epoch = rows[0]["epoch"]
    kept = {path for own in by_series(rows).values() for r in own[-KEPT_VERSIONS:] for path in paths_in(r)}
    kept_names = {tuple(path.rsplit("/", 3)[-3:]) for path in kept}
    gone = [f"{root}/{name}" for name, _ in listed(spark, root) if len(name) == 32 and set(name) <= set("0123456789abcdef") and name != epoch]
    for table, _ in listed(spark, f"{root}/{epoch}"):
        for part, _ in listed(spark, f"{root}/{epoch}/{table}"):
            if (epoch, table, part) not in kept_names and part.startswith("part="):
                gone.append(f"{root}/{epoch}/{table}/{part}")
    for path in gone:
        remove(spark, path)
    return gone
