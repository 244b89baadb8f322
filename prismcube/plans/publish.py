"""Serve a stored cube: one typed relation per cuboid, all of them switched at once.

What is served are parts, each the rows of some slots: ranges of a cuboid's
buckets. A slot's rows are those of the newest part that has it. Each
part is a catalog table; one view, ``all_cuboids``, reads the parts, and a view
per cuboid reads that one, so replacing the text of ``all_cuboids`` changes all cuboids over together. A new
version writes the slots that the cube's deltas touch, to a folder of its own;
files that are being served are never written or deleted by an attempt.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import versions
from ..functions.measures import MEASURES
from ..functions.naming import cuboid_names, mask_dimensions
from ..operators.cube import MASK
from ..sinks.cuboids import REPORT, rounded
from .cube import BUCKET, BUCKETS, bucket_of, dimensions, merged_rows, parquet_writer, read_stored, stored_parts
from .load import observed_write

#: The view that reads the parts.
ALL = "all_cuboids"
#: Groups of a slot, the least that is written anew.
SLOT_ROWS = 1_000_000
#: Parts that are served side by side.
MOST_PARTS = 6
#: Touched ranges that are named in a filter; more meet in a join.
MOST_NAMED = 500

Slots = dict[int, list[int]]  # of each cuboid


def slots_of(spark: SparkSession, cube: dict) -> dict[int, int]:
    """How many slots a cuboid is cut into, by its groups; a power of two, at most one per bucket."""
    rows = stored_parts(spark, cube).groupBy(MASK).agg(F.count(F.lit(1)).alias("rows")).collect()
    return {r[MASK]: min(BUCKETS, 1 << max(0, -(-r["rows"] // SLOT_ROWS) - 1).bit_length()) for r in rows}


def ranges_of(slots: Slots, layout: dict[int, int]) -> list[tuple[int, int, int]]:
    """Cuboid and first and last bucket of runs of slots."""
    found: list[tuple[int, int, int]] = []
    for mask, own in sorted(slots.items()):
        wide = BUCKETS // layout.get(mask, 1)
        for slot in sorted(own):
            if found and found[-1][0] == mask and found[-1][2] == slot * wide - 1:
                found[-1] = (mask, found[-1][1], slot * wide + wide - 1)
            else:
                found.append((mask, slot * wide, slot * wide + wide - 1))
    return found


def inside(ranges: Sequence[tuple[int, int, int]]) -> str:
    """Whether a row lies in one of the ranges, as SQL."""
    texts = [f"({MASK} = {mask} AND {BUCKET} BETWEEN {low} AND {high})" for mask, low, high in ranges]
    return " OR ".join(texts) if texts else "false"


def slot_column(layout: dict[int, int]) -> Column:
    """The slot of a row of a stored cube; a cuboid that the layout doesn't know is one slot."""
    counts = reduce(lambda c, m: c.when(F.col(MASK) == m, F.lit(layout[m])), sorted(layout), F.when(F.lit(False), F.lit(1)))
    return F.floor(F.col(BUCKET) * counts.otherwise(F.lit(1)) / F.lit(BUCKETS)).cast("int")


def touched_slots(spark: SparkSession, deltas: Sequence[dict], schema: str, layout: dict[int, int]) -> Slots:
    """The slots that hold a group of the deltas; there are at most as many as the layout has."""
    rows = read_stored(spark, deltas, schema).select(MASK, slot_column(layout).alias("slot")).distinct().collect()
    found: Slots = {}
    for r in rows:
        found.setdefault(r[MASK], []).append(r["slot"])
    return found


def union_of(some: Sequence[Slots]) -> Slots:
    return {m: sorted({s for own in some for s in own.get(m, ())}) for m in sorted({m for own in some for m in own})}


def rows_of(spark: SparkSession, cube: dict, slots: Slots | None, layout: dict[int, int]) -> DataFrame:
    """The rows of a cube version that are to be served, of all slots or of some."""
    rows = stored_parts(spark, cube)
    if slots is not None:
        ranges = ranges_of(slots, layout)
        if len(ranges) <= MOST_NAMED:
            rows = rows.where(inside(ranges))
        else:
            wanted = [(m, s) for m, own in slots.items() for s in own]
            wanted = F.broadcast(spark.createDataFrame(wanted, f"{MASK} int, slot int"))
            rows = rows.withColumn("slot", slot_column(layout)).join(wanted, [MASK, "slot"], "left_semi").drop("slot")
    state = rounded(merged_rows(rows))
    return state.withColumns({m: F.col(m).cast("double") for m in MEASURES if m != "count"})


def deltas_since(spark: SparkSession, root: str, cube: dict, version: int) -> list[dict] | None:
    """The deltas of the versions after one, or ``None`` where one of them is a new cube or has expired."""
    after = [r for r in versions.recent(spark, root) if r["kind"] == "cube" and version < r["version"] <= cube["version"]]
    known = after[-versions.KEPT_VERSIONS :]
    if len(known) != cube["version"] - version or any(not versions.parts_of(r, "delta") for r in known):
        return None
    return [d for r in known for d in versions.parts_of(r, "delta")]


def part_table(path: str) -> str:
    """The name of the catalog table that reads a part: it has the part's schema, so none is inferred."""
    return "part_" + path.rpartition("=")[2]


def all_cuboids_text(database: str, parts: Sequence[dict], layout: dict[int, int], columns: Sequence[tuple[str, str]]) -> str:
    """The query of ``all_cuboids``: of each part the slots that no later one has."""
    listed = ", ".join(f"`{c}`" for c, _ in columns)
    legs = []
    for i, part in enumerate(parts):
        later = union_of([{int(m): s for m, s in p["slots"].items()} for p in parts[i + 1 :]])
        legs.append(f"SELECT {listed} FROM `{database}`.`{part_table(part['path'])}` WHERE NOT ({inside(ranges_of(later, layout))})")
    return " UNION ALL ".join(legs)


def drop_parts(spark: SparkSession, database: str, kept: set[str]) -> None:
    """Drop the tables of parts that are no longer kept."""
    names = {part_table(path) for path in kept}
    for row in spark.sql(f"SHOW TABLES IN `{database}` LIKE 'part_*'").collect():
        if row["tableName"] not in names:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{row['tableName']}`")


def ensure_view(spark: SparkSession, database: str, name: str, columns: Sequence[tuple[str, str]], mask: int) -> None:
    """A view of one cuboid; one that is there with these columns stays as it is."""
    full = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(f"{database}.{name}"):
        if spark.catalog.getTable(f"{database}.{name}").tableType == "VIEW" and spark.table(full).dtypes == list(columns):
            return
        if spark.catalog.getTable(f"{database}.{name}").tableType != "VIEW":
            spark.sql(f"DROP TABLE {full}")
    listed = ", ".join(f"`{c}`" for c, _ in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {listed} FROM `{database}`.`{ALL}` WHERE {MASK} = {mask}")


def publish_cube(spark: SparkSession, root: str, dims: Sequence[str], location: str, database: str) -> DataFrame:
    """Serve the newest cube version as the relations of ``database``; returns a report per cuboid.

    What was served before and the deltas since say which slots to write, into
    a new folder below ``location``; then all cuboids change over at once. An
    attempt that fails leaves readers as they were, and the next one begins
    from the last version that was committed. NULL and the empty text stay
    apart. Serving the version that is served already does nothing and gives
    an empty report.
    """
    heads = versions.heads(spark, root)
    cube, last = heads["cube", None], heads["publish", database]
    if cube["parts"] is None:
        raise LookupError("there is no stored cube to publish")
    if last["of_version"] == cube["version"]:
        return spark.createDataFrame([], REPORT)

    served = versions.parts_of(last, "served")
    deltas = deltas_since(spark, root, cube, last["of_version"]) if served else None
    if deltas is None or last["schema"] is None or json.loads(last["schema"])["cube"] != cube["schema"]:
        layout, served, slots = slots_of(spark, cube), [], None
    else:
        layout = {int(m): n for m, n in json.loads(last["schema"])["layout"].items()}
        slots = touched_slots(spark, deltas, cube["schema"], layout)
        if len(served) >= MOST_PARTS:
            # What lies over the first part is written as one.
            later = [{int(m): s for m, s in p["slots"].items()} for p in served[1:]]
            slots, served = union_of([slots, *later]), served[:1]
            if 2 * sum(p["rows"] for p in versions.parts_of(last, "served")[1:]) > served[0]["rows"]:
                layout, served, slots = slots_of(spark, cube), [], None

    rows = rows_of(spark, cube, slots, layout)
    columns = [(c, kind) for c, kind in rows.dtypes if c in dims or c in MEASURES]
    path = versions.new_part(location, last, "served")
    sorted_rows = rows.repartitionByRange(MASK, BUCKET).sortWithinPartitions(MASK, BUCKET, *dimensions(rows.columns))
    found = observed_write(parquet_writer, sorted_rows, path)
    parts = [*served, {"path": path, "rows": found["rows"], "slots": slots or {}}]

    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    first = not spark.catalog.tableExists(f"{database}.{ALL}")
    stored = ", ".join(f"`{c}` {kind}" for c, kind in rows.dtypes)
    spark.sql(f"CREATE TABLE `{database}`.`{part_table(path)}` ({stored}) USING parquet LOCATION '{path}'")
    text = all_cuboids_text(database, parts, layout, [(MASK, "int"), (BUCKET, "int"), *columns])
    if first:
        spark.sql(f"CREATE VIEW `{database}`.`{ALL}` AS {text}")
    kinds = dict(columns)
    for mask, name in enumerate(cuboid_names(dims)):
        ensure_view(spark, database, name, [(c, kinds[c]) for c in (*mask_dimensions(dims, mask), *MEASURES)], mask)
    if not first:
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{ALL}` AS {text}")
    record = versions.commit(
        spark, root, "publish", last, source=database, watermark=cube["watermark"], of_version=cube["version"],
        rows=found["rows"], parts=json.dumps({"served": parts}), schema=json.dumps({"cube": cube["schema"], "layout": layout}),
    )
    versions.expire(spark, root, record, database)
    drop_parts(spark, database, kept_paths(spark, root, database))
    return spark.createDataFrame([(name, True, None) for name in cuboid_names(dims)], REPORT)


def published(spark: SparkSession, root: str, database: str) -> dict:
    """The record of what ``database`` serves: ``of_version`` of the cube, and its ``watermark``."""
    return versions.heads(spark, root)["publish", database]


def served_row(spark: SparkSession, database: str, dims: Sequence[str], key: dict[str, object]) -> DataFrame:
    """The served row of one group; its bucket reaches the statistics of the parts."""
    rows = spark.table(f"`{database}`.`{ALL}`")
    kinds = dict(rows.dtypes)
    mask = sum(1 << i for i, d in enumerate(dims) if d in key)
    bucket = bucket_of(*[F.lit(key.get(d)).cast(kinds[d]) for d in dims])
    own = rows.where((F.col(MASK) == mask) & (F.col(BUCKET) == bucket))
    for d, value in key.items():
        own = own.where(F.col(d).eqNullSafe(F.lit(value)))
    return own.select(*mask_dimensions(dims, mask), *MEASURES)


def kept_paths(spark: SparkSession, root: str, database: str) -> set[str]:
    """The parts of the versions of a database that stay readable."""
    rows = [r for r in versions.recent(spark, root) if r["kind"] == "publish" and r["source"] == database]
    return {path for r in rows[-versions.KEPT_VERSIONS :] for path in versions.paths_in(r)}


def sweep_served(spark: SparkSession, root: str, location: str, database: str) -> list[str]:
    """Delete parts of failed attempts and of earlier epochs that neither a kept version nor the view names."""
    kept = kept_paths(spark, root, database)
    text = spark.sql(f"SHOW CREATE TABLE `{database}`.`{ALL}`").first()[0] if spark.catalog.tableExists(f"{database}.{ALL}") else ""
    gone = []
    for epoch, _ in versions.listed(spark, location):
        for part, _ in versions.listed(spark, f"{location}/{epoch}/served"):
            path = f"{location}/{epoch}/served/{part}"
            if path not in kept and part_table(path) not in text:
                gone.append(path)
    for path in gone:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{part_table(path)}`")
        versions.remove(spark, path)
    return gone
