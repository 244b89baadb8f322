"""One query per operator, over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube import versions
from prismcube.contract import CUBE_DIMENSIONS, SALES, ColumnSpec, Contract
from prismcube.functions.conversion import to_float_lenient, to_int_lenient
from prismcube.functions.measures import finish
from prismcube.operators import columns, cube, dictionary, numbering, star, validation
from prismcube.operators.joins import broadcast_if_small, left_join, renamed_role
from prismcube.plans import cube as stored
from prismcube.plans import load
from prismcube.plans.publish import publish_cube
from prismcube.scratch import checkpointed, scratch_path, written
from prismcube.sinks.csv import write_csv
from prismcube.sinks.cuboids import checked, export_cuboids, numbered_cuboid, publish_tables
from prismcube.sources import csv, tables
from prismcube.sources.dates import date_dimension
from prismcube.streaming.load import stream_load
from prismcube.streaming.load import stream_refresh as start_refresh

from .tables import FIRST_DAY, LAST_DAY, cube_rows, sales_star, table

DIMS = list(CUBE_DIMENSIONS)
SMALL_DIMS = ["category", "customer_segment", "campaign_name"]
AMOUNT = "total_amount"

# Orders as landing rows: customers are joined, so an unmatched order has no customer_id.
ORDER_CONTRACT = Contract(
    (
        ColumnSpec("sales_id", not_null=True, unique=True, role="fact"),
        ColumnSpec("sales_date", not_null=True, role="fact"),
        ColumnSpec("total_amount", kind="float", not_null=True, role="fact"),
        ColumnSpec("customer_id", not_null=True),
        ColumnSpec("customer_segment", dictionary=True),
        ColumnSpec("store_type", dictionary=True),
        ColumnSpec("salesperson_role", dictionary=True),
        ColumnSpec("residential_location", dictionary=True),
        ColumnSpec("order_year", kind="integer"),
        ColumnSpec("order_quarter", kind="integer"),
    )
)
ORDER_DIMS = ["residential_location", "order_year", "customer_segment", "store_type", "order_quarter", "salesperson_role"]


def amount_as_double(df: DataFrame) -> DataFrame:
    return df.withColumn(AMOUNT, F.col(AMOUNT).cast("double"))


# Scans ---------------------------------------------------------------------


def scan_projected(spark: SparkSession, sf: str) -> DataFrame:
    return tables.scan(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_returnflag", "l_linestatus", "l_extendedprice"]
    )


def scan_row_range(spark: SparkSession, sf: str) -> DataFrame:
    """Four consecutive ranges that hold all orders."""
    orders = table(spark, sf, "orders")
    quarters = [(i, 4) for i in range(1, 4)]
    parts = tables.split_ranges(orders, orders.columns, quarters, "o_orderkey")
    return reduce(DataFrame.unionByName, [rows.withColumn("range_no", F.lit(i)) for i, rows in enumerate(parts)])


def resume_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A first run up to the middle of the events, a second one from there on."""
    events = table(spark, sf, "events")
    first, second = tables.split_ranges(events, events.columns, [(1, 2)], "event_id")
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


# Columns and filters -------------------------------------------------------


def rename_drop_keys(spark: SparkSession, sf: str) -> DataFrame:
    names = {"s_suppkey": "store_sk", "s_name": "name", "s_nationkey": "nation_sk", "absent": "ignored"}
    stores = columns.rename(table(spark, sf, "supplier"), names)
    nations = columns.bind_positional(table(spark, sf, "nation"), ["nation_sk", "name", "region_sk"])
    nations = columns.suffix_right(stores, nations, "_nation", keep=["nation_sk"])
    return columns.drop_suffix(left_join(stores, nations, "nation_sk"))


def filter_equality(spark: SparkSession, sf: str) -> DataFrame:
    wanted = {"category": "ECONOMY", "customer_segment": "BUILDING"}
    return amount_as_double(columns.filter_equal(cube_rows(spark, sf), wanted).drop("order_sk"))


# Joins ---------------------------------------------------------------------


def star_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in debt and large parts are left out of the dimensions, so some lines match nothing."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").alias("product_sk"), "l_linenumber", "l_extendedprice"
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_sk"), "o_orderpriority"
    )
    customers = table(spark, sf, "customer").where("c_acctbal >= 0")
    parts = table(spark, sf, "part").where("p_size <= 40")
    wide = star.join_dimensions(
        lines,
        {
            "l_orderkey": orders,
            "customer_sk": customers.select(F.col("c_custkey").alias("customer_sk"), "c_name", "c_mktsegment"),
            "product_sk": parts.select(F.col("p_partkey").alias("product_sk"), "p_name", "p_brand"),
        },
    )
    return wide.drop("customer_sk", "product_sk")


def role_nation_join(spark: SparkSession, sf: str) -> DataFrame:
    """Nations twice: of the supplier and of the customer."""
    nations = table(spark, sf, "nation")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber")
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("customer_nation_sk")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("supplier_nation_sk")
    )
    wide = star.join_dimensions(lines, {"l_orderkey": orders, "o_custkey": customers, "l_suppkey": suppliers})
    for role in ("supplier_nation", "customer_nation"):
        named = renamed_role(nations, {"n_nationkey": f"{role}_sk", "n_name": role})
        wide = left_join(wide, named, f"{role}_sk")
    return wide.select("l_orderkey", "l_linenumber", "supplier_nation", "customer_nation")


def role_date_join(spark: SparkSession, sf: str) -> DataFrame:
    """Dates twice: of the order and of the shipment."""
    dates = date_dimension(spark, FIRST_DAY, LAST_DAY)

    def date_key(column: str):
        return F.date_diff(F.to_date(column), F.lit(FIRST_DAY)) + 1

    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), date_key("o_orderdate").alias("start_date_sk")
    )
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", date_key("l_shipdate").alias("end_date_sk")
    )
    wide = left_join(lines, orders, "l_orderkey")
    wide = star.join_date_role(wide, dates, "start_date_sk", "ordered")
    wide = star.join_date_role(wide, dates, "end_date_sk", "shipped")
    return columns.drop_suffix(wide)


def denormalise_star(spark: SparkSession, sf: str) -> DataFrame:
    return amount_as_double(star.denormalise(**sales_star(spark, sf)))


# Conversion and validation -------------------------------------------------


def int_lenient(spark: SparkSession, sf: str) -> DataFrame:
    after_key = F.expr("substring(props, 7)")
    key = F.col("event_id").cast("string")
    return table(spark, sf, "events").select(
        "event_id",
        to_int_lenient(F.col("props")).alias("from_props"),
        to_int_lenient(after_key).alias("from_tail"),
        to_int_lenient(F.col("value").cast("string")).alias("from_value"),
        to_int_lenient(F.concat(F.lit("  -"), key, F.lit("abc"))).alias("from_signed"),
        to_int_lenient(F.concat(key, F.lit("99999999"))).alias("from_long"),
        to_int_lenient(F.nullif(F.col("event_type"), F.lit("error"))).alias("from_word"),
    )


def float_lenient(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value").cast("string")
    texts = {
        "from_tail": F.expr("substring(props, 7)"),
        "from_value": F.concat(F.lit(" "), value, F.lit("kg")),
        "from_exponent": F.concat(value, F.lit("e2")),
        "from_large": F.concat(value, F.lit("e99")),
        "from_word": F.col("event_type"),
        "from_fraction": F.concat(F.lit("-."), F.col("event_id").cast("string")),
    }
    converted = [to_float_lenient(text).cast("double").alias(name) for name, text in texts.items()]
    return table(spark, sf, "events").select("event_id", *converted)


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as text in contract order; orders of customers in debt have no customer."""
    customers = table(spark, sf, "customer").where("c_acctbal >= 0")
    customers = customers.select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("residential_location"))
    wide = left_join(table(spark, sf, "orders"), left_join(customers, nations, "n_nationkey"), "o_custkey")
    return wide.select(
        F.col("o_orderkey").cast("string").alias("sales_id"),
        F.to_date("o_orderdate").cast("string").alias("sales_date"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total_amount"),
        "customer_id",
        "customer_segment",
        F.col("o_orderpriority").alias("store_type"),
        F.col("o_orderstatus").alias("salesperson_role"),
        "residential_location",
        F.year("o_orderdate").cast("string").alias("order_year"),
        F.quarter("o_orderdate").cast("string").alias("order_quarter"),
    )


def reject_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = order_rows(spark, sf).withColumn("source_pos", F.col("sales_id").cast("bigint"))
    checked = validation.check_rows(rows, ORDER_CONTRACT)
    return validation.rejected(checked).select("sales_id", validation.REASON)


def unique_first_wins(spark: SparkSession, sf: str) -> DataFrame:
    """One event per user is accepted: the first that is not an error."""
    contract = Contract((ColumnSpec("user", not_null=True, unique=True), ColumnSpec("kind", not_null=True)))
    events = table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("user"), F.nullif("event_type", F.lit("error")).alias("kind")
    )
    return validation.check_rows(events, contract, "event_id").drop("kind")


def land(rows: DataFrame, landing: str, day: int, compression: str = "none") -> None:
    write_csv(rows, f"{landing}/{day}", compression=compression)


def validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Orders land complete, then once more with a field too many."""
    landing = scratch_path(spark, "landing")
    rows = order_rows(spark, sf)
    land(rows, landing, 1)
    land(rows.withColumn("surplus", F.lit("x")), landing, 2)
    staged = load.stage(csv.read_rows(spark, f"{landing}/*", ORDER_CONTRACT), ORDER_CONTRACT, landing + "_checked")
    placed = numbering.with_position(staged, numbering.source_blocks(staged))
    return validation.summary(validation.judge(placed, ORDER_CONTRACT, "source_pos", load.KEY))


def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    """The order batch against the wide contract: which columns are there, which values are missing."""
    return validation.contract_report(order_rows(spark, sf), SALES)


def loaded_orders(spark: SparkSession, sf: str) -> str:
    """Two loads of orders: open ones first, then all of them, so that the open ones come again."""
    root = scratch_path(spark, "orders")
    landing = f"{root}/landing"
    rows = order_rows(spark, sf)
    load.init_tables(spark, root, ORDER_CONTRACT)
    land(rows.where("salesperson_role = 'O'"), landing, 1)
    load.append_load(spark, f"{landing}/*", root, ORDER_CONTRACT)
    land(rows, landing, 2)
    load.append_load(spark, f"{landing}/*", root, ORDER_CONTRACT)
    return root


def count_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    return load.check_load(spark, loaded_orders(spark, sf), ORDER_CONTRACT)


def incremental_append(spark: SparkSession, sf: str) -> DataFrame:
    root = loaded_orders(spark, sf)
    load.append_load(spark, f"{root}/landing/*", root, ORDER_CONTRACT)  # nothing new
    return amount_as_double(load.fact_table(spark, root, ORDER_CONTRACT).drop(load.ROW_ID))


def load_audit(spark: SparkSession, sf: str) -> DataFrame:
    return load.load_report(spark, loaded_orders(spark, sf)).drop("committed_at")


def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = load.reject_report(spark, loaded_orders(spark, sf), ORDER_CONTRACT)
    return rows.groupBy("load_version", validation.REASON).agg(F.count(F.lit(1)).alias("rows"))


# Code tables ---------------------------------------------------------------

CODED = ["o_orderstatus", "o_orderpriority", "c_name"]


def coded_rows(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return left_join(table(spark, sf, "orders"), customers, "o_custkey").select("o_orderkey", *CODED)


def dict_build(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.build_dictionary(coded_rows(spark, sf), CODED, "o_orderkey")


def first_tenth(rows: DataFrame) -> list[DataFrame]:
    """The rows of the first tenth of the order keys, and the rest."""
    return tables.split_ranges(rows, rows.columns, [(1, 10)], "o_orderkey")


def dict_extend(spark: SparkSession, sf: str) -> DataFrame:
    """Built from the first tenth of the orders, extended by the rest."""
    first, rest = first_tenth(coded_rows(spark, sf))
    old = dictionary.build_dictionary(first, CODED, "o_orderkey")
    return dictionary.extend_dictionary(old, rest, CODED, "o_orderkey")


def dict_encode(spark: SparkSession, sf: str) -> DataFrame:
    return dictionary.encode(coded_rows(spark, sf), checkpointed(dict_build(spark, sf)), CODED)


def dict_decode(spark: SparkSession, sf: str) -> DataFrame:
    """All codes, decoded with the code table as it was after the first tenth of the orders."""
    early = checkpointed(dictionary.build_dictionary(first_tenth(coded_rows(spark, sf))[0], CODED, "o_orderkey"))
    return dictionary.decode(dict_encode(spark, sf), early, CODED)


# Cubes ---------------------------------------------------------------------


def measures_by_one_dim(spark: SparkSession, sf: str) -> DataFrame:
    return finish(cube.cuboid(cube_rows(spark, sf), ["brand"], AMOUNT))


def cuboid_three_dims(spark: SparkSession, sf: str) -> DataFrame:
    return finish(cube.cuboid(cube_rows(spark, sf), SMALL_DIMS, AMOUNT))


def cuboid_apex(spark: SparkSession, sf: str) -> DataFrame:
    return finish(cube.cuboid(cube_rows(spark, sf), [], AMOUNT))


def cube_full(spark: SparkSession, sf: str) -> DataFrame:
    return finish(cube.full_cube(cube_rows(spark, sf), DIMS, AMOUNT))


def cube_named(spark: SparkSession, sf: str) -> DataFrame:
    named = cube.with_names(cube.full_cube(cube_rows(spark, sf), DIMS, AMOUNT), DIMS)
    return finish(named)


def cube_grouping_sets(spark: SparkSession, sf: str) -> DataFrame:
    subsets = [["category", "brand"], ["customer_segment", "store_type"], ["salesperson_role", "campaign_name"], []]
    return finish(cube.grouping_sets_cube(cube_rows(spark, sf), DIMS, subsets, AMOUNT))


def cuboid_ordered_rounded(spark: SparkSession, sf: str) -> DataFrame:
    state = cube.full_cube(cube_rows(spark, sf), SMALL_DIMS, AMOUNT)
    table_ = numbered_cuboid(state, SMALL_DIMS, 0b111)
    return table_.select(*[F.col(c).cast("double") if "_amount" in c else F.col(c) for c in table_.columns])


def line_ranges(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Cube rows of the first four fifths of the order keys and of the rest."""
    return tables.split_ranges(cube_rows(spark, sf), [*DIMS, AMOUNT], [(4, 5)], "order_sk")


def delta_cube(spark: SparkSession, sf: str) -> DataFrame:
    """The cube of each of the two ranges."""
    both = [
        finish(cube.full_cube(rows, DIMS, AMOUNT)).withColumn("delta_no", F.lit(i))
        for i, rows in enumerate(line_ranges(spark, sf))
    ]
    return both[0].unionByName(both[1])


def cube_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Six-dimension cubes of the two ranges, merged."""
    old, new = [cube.full_cube(rows, DIMS, AMOUNT) for rows in line_ranges(spark, sf)]
    return finish(cube.merge_cubes(old, new, DIMS))


def stored_line_cube(spark: SparkSession, sf: str) -> str:
    """Folder of a stored cube of all lines, in six dimensions."""
    root = scratch_path(spark, "cube")
    versions.reset(spark, root)
    state = cube.full_cube(cube_rows(spark, sf), DIMS, AMOUNT)
    stored.write_cube(spark, root, state, versions.latest(spark, root, "cube"), 0)
    return root


def cube_lookup(spark: SparkSession, sf: str) -> DataFrame:
    key = {"category": "ECONOMY", "campaign_name": "A"}
    return finish(stored.stored_lookup(spark, stored_line_cube(spark, sf), DIMS, key))


def refreshed_orders(spark: SparkSession, sf: str) -> str:
    """Load, generate, load more, refresh twice (the second time there is nothing new)."""
    root = scratch_path(spark, "refresh")
    landing = f"{root}/landing"
    rows = order_rows(spark, sf)
    load.init_tables(spark, root, ORDER_CONTRACT)
    land(rows.where("salesperson_role <> 'F'"), landing, 1)
    load.append_load(spark, f"{landing}/*", root, ORDER_CONTRACT)
    stored.generate_cube(spark, root, ORDER_CONTRACT, ORDER_DIMS, AMOUNT)
    land(rows.where("salesperson_role = 'F'"), landing, 2)
    load.append_load(spark, f"{landing}/*", root, ORDER_CONTRACT)
    stored.refresh_cube(spark, root, ORDER_CONTRACT, ORDER_DIMS, AMOUNT)
    stored.refresh_cube(spark, root, ORDER_CONTRACT, ORDER_DIMS, AMOUNT)
    return root


def cube_refresh(spark: SparkSession, sf: str) -> DataFrame:
    return finish(stored.stored_cube(spark, refreshed_orders(spark, sf)))


def refresh_report(spark: SparkSession, sf: str) -> DataFrame:
    return stored.refresh_report(spark, refreshed_orders(spark, sf)).drop("committed_at")


def sales_days(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The wide rows of two days: lines whose campaign began up to 1998 or that have none, and the others.

    Lines meet their orders once, in a narrow table that knows the day, so each
    day joins its own lines with the dimensions instead of all of them.
    """
    parts = sales_star(spark, sf)
    campaigns = written(parts["campaigns"], "campaigns")
    began = star.join_date_role(campaigns, parts["dates"], "start_date_sk", "campaign_start").select("campaign_sk", "campaign_start_year")
    early = F.coalesce(F.col("campaign_start_year") <= 1998, F.lit(True)).alias("early")
    dated = left_join(parts["fact"], broadcast_if_small(began), "campaign_sk")
    fact = written(dated.select(*parts["fact"].columns, early), "fact")
    days = [fact.where("early"), fact.where("NOT early")]
    return [star.denormalise(**parts | {"fact": day.drop("early"), "campaigns": campaigns}) for day in days]


def sales_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way: star -> wide CSV -> two loads -> cube -> refresh, on the 39-column contract."""
    root = scratch_path(spark, "sales")
    landing = f"{root}/landing"
    early, late = sales_days(spark, sf)
    load.init_tables(spark, root, SALES)
    land(early, landing, 1, "gzip")
    load.append_load(spark, f"{landing}/*", root, SALES)
    stored.generate_cube(spark, root, SALES)
    land(late, landing, 2, "gzip")
    load.append_load(spark, f"{landing}/*", root, SALES)
    stored.refresh_cube(spark, root, SALES)
    return finish(cube.with_names(stored.stored_cube(spark, root), CUBE_DIMENSIONS))


# Sinks ---------------------------------------------------------------------


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "events.csv")
    events = table(spark, sf, "events")
    write_csv(events, path)
    return csv.read_csv(spark, path, events.schema)


def served_cuboids(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    """All tables of a database as one, analysed at once."""
    legs = []
    for name in names:
        kinds = dict(spark.table(f"{database}.{name}").dtypes)
        dims = [f"{d}" if d in kinds else f"CAST(NULL AS STRING) AS {d}" for d in DIMS]
        measures = [c for c in kinds if c not in DIMS]
        legs.append(f"SELECT {', '.join([*dims, *measures])}, '{name}' AS cuboid_name FROM {database}.{name}")
    return spark.sql(" UNION ALL ".join(legs))


def new_database(path: str) -> str:
    return "cuboids_" + path.split("/")[-2][:12]


def cuboid_publish_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Stored cube -> CSV per cuboid -> catalog table per cuboid -> one cube again, all 64 of them."""
    state = stored.stored_cube(spark, stored_line_cube(spark, sf))
    folder = scratch_path(spark, "cuboids")
    checked(export_cuboids(state, DIMS, folder))
    database = new_database(folder)
    report = checked(publish_tables(spark, folder, scratch_path(spark, "served"), database))
    return served_cuboids(spark, database, [r["table_name"] for r in report.orderBy("table_name").collect()])


def cube_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A cube of the first range is served, then refreshed with the second one and served again."""
    root, location = scratch_path(spark, "published"), scratch_path(spark, "served")
    database = new_database(location)
    versions.reset(spark, root)
    for batch, rows in enumerate(line_ranges(spark, sf)):
        stored.merge_batch(rows, batch, root, DIMS, AMOUNT, "lines")
        report = checked(publish_cube(spark, root, DIMS, location, database))
    return served_cuboids(spark, database, [r["table_name"] for r in report.orderBy("table_name").collect()])


# Streams -------------------------------------------------------------------


def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    landing, checkpoint = f"{root}/landing", f"{root}/checkpoint"
    rows = order_rows(spark, sf)
    load.init_tables(spark, root, ORDER_CONTRACT)
    for day, part in enumerate(("salesperson_role = 'O'", "salesperson_role <> 'O'")):
        land(rows.where(part), landing, day)
        stream_load(spark, f"{landing}/*", root, ORDER_CONTRACT, checkpoint).awaitTermination()
    return amount_as_double(load.fact_table(spark, root, ORDER_CONTRACT).drop(load.ROW_ID))


def batch_then_stream_append(spark: SparkSession, sf: str) -> DataFrame:
    """Batch, a new beginning, stream, and the batch's files again, on one root."""
    root = scratch_path(spark, "mixed")
    batch, stream, checkpoint = f"{root}/batch", f"{root}/stream", f"{root}/checkpoint"
    rows = order_rows(spark, sf)
    load.init_tables(spark, root, ORDER_CONTRACT)
    land(rows.where("salesperson_role = 'O'"), batch, 1)
    load.append_load(spark, f"{batch}/*", root, ORDER_CONTRACT)
    load.init_tables(spark, root, ORDER_CONTRACT)
    land(rows.where("salesperson_role <> 'O'"), stream, 1)
    stream_load(spark, f"{stream}/*", root, ORDER_CONTRACT, checkpoint).awaitTermination()
    load.append_load(spark, f"{batch}/*", root, ORDER_CONTRACT)
    load.append_load(spark, f"{batch}/1", root, ORDER_CONTRACT)  # the same files, spelled otherwise
    return amount_as_double(load.fact_table(spark, root, ORDER_CONTRACT).drop(load.ROW_ID))


def stream_refresh(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "stream_cube")
    landed, checkpoint = f"{root}/facts", f"{root}/checkpoint"
    versions.reset(spark, root)
    for rows in line_ranges(spark, sf):
        facts = rows.select(*DIMS, AMOUNT)
        facts.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(facts.schema).parquet(landed)
        start_refresh(stream, root, DIMS, AMOUNT, checkpoint).awaitTermination()
    return finish(stored.stored_cube(spark, root))


QUERIES = {
    f.__name__: f
    for f in (
        scan_projected,
        scan_row_range,
        resume_scan,
        rename_drop_keys,
        filter_equality,
        star_left_join,
        role_nation_join,
        role_date_join,
        denormalise_star,
        int_lenient,
        float_lenient,
        reject_not_null,
        unique_first_wins,
        validation_summary,
        contract_check,
        count_reconcile,
        incremental_append,
        load_audit,
        reject_report,
        dict_build,
        dict_extend,
        dict_encode,
        dict_decode,
        measures_by_one_dim,
        cuboid_three_dims,
        cuboid_apex,
        cube_full,
        cube_named,
        cube_grouping_sets,
        cuboid_ordered_rounded,
        delta_cube,
        cube_merge,
        cube_lookup,
        cube_refresh,
        refresh_report,
        sales_pipeline,
        csv_round_trip,
        cuboid_publish_round_trip,
        cube_publish,
        stream_append,
        batch_then_stream_append,
        stream_refresh,
    )
}
