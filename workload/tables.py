"""The driver tables in the roles of a sales star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prismcube.operators.joins import left_join
from prismcube.sources.dates import date_dimension

# Days of the date dimension: from before the first order to after the last shipment.
FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2004, 12, 31)

# Dimension of the sales cube -> column of the driver tables.
CUBE_ROLES = {
    "category": "p_type",
    "brand": "p_brand",
    "customer_segment": "c_mktsegment",
    "store_type": "o_orderpriority",
    "salesperson_role": "o_orderstatus",
    "campaign_name": "l_returnflag",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cube_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem with its six cube dimensions and its amount."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_sk"),
        F.col("l_partkey").alias("product_sk"),
        F.col("l_returnflag").alias("campaign_name"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_amount"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_sk"),
        F.col("o_custkey").alias("customer_sk"),
        F.col("o_orderpriority").alias("store_type"),
        F.col("o_orderstatus").alias("salesperson_role"),
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_sk"), F.col("c_mktsegment").alias("customer_segment")
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_sk"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand")
    )
    wide = left_join(lines, orders, "order_sk")
    wide = left_join(wide, customers, "customer_sk")
    wide = left_join(wide, parts, "product_sk")
    return wide.select("order_sk", *CUBE_ROLES, "total_amount")


def sales_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame | dict[str, Column]]:
    """Fact and dimensions of the 39-column sales star, and the texts that are spelled from their columns.

    Parts are products, suppliers are stores, nations are salespersons (and,
    by the supplier's nation, store managers). Every quarter with orders is a
    campaign from its first to its last day.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    order_day = F.to_date("o_orderdate")
    quarter = (F.year(order_day) * 10 + F.quarter(order_day)).cast("int")
    ordered = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_sk"),
        quarter.alias("campaign_sk"),
        order_day.alias("order_day"),
    )
    lines = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount")
    )
    fact = left_join(lines, ordered, "l_orderkey").select(
        F.col("l_orderkey").alias("order_sk"),
        "order_day",
        F.col("amount").alias("total_amount"),
        "customer_sk",
        F.col("l_partkey").alias("product_sk"),
        F.col("l_suppkey").alias("store_sk"),
        F.col("l_linenumber").alias("salesperson_sk"),
        "campaign_sk",
    )

    nations = table(spark, sf_dir, "nation").join(
        F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    places = F.broadcast(nations.select("n_nationkey", "n_name", "r_name"))
    customers = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    customers = customers.select(
        F.col("c_custkey").alias("customer_sk"),
        F.col("c_name").alias("customer_id"),
        F.col("n_name").alias("residential_location"),
        F.col("c_mktsegment").alias("customer_segment"),
    )
    products = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_sk"),
        F.col("p_partkey").alias("product_no"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("product_size"),
    )
    stores = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    stores = stores.select(
        F.col("s_suppkey").alias("store_sk"),
        F.concat(F.lit("STR_"), F.col("s_suppkey").cast("string")).alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("r_name").alias("store_type"),
        F.col("n_name").alias("store_location"),
        F.col("s_nationkey").alias("store_manager_sk"),
    )
    salespersons = nations.select(
        F.col("n_nationkey").alias("salesperson_sk"),
        F.concat(F.lit("SP_"), F.col("n_nationkey").cast("string")).alias("salesperson_id"),
        F.col("n_name").alias("salesperson_name"),
        F.col("r_name").alias("salesperson_role"),
    )
    first_day = F.trunc(F.min(order_day), "quarter")
    campaigns = orders.groupBy(quarter.alias("campaign_sk")).agg(
        first_day.alias("first_day"), F.count(F.lit(1)).cast("int").alias("campaign_budget")
    )
    campaigns = campaigns.select(
        "campaign_sk",
        F.concat(F.lit("CAMP_"), F.col("campaign_sk").cast("string")).alias("campaign_id"),
        F.concat_ws(" of ", F.quarter("first_day").cast("string"), F.year("first_day").cast("string")).alias("campaign_name"),
        (F.date_diff("first_day", F.lit(FIRST_DAY)) + 1).alias("start_date_sk"),
        F.date_diff(F.add_months("first_day", 3), F.lit(FIRST_DAY)).alias("end_date_sk"),
        "campaign_budget",
    )
    return {
        "fact": fact,
        "customers": customers,
        "products": products,
        "stores": stores,
        "salespersons": salespersons,
        "campaigns": campaigns,
        "dates": date_dimension(spark, FIRST_DAY, LAST_DAY),
        "computed": {
            "sales_id": F.concat_ws("-", "order_sk", "salesperson_sk", "product_sk", "store_sk", "total_amount"),
            "sales_date": F.col("order_day").cast("string"),
            "first_name": F.substring_index("customer_id", "#", 1),
            "last_name": F.substring_index("customer_id", "#", -1),
            "email": F.concat(F.lower("customer_id"), F.lit("@example.com")),
            "product_id": F.concat(F.lit("PROD_"), F.col("product_no").cast("string")),
            "origin_location": F.concat(F.lit("size "), F.col("product_size").cast("string")),
        },
    }
