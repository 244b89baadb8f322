import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from prismcube.contract import SALES
from prismcube.operators import columns, joins, star
from prismcube.sources.dates import date_dimension
from workload import queries
from workload.tables import sales_star


@pytest.fixture
def skewed(spark):
    """A third of the rows share one key, some have none, some match nothing, key 1 is ambiguous."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 1 WHEN id % 11 = 0 THEN NULL ELSE id % 50 END")
    left = spark.range(6000).select(F.col("id").alias("row"), key.alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    return left, right.unionByName(spark.sql("SELECT 1L AS k, 'again' AS v"))


def test_salted_join_equals_plain_join(skewed):
    left, right = skewed
    expected = rows(left.join(right, "k", "left").select("row", "k", "v"))
    assert rows(joins.left_join(left, right, "k", salted=True)) == expected
    assert rows(joins.left_join(left, right, "k")) == expected
    assert rows(joins.left_join_derived(left, right, "k")) == expected


def test_salting_spreads_the_hot_key(skewed, conf):
    left, right = skewed
    assert rows(joins.hot_keys(left, ["k", "row"])) == [("k", "1")]
    conf({"spark.sql.shuffle.partitions": "20"})  # a key is hot if it holds more than an average partition
    few = left.where("k = 1 or (k < 5 and row < 3000)")
    assert ("k", "1") in rows(joins.hot_keys(few, ["k"]))
    assert len(rows(joins.hot_keys(left.where("k between 2 and 11"), ["k"]))) == 10
    conf({"spark.sql.shuffle.partitions": "4", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    sizes = joins.salted_left_joins(left, {"k": right}).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4
    assert max(r["count"] for r in sizes) < 0.5 * sum(r["count"] for r in sizes)


def test_equal_rows_of_a_hot_key_are_spread(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    left = spark.range(10_000).select(F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    sizes = joins.salted_left_joins(left, {"k": right}).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 4000 and sum(r["count"] for r in sizes) == 10_000


def test_several_keys_in_one_pass(spark, monkeypatch):
    left = spark.range(500).select("id", (F.col("id") % 2).alias("a"), F.expr("CASE WHEN id % 3 = 0 THEN 'x' ELSE string(id) END").alias("b"))
    sides = {"a": spark.createDataFrame([(0, "even")], "a bigint, va string"), "b": spark.createDataFrame([("x", "third"), ("7", "seven")], "b string, vb string")}
    expected = left.join(sides["a"], "a", "left").join(sides["b"], "b", "left").select("id", "a", "b", "va", "vb")
    passes = []
    monkeypatch.setattr(joins, "hot_keys", lambda df, keys, real=joins.hot_keys: passes.append(keys) or real(df, keys))
    assert rows(joins.salted_left_joins(left, sides).select("id", "a", "b", "va", "vb")) == rows(expected)
    assert passes == [["a", "b"]]


def test_string_keys_can_be_salted(spark):
    left = spark.range(300).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 1), ("5", 2)], "k string, v int")
    assert rows(joins.left_join(left, right, "k", salted=True)) == rows(left.join(right, "k", "left").select("id", "k", "v"))


def test_large_derived_tables_are_not_broadcast(skewed, conf, monkeypatch):
    left, right = skewed
    assert "BroadcastHashJoin" in plan(joins.left_join_derived(left, right, "k"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    assert not joins.fits_broadcast(right)
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    assert "SortMergeJoin" in plan(joins.left_join_derived(left, right, "k"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1000)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100)
    assert not joins.fits_broadcast(right)


def test_adaptive_execution_splits_a_hot_key(spark, conf):
    conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        }
    )
    left = spark.range(0, 60000, 1, 8).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END").alias("k"))
    right = spark.range(60000).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    assert "skew=true" in plan(joins.left_join(left, right, "k"))


def test_dimension_within_the_threshold_is_broadcast(spark):
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.createDataFrame([(1, "a")], "k bigint, v string")
    assert "BroadcastHashJoin" in plan(joins.left_join(left, right, "k"))


def test_dimension_that_is_a_join_is_measured(spark, conf, monkeypatch):
    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    left = spark.range(100).withColumnRenamed("id", "k")
    right = left.join(left.withColumn("v", F.lit("a")), "k")
    assert "BroadcastHashJoin" in plan(joins.left_join(left, joins.measured(right), "k"))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    assert "BroadcastHashJoin" not in plan(joins.left_join(left, joins.measured(right), "k"))


def test_columns(spark):
    df = spark.createDataFrame([(1, 2, "x")], "a int, b_sk int, c string")
    assert columns.rename(df, {"a": "z", "nope": "y"}).columns == ["z", "b_sk", "c"]
    assert columns.drop_suffix(df).columns == ["a", "c"]
    assert columns.suffix_right(df, df, "_r", keep=["b_sk"]).columns == ["a_r", "b_sk", "c_r"]
    assert columns.bind_positional(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(ValueError, match="expected 2 columns"):
        columns.bind_positional(df, ["x", "y"])


def test_filter_equal(spark):
    df = spark.createDataFrame([("Levi's", "a"), ("Levi's", None), ("x", "a")], "brand string, c string")
    assert rows(columns.filter_equal(df, {"brand": "Levi's"})) == [("Levi's", "a"), ("Levi's", None)]
    assert rows(columns.filter_equal(df, {"brand": "Levi's", "c": None})) == [("Levi's", None)]
    assert columns.filter_equal(df, {}).count() == 3


def test_date_dimension_2024(spark):
    days = date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()
    assert len(days) == 366
    for number, day in enumerate(sorted(days, key=lambda d: d["date_sk"]), start=1):
        full = day["full_date"]
        assert day["date_sk"] == number == full.timetuple().tm_yday
        assert (day["year"], day["month"], day["day"]) == (full.year, full.month, full.day)
        assert day["weekday"] == full.isoweekday()
        assert day["quarter"] == -(-full.month // 3)


@pytest.fixture
def small_star(spark):
    make = spark.createDataFrame
    return {
        "fact": make(
            [
                ("s1", "2024-02-01", 10.0, 1, 1, 1, 1, 1),
                ("s2", "2024-02-02", 20.0, 9, 1, 2, 2, 1),
                ("s3", "2024-02-03", 30.0, 1, 9, 1, 1, 2),
            ],
            "sales_id string, sales_date string, total_amount double, customer_sk int, product_sk int, "
            "store_sk int, salesperson_sk int, campaign_sk int",
        ),
        "customers": make(
            [(1, "C1", "Ann", "Lee", "a@x.org", "Oslo", "Home")],
            "customer_sk int, customer_id string, first_name string, last_name string, email string, "
            "residential_location string, customer_segment string",
        ),
        "products": make(
            [(1, "P1", "Nescafé", "Food", "Levi's", "Bern")],
            "product_sk int, product_id string, product_name string, category string, brand string, origin_location string",
        ),
        "stores": make(
            [(1, "S1", "Shop", "Supermarkets ", "Rome", 2), (2, "S2", "Stall", "Small", "Bonn", 77)],
            "store_sk int, store_id string, store_name string, store_type string, store_location string, store_manager_sk int",
        ),
        "salespersons": make(
            [(1, "E1", "Bo", "Clerk"), (2, "E2", "Di", "Manager")],
            "salesperson_sk int, salesperson_id string, salesperson_name string, salesperson_role string",
        ),
        "campaigns": make(
            [(1, "K1", "Gift More, Spend Less", 32, 60, 500), (2, "K2", "Sale", 1, 999, 600)],
            "campaign_sk int, campaign_id string, campaign_name string, start_date_sk int, end_date_sk int, campaign_budget int",
        ),
        "dates": date_dimension(spark, date(2024, 1, 1), date(2024, 12, 31)),
    }


def test_denormalise(small_star):
    wide = star.denormalise(**small_star)
    assert wide.columns == SALES.names
    one, two, three = sorted(wide.collect(), key=lambda r: r["sales_id"])
    assert (one["salesperson_name"], one["store_manager_name"], one["store_type"]) == ("Bo", "Di", "Supermarkets ")
    assert (one["campaign_start_date"], one["campaign_end_date"]) == (date(2024, 2, 1), date(2024, 2, 29))
    assert (one["campaign_start_weekday"], one["campaign_end_quarter"]) == (4, 1)
    assert (two["customer_id"], two["customer_segment"]) == (None, None)
    assert (two["store_manager_id"], two["salesperson_name"]) == (None, "Di")
    assert (three["product_id"], three["campaign_end_date"], three["campaign_end_year"]) == (None, None, None)


def test_denormalise_with_salted_keys(small_star):
    salted = star.denormalise(**small_star, salted=["customer_sk", "product_sk"])
    assert rows(salted) == rows(star.denormalise(**small_star))


def test_wide_rows_are_not_shuffled_by_a_key_with_few_values(spark, conf):
    folder = "/root/testdata/sf0.001"
    conf({"spark.sql.autoBroadcastJoinThreshold": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1000"})
    text = star.denormalise(**sales_star(spark, folder))._jdf.queryExecution().executedPlan().toString()
    for key in ("campaign_sk", "salesperson_sk", "store_manager_sk"):
        assert not re.search(rf"Exchange hashpartitioning\({key}#", text)


def test_computed_columns_follow_the_joins(small_star):
    expected = rows(star.denormalise(**small_star))
    fact, customers = small_star["fact"], small_star["customers"]
    small_star["fact"] = fact.drop("sales_id")
    small_star["customers"] = customers.withColumn("mail", F.split("email", "@")[0]).drop("last_name", "email")
    computed = {
        "sales_id": F.concat(F.lit("s"), F.substring("sales_date", 10, 1)),
        "last_name": F.when(F.col("customer_id").isNotNull(), "Lee"),
        "email": F.concat("mail", F.lit("@x.org")),
    }
    assert rows(star.denormalise(**small_star, computed=computed)) == expected


def test_texts_are_spelled_after_the_last_shuffle(spark, conf):
    conf({"spark.sql.autoBroadcastJoinThreshold": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "1000"})
    text = star.denormalise(**sales_star(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    for column in ("sales_id", "sales_date", "email", "product_id"):
        assert text.index(f"AS {column}#") < text.index("Exchange hashpartitioning")


def test_lines_of_both_days_meet_their_orders_once(spark, tmp_path):
    tables = {
        "region": (["r_regionkey int", "r_name string"], [(0, "EAST"), (1, "WEST")]),
        "nation": (["n_nationkey int", "n_name string", "n_regionkey int"], [(1, "A", 0), (2, "B", 1), (3, "C", None)]),
        "customer": (["c_custkey long", "c_name string", "c_nationkey int", "c_mktsegment string"], [(1, "C#1", 1, "s"), (2, "C#2", None, None), (None, "C#3", 1, "s")]),
        "supplier": (["s_suppkey long", "s_name string", "s_nationkey int"], [(1, "S1", 1), (2, "S2", 9)]),
        "part": (["p_partkey long", "p_name string", "p_type string", "p_brand string", "p_size int"], [(1, "p", "T", "B", 3), (2, None, None, "B", None)]),
        "orders": (
            ["o_orderkey long", "o_custkey long", "o_orderdate timestamp"],
            [(1, 1, datetime(1998, 12, 31)), (2, 2, datetime(1999, 1, 1)), (3, 3, None), (4, None, datetime(1996, 5, 5)), (5, 1, datetime(2001, 2, 3)), (5, 2, datetime(1997, 2, 3)), (6, 1, datetime(1980, 1, 1))],
        ),
        "lineitem": (
            ["l_orderkey long", "l_linenumber int", "l_partkey long", "l_suppkey long", "l_extendedprice double"],
            [(o, n, 1 + (o or 0) % 3, 1 + n % 3, 10.0 * n) for o in (1, 2, 3, 4, 5, 6, 7, None) for n in (1, 2)] + [(2, 1, None, None, None)] * 2,
        ),
    }
    for name, (columns_, content) in tables.items():
        spark.createDataFrame(content, ", ".join(columns_)).write.parquet(str(tmp_path / f"{name}.parquet"))
    wide = star.denormalise(**sales_star(spark, str(tmp_path)))
    early = F.coalesce(F.col("campaign_start_year") <= 1998, F.lit(True))
    days = queries.sales_days(spark, str(tmp_path))
    assert [rows(d) for d in days] == [rows(wide.where(early)), rows(wide.where(~early))]
    assert all(rows(d) for d in days)
    for day in days:
        assert not any("lineitem" in f or "orders" in f for f in day.inputFiles())


def test_repeated_dimension_key_multiplies_rows(small_star):
    small_star["customers"] = small_star["customers"].unionAll(small_star["customers"])
    assert star.denormalise(**small_star).count() == 5
