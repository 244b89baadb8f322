import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from prismcube.functions.measures import finish
from prismcube.functions.naming import mask_dimensions
from prismcube.operators import cube as c

DIMS = ["a", "b", "d"]
STATE = ["sum_amount", "count", "min_amount", "max_amount"]


@pytest.fixture(scope="module")
def facts(spark):
    rng = random.Random(7)
    data = []
    for i in range(400):
        a = rng.choice(["x", "y", "A|B", "A", "", None])
        b = rng.choice(["C", "B|C", "Nescafé", "nescafé", "Levi's"])
        d = rng.choice(["", "p", "Supermarkets ", "Supermarkets"])
        data.append((i, a, b, d, Decimal(rng.randrange(-5000, 900000)) / 100))
    return spark.createDataFrame(data, "row_id bigint, a string, b string, d string, m decimal(18,2)").cache()


def test_every_cuboid_equals_its_group_by(facts):
    cube = c.full_cube(facts, DIMS, "m").cache()
    total = facts.count()
    for mask in range(8):
        kept = mask_dimensions(DIMS, mask)
        cuboid = c.one_cuboid(cube, DIMS, mask)
        assert cuboid.columns == [*kept, *STATE]
        direct = facts.groupBy(*kept).agg(F.sum("m"), F.count("m"), F.min("m"), F.max("m"))
        assert rows(cuboid) == rows(direct)
        assert cuboid.agg(F.sum("count")).first()[0] == total


def test_equals_one_phase_cube(facts):
    bits = sum((1 - F.grouping(d)).cast("int") * (1 << i) for i, d in enumerate(DIMS))
    direct = facts.cube(*DIMS).agg(bits.alias("mask"), F.sum("m").alias("s"), F.count("m"), F.min("m"), F.max("m"))
    direct = direct.select("mask", *DIMS, *direct.columns[4:])
    assert rows(c.full_cube(facts, DIMS, "m")) == rows(direct)


@pytest.mark.parametrize("n", [1, 2])
def test_few_dimensions(facts, n):
    cube = c.full_cube(facts, DIMS[:n], "m")
    assert rows(cube.groupBy(c.MASK).agg(F.sum("count"))) == [(m, 400) for m in range(2**n)]


def test_null_value_is_not_a_rolled_up_dimension(facts):
    cube = c.full_cube(facts, DIMS, "m")
    nulls = facts.where("a IS NULL").count()
    assert cube.where(f"{c.MASK} = 1 AND a IS NULL").first()["count"] == nulls
    assert cube.where(f"{c.MASK} = 0").first()["count"] == 400


def test_values_group_by_bytes(facts):
    keys = {r["b"] for r in c.cuboid(facts, ["b"], "m").collect()}
    assert {"Nescafé", "nescafé"} <= keys
    pairs = {(r["a"], r["b"]) for r in c.cuboid(facts, ["a", "b"], "m").collect()}
    assert {("A|B", "C"), ("A", "B|C")} <= pairs


def test_empty_input_gives_no_rows(facts):
    none = facts.where("false")
    assert c.full_cube(none, DIMS, "m").count() == 0
    assert c.cuboid(none, [], "m").count() == 0


def test_grouping_sets(facts):
    subsets = [["a", "d"], ["b"], []]
    got = c.grouping_sets_cube(facts, DIMS, subsets, "m")
    masks = [0b101, 0b010, 0]
    wanted = c.full_cube(facts, DIMS, "m").where(F.col(c.MASK).isin(masks))
    assert rows(got) == rows(wanted.select(*got.columns))


def test_merge_equals_one_cube_for_any_split(facts):
    whole = rows(c.full_cube(facts, DIMS, "m").select(c.MASK, *DIMS, *STATE))
    for split in (0, 137, 400):
        old = c.full_cube(facts.where(F.col("row_id") < split), DIMS, "m")
        new = c.full_cube(facts.where(F.col("row_id") >= split), DIMS, "m")
        assert rows(c.merge_cubes(old, new, DIMS).select(c.MASK, *DIMS, *STATE)) == whole


def test_finish(spark, facts):
    served = finish(c.cuboid(facts, ["d"], "m"))
    assert served.columns == ["d", "sum_amount", "count", "avg_amount", "min_amount", "max_amount"]
    for r in served.collect():
        assert r["avg_amount"] == r["sum_amount"] / r["count"]
    empty_group = spark.createDataFrame([(None, 0, None, None)], "sum_amount double, count bigint, min_amount double, max_amount double")
    assert finish(empty_group).first()["avg_amount"] == 0.0


def test_names_and_lookup(facts):
    cube = c.full_cube(facts, DIMS, "m")
    names = {(r[c.MASK], r["cuboid_name"]) for r in c.with_names(cube, DIMS).select(c.MASK, "cuboid_name").distinct().collect()}
    assert (0, "cuboid_apex") in names and (5, "cuboid_a_d") in names and len(names) == 8
    row = c.lookup(cube, DIMS, {"b": "Levi's"}).first()
    assert row["count"] == facts.where(F.col("b") == "Levi's").count()
    assert c.lookup(cube, DIMS, {}).first()["count"] == 400
    assert c.lookup(cube, DIMS, {"a": None, "b": "C"}).first()["count"] == facts.where("a IS NULL AND b = 'C'").count()


def test_key_order_is_bytewise_on_the_joined_key(spark):
    df = spark.createDataFrame([("a", "z"), ("a ", "b"), ("", None), ("é", "a"), ("z", "a")], "p string, q string")
    got = [tuple(r) for r in df.orderBy(c.key_order(["p", "q"])).collect()]
    assert got == sorted(df.collect(), key=lambda r: f"{r['p']}|{r['q'] or ''}".encode())


def test_float32_amounts(facts):
    floats = facts.withColumn("m", F.col("m").cast("float"))
    apex = finish(c.cuboid(floats, [], "m")).first()
    assert apex["sum_amount"] == pytest.approx(float(facts.agg(F.sum("m")).first()[0]), rel=1e-6)


def test_rows_are_shuffled_once_and_reduced_first(facts):
    text = plan(c.full_cube(facts, DIMS, "m"))
    first = text[text.rindex("Exchange hashpartitioning") :]
    assert "partial_sum" in first and "Expand" not in first


def test_rows_without_a_measure_are_counted_alike(spark):
    facts = spark.createDataFrame([("x", None), ("x", 2.0), ("y", None)], "a string, m double")
    apex = rows(c.cuboid(facts, [], "m"))
    assert apex == [(2.0, 3, 2.0, 2.0)]
    cube = c.full_cube(facts, ["a"], "m")
    assert rows(cube.where("cuboid_mask = 0").drop("cuboid_mask", "a")) == apex
    nothing = facts.where("m is null")
    assert c.cuboid(nothing, [], "m").count() == c.full_cube(nothing, ["a"], "m").where("cuboid_mask = 0").count() == 1
