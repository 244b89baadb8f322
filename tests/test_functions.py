import pytest
from pyspark.sql import functions as F

from prismcube.functions.conversion import INT_PREFIX, convert, is_missing, to_decimal_lenient, to_float_lenient, to_int_lenient
from prismcube.functions.naming import ABBREVIATIONS, cuboid_name, cuboid_names, mask_dimensions, power_set
from prismcube.functions.rounding import round_binary, round_exact
from prismcube.contract import CUBE_DIMENSIONS

DIMS = list(CUBE_DIMENSIONS)


def apply(spark, texts, make):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", make(F.col("t")).alias("v")).orderBy("i").select("v").collect()]


def test_int_prefix(spark):
    cases = {
        "231714.0": 231714, "12abc": 12, " 12": 12, "": 0, "abc": 0, "99999999999": 0, None: 0,
        "-7": -7, "+7": 7, "\t5": 5, "- 5": 0, "2147483647": 2147483647, "-2147483648": -2147483648, "2147483648": 0,
    }
    assert apply(spark, cases, to_int_lenient) == list(cases.values())


def test_int_of_whole_texts_is_that_of_their_prefix(spark):
    numbers = ["0", "007", "12", "2147483647", "2147483648", "99999999999999999999", "1.5", "1.", ".5", "1e3", "5d", "5L", "1_0", "1\u0663", "\u0663"]
    texts = [a + n + z for n in numbers for a in ("", "-", "+", " ", "\x01", "\n", "\u00a0") for z in ("", " ", "\x01", "\n", "x")]
    prefix = lambda t: F.coalesce(F.regexp_extract(t, INT_PREFIX, 1).try_cast("int"), F.lit(0))
    assert apply(spark, texts, to_int_lenient) == apply(spark, texts, prefix)


def test_float_prefix(spark):
    cases = {
        "1e3": 1000.0, "12abc": 12.0, "": 0.0, "abc": 0.0, "1e99": 0.0, "-1e99": 0.0, "1e-60": 0.0, None: 0.0,
        ".5": 0.5, "-2.": -2.0, "1e": 1.0, "nan": 0.0, "inf": 0.0, "200000.01": 200000.015625, "0": 0.0,
    }
    assert apply(spark, cases, to_float_lenient) == list(cases.values())


def test_decimal_prefix(spark):
    cases = {"200000.01": "200000.01", "1e3": "1000.00", "12abc": "12.00", "": "0.00", "1e99": "0.00", None: "0.00"}
    assert [str(v) for v in apply(spark, cases, to_decimal_lenient)] == list(cases.values())


def test_missing(spark):
    assert apply(spark, [None, "", " ", "x"], is_missing) == [True, True, False, False]


def test_null_policies(spark):
    for kind, zero in (("string", ""), ("int", 0), ("float", 0.0)):
        assert apply(spark, [None, ""], lambda c: convert(c, kind, "zero")) == [zero, zero]
        assert apply(spark, [None, ""], lambda c: convert(c, kind, "keep")) == [None, None]
    assert apply(spark, ["abc"], lambda c: convert(c, "int", "keep")) == [0]


def test_rounding(spark):
    ties = [1.005, 2.675, 0.125, 0.375, -0.125, 1e15, 3.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ties)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(round_binary(F.col("v"))).collect()]
    assert got == [float(f"{v:.2f}") for v in ties]
    exact = spark.sql("SELECT CAST('1.005' AS DECIMAL(10,3)) v").select(round_exact(F.col("v"))).first()[0]
    assert str(exact) == "1.01"


def test_power_set_order():
    assert power_set(["a", "b"]) == [[], ["a"], ["b"], ["a", "b"]]
    assert mask_dimensions(["a", "b", "c"], 0b101) == ["a", "c"]


def test_names():
    names = cuboid_names(DIMS)
    assert len(names) == 64 and len(set(names)) == 64
    assert names[0] == "cuboid_apex"
    assert names[0b11] == "cuboid_category_brand"
    assert names[63] == "cuboid_cat_brd_cseg_styp_srole_cname"
    assert [m for m, n in enumerate(names) if "cseg" in n or "styp" in n or "srole" in n] == [31, 55, 60, 61, 62, 63]
    assert len(ABBREVIATIONS) == 36


def test_long_names_are_cut_and_collisions_refused():
    assert len(cuboid_name(["x" * 40, "y" * 40])) == 64
    with pytest.raises(ValueError, match="share a table name"):
        cuboid_names(["x" * 70, "x" * 70 + "y"])
