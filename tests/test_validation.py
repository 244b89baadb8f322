import pytest
from pyspark.sql import functions as F

from conftest import rows
from prismcube.contract import SALES, ColumnSpec, Contract
from prismcube.operators import validation as v

CONTRACT = Contract(
    (
        ColumnSpec("id", not_null=True, unique=True),
        ColumnSpec("amount", kind="float", not_null=True),
        ColumnSpec("customer", not_null=True),
        ColumnSpec("note"),
        ColumnSpec("size", kind="integer"),
    )
)
SCHEMA = "source_pos bigint, id string, amount string, customer string, note string, size string, _corrupt_record string"


def make(spark, *data):
    padded = [(i, *d, *[None] * (6 - len(d))) for i, d in enumerate(data)]
    return spark.createDataFrame(padded, SCHEMA)


def reasons(checked):
    return [r[v.REASON] for r in checked.orderBy("source_pos").collect()]


def test_first_failing_column_is_the_reason(spark):
    df = make(
        spark,
        ("1", "5", "c"),
        ("2", "", ""),
        (None, None, "c"),
        ("1", None, None),
        ("3", " ", "c"),
        ("4", "5", "c", None, None, "4,5"),
    )
    expected = [None, "not_null:amount", "not_null:id", "unique:id", None, "width"]
    assert reasons(v.check_rows(df, CONTRACT)) == expected


def test_rejected_rows_claim_nothing(spark):
    df = make(spark, ("1", "5", ""), ("1", "5", "c"), ("1", "6", "c"), ("1", "7", ""), ("9", "1", "c", "", "", "raw"), ("9", "1", "c"))
    assert reasons(v.check_rows(df, CONTRACT)) == ["not_null:customer", None, "unique:id", "unique:id", "width", None]


def test_plain_duplicates(spark):
    assert reasons(v.check_rows(make(spark, ("1", "5", "c"), ("2", "5", "c"), ("1", "5", "c")), CONTRACT)) == [None, None, "unique:id"]


def test_values_already_stored_are_duplicates(spark):
    stored = spark.createDataFrame([("2",), ("8",)], "id string")
    df = make(spark, ("1", "5", "c"), ("2", "5", "c"), ("2", "", "c"), ("3", "5", "c"))
    assert reasons(v.check_rows(df, CONTRACT, stored=stored)) == [None, "unique:id", "unique:id", None]


def test_missing_value_of_a_nullable_unique_column_counts_as_one_value(spark):
    contract = Contract((ColumnSpec("id", unique=True),))
    assert reasons(v.check_rows(make(spark, (None,), ("",), ("1",)), contract)) == [None, "unique:id", None]


def test_hot_key(spark):
    df = spark.range(3000).select(
        F.col("id").alias("source_pos"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("1").alias("amount"),
        F.lit("c").alias("customer"),
        F.lit("").alias("note"),
        F.lit("").alias("size"),
    )
    counts = dict(rows(v.summary(v.check_rows(df, CONTRACT))))
    assert counts == {"accepted": 2001, "unique:id": 999}


def test_split_and_types(spark):
    checked = v.check_rows(make(spark, ("1", "5.25x", "c", None, "12abc"), ("2", "", "c")), CONTRACT)
    assert v.rejected(checked).count() == 1
    good = v.typed(v.accepted(checked), CONTRACT, ["source_pos"])
    assert good.schema.simpleString() == (
        "struct<source_pos:bigint,id:string,amount:decimal(18,2),customer:string,note:string,size:int>"
    )
    assert [str(x) for x in good.first()] == ["0", "1", "5.25", "c", "", "12"]


def test_missing_column_is_refused(spark):
    with pytest.raises(ValueError, match="lacks contract columns: size"):
        v.check_rows(make(spark, ("1",)).drop("size"), CONTRACT)
    assert "campaign_id" in v.missing_columns(make(spark, ("1",)), SALES)


def test_contract_report(spark):
    report = v.contract_report(make(spark, ("1", "", "c"), ("2", None, "c")).drop("size"), CONTRACT)
    assert rows(report) == [
        ("amount", True, 2), ("customer", True, 0), ("id", True, 0), ("note", True, 2), ("size", False, 2),
    ]


def test_reconcile(spark):
    assert rows(v.reconcile(spark.range(3), 3)) == [(3, 3, True)]
    assert rows(v.reconcile(spark.range(3), 4)) == [(3, 4, False)]
