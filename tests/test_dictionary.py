import pytest
from pyspark.sql import functions as F

from conftest import rows
from prismcube.operators import dictionary as d
from prismcube.operators import numbering


@pytest.fixture
def facts(spark):
    data = [(0, "b", "x"), (3, "a", ""), (5, "b", None), (9, "", "x"), (12, "c", "y"), (40, "a", "z")]
    return spark.createDataFrame(data, "row_id bigint, p string, q string")


def test_codes_follow_first_occurrence(facts):
    expected = [("p", "", 2), ("p", "a", 1), ("p", "b", 0), ("p", "c", 3)]
    expected += [("q", "", 1), ("q", "x", 0), ("q", "y", 2), ("q", "z", 3)]
    assert rows(d.build_dictionary(facts, ["p", "q"])) == expected


def test_extension_keeps_codes_and_equals_one_build(facts):
    full = rows(d.build_dictionary(facts, ["p", "q"]))
    for split in (0, 10, 50):
        old = d.build_dictionary(facts.where(F.col("row_id") < split), ["p", "q"])
        extended = d.extend_dictionary(old, facts.where(F.col("row_id") >= split), ["p", "q"])
        assert rows(extended) == full
        assert set(rows(old)) <= set(full)


def test_encode_then_decode_is_identity(facts):
    codes = d.build_dictionary(facts, ["p", "q"])
    encoded = d.encode(facts, codes, ["p", "q"])
    assert dict(encoded.dtypes)["p"] == "bigint"
    assert rows(d.decode(encoded, codes, ["p", "q"])) == rows(facts.fillna("", ["q"]))


def test_unknown_codes_and_values(spark, facts):
    codes = d.build_dictionary(facts, ["p"])
    coded = spark.createDataFrame([(1, 99, "kept"), (2, 0, "kept")], "i int, p bigint, q string")
    assert rows(d.decode(coded, codes, ["p"])) == [(1, "<INVALID>", "kept"), (2, "b", "kept")]
    values = spark.createDataFrame([(1, "new")], "i int, p string")
    assert rows(d.encode(values, codes, ["p"])) == [(1, None)]


def test_large_dictionary_uses_the_salted_join(facts, monkeypatch):
    monkeypatch.setattr("prismcube.operators.joins.BROADCAST_ROWS", 1)
    codes = d.build_dictionary(facts, ["p", "q"])
    assert rows(d.decode(d.encode(facts, codes, ["p", "q"]), codes, ["p", "q"])) == rows(facts.fillna("", ["q"]))


def test_dense_numbers_over_many_runs(spark, monkeypatch):
    monkeypatch.setattr(numbering, "RUN", 16)
    df = spark.range(1000).select((F.col("id") * 7).alias("o"), (F.col("id") % 3).alias("g"))
    plain = numbering.dense_number(df, "o")
    assert plain.where(F.col("number") != F.col("o") / 7).count() == 0
    by = numbering.dense_number(df, "o", ["g"])
    assert by.where(F.col("number") != F.floor(F.col("o") / 21)).count() == 0


def test_numbering_plan_has_no_unpartitioned_sort_of_rows(facts):
    from conftest import plan

    text = plan(d.build_dictionary(facts, ["p", "q"]))
    assert "SinglePartition" not in text
