import pytest
from pyspark.sql import types as T

from prismcube.contract import CUBE_DIMENSIONS, SALES, ColumnSpec, Contract


def test_sales_contract_shape():
    kinds = [c.kind for c in SALES.columns]
    assert (len(kinds), kinds.count("string"), kinds.count("integer"), kinds.count("float")) == (39, 27, 11, 1)
    assert len(SALES.dictionary_columns) == 19
    assert SALES.unique_columns == ["sales_id"]
    assert SALES.not_null_columns == [
        "sales_id", "sales_date", "total_amount", "customer_id",
        "product_id", "store_id", "salesperson_id", "campaign_id",
    ]
    assert set(CUBE_DIMENSIONS) <= set(SALES.dictionary_columns)
    assert SALES.names[-6:] == [
        "campaign_end_date", "campaign_end_year", "campaign_end_month",
        "campaign_end_day", "campaign_end_weekday", "campaign_end_quarter",
    ]


def test_amount_type(spark):
    assert SALES.schema["total_amount"].dataType == T.DecimalType(18, 2)
    assert Contract(SALES.columns, amount_type="float").schema["total_amount"].dataType == T.FloatType()
    assert all(f.dataType == T.StringType() for f in SALES.text_schema)


def test_bad_contracts_are_refused():
    with pytest.raises(ValueError, match="unknown type"):
        ColumnSpec("a", kind="date")
    with pytest.raises(ValueError, match="one unique"):
        Contract((ColumnSpec("a", unique=True), ColumnSpec("b", unique=True)))
    with pytest.raises(ValueError, match="differ"):
        Contract((ColumnSpec("a"), ColumnSpec("a")))
    with pytest.raises(ValueError, match="null policy"):
        Contract((ColumnSpec("a"),), null_policy="drop")
