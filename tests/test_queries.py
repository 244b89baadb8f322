"""Every registered query against its SQL equivalent, at the smallest scale."""

import sys
from functools import cache
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract
from check_oracle import compare, database
from conftest import plan
from workload import queries
from workload.oracle import oracle

FOLDER = contract.SMOKE_DIR
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def orders_loaded_once():
    """Several queries read the result of the same loads, refreshes and stored cube."""
    with pytest.MonkeyPatch.context() as patched:
        for shared in ("loaded_orders", "refreshed_orders", "stored_line_cube"):
            patched.setattr(queries, shared, cache(getattr(queries, shared)))
        yield


def test_every_query_has_sql():
    assert queries.QUERIES.keys() == oracle().keys()


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, db, name):
    assert compare(spark, db, FOLDER, name) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 64


def test_scan_reads_only_the_named_columns(spark):
    text = plan(contract.queries()["cube_full"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_returnflag:string>" in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_row_range_is_pushed_down(spark):
    text = plan(contract.queries()["scan_row_range"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThanOrEqual(o_orderkey" in text
