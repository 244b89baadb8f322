"""The entry file without the operators for training data, and queries over keys with gaps."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract

REPO = Path(contract.__file__).resolve().parent
sys.path.insert(0, str(REPO / "tools"))

from check_oracle import compare  # noqa: E402

FOLDER = contract.SMOKE_DIR


def test_entry_without_the_training_data_operators(tmp_path):
    for name in ("prismcube", "workload"):
        shutil.copytree(REPO / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    said = "import __spark_entry__ as e; print(len(e.queries()), set(e.queries()) == set(e.oracle_sql()), 'pipeline' in e.queries())"
    run = subprocess.run([sys.executable, "-c", said], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert run.stdout.split()[1:] == ["True", "False"]


@pytest.fixture(scope="module")
def sparse(spark, tmp_path_factory):
    """The tables with order and event keys that have gaps, an offset, and one missing."""
    folder = tmp_path_factory.mktemp("sparse")
    for path in Path(FOLDER).glob("*.parquet"):
        df = spark.read.parquet(str(path))
        for key in ("o_orderkey", "l_orderkey", "event_id"):
            if key in df.columns:
                df = df.withColumn(key, F.col(key) * 4 + 100)
        if path.stem in ("orders", "lineitem", "events"):
            df.coalesce(1).write.parquet(str(folder / path.stem))
            (part,) = (folder / path.stem).glob("part-*.parquet")
            shutil.copy(part, folder / path.name)
        else:
            shutil.copy(path, folder / path.name)
    return str(folder)


@pytest.mark.parametrize("name", ["scan_row_range", "resume_scan", "dict_extend", "dict_decode", "delta_cube", "cube_merge", "stream_refresh"])
def test_keys_with_gaps(spark, sparse, name):
    db = duckdb.connect()
    for path in Path(sparse).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    assert compare(spark, db, sparse, name) == []


