import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from prismcube.session import OPTIONS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = OPTIONS | {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(work / "checkpoints"),
        "spark.sql.warehouse.dir": str(work / "warehouse"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def set_options(options):
        for key, value in options.items():
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_options
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """Physical plan after running the query, so that adaptive changes show."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
