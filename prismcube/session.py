"""Session options the library is tuned for; all of them are optional.

Besides, ``spark.checkpoint.dir`` must name a folder that every executor can reach.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

OPTIONS = {
    # Split hot keys, merge small partitions, choose joins by measured sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Code for rows of dozens of columns exceeds what the JVM compiles as one
    # method; below this limit Spark generates many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Remove checkpoints that no DataFrame refers to any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Dates are days in UTC.
    "spark.sql.session.timeZone": "UTC",
}


@contextmanager
def with_options(spark: SparkSession, fixed: Mapping[str, str]) -> Iterator[None]:
    """Within it, jobs run with these options, whatever the session's are."""
    saved = {key: spark.conf.get(key, None) for key in fixed}
    for key, value in fixed.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
