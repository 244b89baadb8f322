"""Where intermediate tables go: the shared folder named by ``spark.checkpoint.dir``, else one in the warehouse."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folder of the library below the shared one.
FOLDER = "prismcube"


def scratch_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; the warehouse, which every executor reaches as well, where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch").rstrip("/")


def sweep_scratch(spark: SparkSession, hours: float = 24.0) -> int:
    """Delete the intermediate tables that were written more than some hours ago; returns how many folders went.

    Choose a time beyond the longest job that may still read them.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/{FOLDER}")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return 0
    before = (time.time() - hours * 3600) * 1000
    old = [f.getPath() for f in system.listStatus(place) if f.getModificationTime() <= before]
    return sum(system.delete(path, True) for path in old)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, below the scratch root."""
    return f"{scratch_root(spark)}/{FOLDER}/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once, into a table in the scratch folder, and read that."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computes ``df`` once and cuts its lineage.

    Its files go with the DataFrame if the session cleans checkpoints; see
    ``session.OPTIONS``.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()
