"""Time the headline queries and print one JSON line.

Tables come from ``$BENCH_SF_DIR`` and Spark runs on ``local[$BENCH_CPUS]``.
Every query runs ``$BENCH_RUNS`` times after one warm-up; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from prismcube.scratch import sweep_scratch
from prismcube.session import OPTIONS
from workload.queries import QUERIES

HEADLINE = (
    "scan_projected",
    "denormalise_star",
    "role_date_join",
    "unique_first_wins",
    "dict_build",
    "dict_encode",
    "cuboid_three_dims",
    "cube_full",
    "cube_grouping_sets",
    "cube_merge",
    "incremental_append",
    "cube_refresh",
    "cuboid_publish_round_trip",
)


def session(cpus: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    settings = OPTIONS | {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, folder: str) -> float:
    begin = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run(spark, name, folder)
        seconds[name] = round(min(run(spark, name, folder) for _ in range(runs)), 3)
    sweep_scratch(spark, hours=0)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total of headline queries", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
