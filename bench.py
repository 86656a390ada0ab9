"""Headline queries at one scale; prints one JSON line.

Each query writes to Spark's ``noop`` sink, so every row and column is computed and nothing passes through the driver.
It runs ``BENCH_RUNS`` times (2 by default) and the fastest run counts, as the first one also compiles its code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from platelake.session import recommended_conf  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS)
    builder = builder.config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    times = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
