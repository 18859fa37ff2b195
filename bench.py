"""Seconds of headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import importlib
import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = ["jn-01", "flt-12", "gr-01", "ag-18", "wn-04", "ag-02", "ag-08", "ag-09", "ag-12", "ag-24", "im-16", "jn-19", "sp-19", "se-03", "so-07", "st-06", "wn-13", "la-01"]


def seconds(spark: SparkSession, f, runs: int) -> float:
    took = []
    for _ in range(runs):
        t = time.perf_counter()
        f(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - t)
    return statistics.median(took)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = importlib.import_module("__spark_entry__").queries()
    names = HEADLINE + [q for q in queries if q.startswith("op")]
    seconds(spark, queries[names[0]], 1)  # warms the session up
    found = {}
    for name in names:
        try:
            found[name] = round(seconds(spark, queries[name], 1 if name.startswith("op") else RUNS), 3)
        except Exception as e:  # one query's fault is not the others'
            found[name] = None
            print(f"{name}: {str(e)[:200]}", file=sys.stderr)
    total = sum(v for v in found.values() if v is not None)
    print(json.dumps({"metric": "total_seconds", "value": round(total, 3), "unit": "sec", "queries": found, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
