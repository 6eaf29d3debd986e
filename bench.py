"""Time the headline queries and print one JSON line.

The whole list runs twice first, so that no query pays for code not yet compiled because it happens to be the
first; then each runs three times in full (all columns of all rows, to a sink that keeps nothing); its time is the
median. BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated
names) change what runs and where.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clinflow.plans.queries import REGISTERED  # noqa: E402

HEADLINE = [
    "dq_claims_good",
    "dq_claims_quarantine",
    "dq_summary",
    "dedup_lines",
    "curate_claims",
    "mask_claims",
    "mask_encounters",
    "join_left_anti",
    "except_rows",
    "integrate_claims",
    "dim_member",
    "dim_diagnosis",
    "dim_date",
    "fact_claims",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clinflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        REGISTERED[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in [*names, *names]:
        seconds(name)
    times = {}
    for name in names:
        times[name] = round(statistics.median(seconds(name) for _ in range(3)), 3)
    spark.stop()
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name}))


if __name__ == "__main__":
    main()
