"""Times the headline queries and prints one JSON line.

Settings: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (timed runs per query).
Each query runs once to warm up; its median counts. Queries that write files run once.
"""

import json
import os
import re
import statistics
import sys
import time

from tallyhouse.plans.catalog import QUERIES
from tallyhouse.session import local_session

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

FILES = [
    "csv_typed_scan",
    "json_typed_scan",
    "parquet_roundtrip",
    "header_signature",
    "incremental_ingest",
    "cumulative_mart",
    "versioned_publish",
    "landing_inventory",
    "partitioned_write_prune",
    "corrected_drop",
    "touched_month_publish",
    "mart_after_dimension_change",
    "ledger_after_compaction",
    "mixed_layout_scan",
    "field_errors",
    "streamed_ingest",
    "bucketed_customer_join",
]
COMPUTE = [name for name in QUERIES if name not in FILES]


def memory_files(spark):
    return f"/proc/{spark._jvm.java.lang.ProcessHandle.current().pid()}"


def peak_mb(spark):
    """The largest resident memory of the driver's JVM since it was last reset."""
    with open(f"{memory_files(spark)}/status") as status:
        return int(re.search(r"VmHWM:\s+(\d+)", status.read())[1]) // 1024


def reset_peak(spark):
    """After a collection, so that a query is not charged with what the one before left."""
    spark._jvm.java.lang.System.gc()
    with open(f"{memory_files(spark)}/clear_refs", "w") as clear:
        clear.write("5")


def seconds(spark, name):
    started = time.perf_counter()
    QUERIES[name](spark, DATA).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    chosen = sys.argv[1:]
    spark = local_session(CPUS, "tallyhouse-bench")
    timings, memory = {}, {}
    for name in chosen or COMPUTE:
        reset_peak(spark)
        seconds(spark, name)
        timings[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
        memory[name] = peak_mb(spark)
    for name in [] if chosen else FILES:
        reset_peak(spark)
        timings[name] = round(seconds(spark, name), 3)
        memory[name] = peak_mb(spark)
    print(
        json.dumps(
            {
                "metric": "headline query seconds, sum",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "peak_mb": memory,
                "sf": os.path.basename(DATA.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "runs": RUNS,
                "spark": spark.version,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
