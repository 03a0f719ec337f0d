"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8). Inputs that a query's
tables are first exported to (CSV files, archives) are written in the warm-up; a timed run reads them,
does the whole work into a fresh target and consumes every column of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from querybook import QUERIES  # noqa: E402

HEADLINE = [
    "upsert_delete_insert", "upsert_merge", "upsert_composite", "delete_by_key", "delete_by_composite_key", "distinct_rows",
    "pk_violations", "scan_csv_extract", "scan_csv_in_splits", "csv_to_parquet", "archive_expand", "infer_number_type",
    "typed_cast_select", "append_load", "batch_rows", "nested_children", "doc_latest_version", "doc_text_sink",
    "file_part_reassemble", "metadata_change_plan", "full_load", "incremental_load", "log_load", "stream_incremental_apply",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in chosen:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of the headline queries, warm, median of runs", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
