"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cellmend.plans import queries  # noqa: E402

HEADLINE = (
    "table_profile", "table_profile_lineitem", "table_profile_all", "column_profile",
    "dirty_profile", "null_pct", "type_deviation", "entropy_delta",
    "field_deviation_raw", "json_flatten", "json_profile", "profile_csv_folders", "scan_files",
    "read_csv_cells", "read_quoted_newlines", "detect_delimiter",
    "clean_orders", "clean_customer", "clean_currency", "clean_date", "clean_dry_run",
    "header_detect", "infer_schema", "schema_inventory",
    "type_ratio_drift", "entropy_drift", "pattern_violation", "cross_field",
    "dedup_exact", "clean_table", "iqr_outliers", "keyed_upsert",
    "organize_plan", "inventory_serial", "chunk_files", "stream_integrity",
    "schema_inventory_files", "clean_files", "json_bad_files", "clean_counters",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    run = queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(2):  # the first run also compiles
            start = time.time()
            run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.time() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
