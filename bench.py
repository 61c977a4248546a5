"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query runs once to warm up
and then ``BENCH_RUNS`` times (3 if unset); the median counts. All rows and columns of a result are
made (the noop sink), but not carried to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.queries import QUERIES  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "silver_flow",
    "cdc_scd1_delete",
    "cdc_scd1_truncate",
    "cdc_ignore_nulls",
    "cdc_multi_key",
    "cdc_scd2",
    "cdc_track_list",
    "cdc_ignore_nulls_scd2",
    "cdc_scd1_incremental",
    "cdc_out_of_order",
    "snap_scd2_store",
    "snap_diff",
    "snap_multi_version",
    "upsert_merge",
    "latest_per_key",
    "dq_report",
    "dq_drop",
    "rows_to_json_array",
    "rescued_json",
    "file_stream_schema",
    "layout_cluster",
    "bronze_flow",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="millrace-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf_dir.rsplit("sf", 1)[-1]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
