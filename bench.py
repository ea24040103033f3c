"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on
``local[BENCH_CPUS]``. Every query is run to the end of its plan with all
columns, into a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINES = [
    "extract_window",
    "batch_transform",
    "typed_staging",
    "validated",
    "dq_gate",
    "daily_sales",
    "dim_regions",
    "dim_stores",
    "monthly_revenue",
    "fact_test_suite",
    "cdc_merge",
    "merge_stored_fact",
    "incremental_daily_touched",
    "scd2_history",
    "reconcile_batch",
    "parse_envelope",
    "latest_event_per_key",
    "stream_merge",
]


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "tidemark-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["payment_mix"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINES)
