"""Benchmark: end-to-end mart build and each metric family, on the test tables.

Prints one JSON line:
{"metric": "mart_build_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each family is timed on a fresh job (its shared stages are recomputed), and
executed with the ``noop`` sink so that only computation is measured.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfscope.plans.job import MartJob  # noqa: E402
from shelfscope.session import get_spark, use_local_checkpoint_dir  # noqa: E402
from shelfscope.sources.testviews import build_sources, adapter_params  # noqa: E402

FAMILIES = {
    "shipment_summary": "shipment_rows",
    "key_brand": "key_brand_rows",
    "pos_summary": "pos_rows",
    "pos_weekly": "pos_weekly_rows",
    "category_share": "category_share_rows",
    "drivers": "driver_rows",
    "mart_final": "mart_final",
}


def run(spark, sf_dir: str, attr: str) -> float:
    t0 = time.time()
    job = MartJob(spark, build_sources(spark, sf_dir), adapter_params())
    getattr(job, attr).write.format("noop").mode("overwrite").save()
    elapsed = round(time.time() - t0, 3)
    job.drop_stages()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    use_local_checkpoint_dir(spark)
    run(spark, sf_dir, "category_share_rows")  # warm-up: JVM, code paths, file listing
    times = {k: run(spark, sf_dir, attr) for k, attr in FAMILIES.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "mart_build_sec",
        "value": times["mart_final"],
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
