"""Benchmark the headline queries.

Runs each query fully (``noop`` sink: every row computed, nothing kept) at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line with seconds per query and their sum.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from snapmetrics.plans import catalog  # noqa: E402
from snapmetrics.plans.publish import run_all  # noqa: E402
from snapmetrics.session import local_session  # noqa: E402
from snapmetrics.sources import fixtures as fx  # noqa: E402

HEADLINE = [
    "asof_block_20m",
    "totals_as_of",
    "state_as_of_20m",
    "job_allocations",
    "job_global",
    "job_subgraphs",
    "sheet_subgraphs",
]

WARMUP = ["asof_block", "state_as_of", "global_diff1", "clean_allocations"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="snapmetrics-bench")
    t = fx.Tables(spark, sf_dir)

    # Warm-up, untimed: JVM and optimizer JIT, file listing.  Uses queries
    # outside the headline set so no headline plan is pre-compiled.
    for name in WARMUP:
        q = catalog.REGISTRY[name]
        q.build(t).select(*q.cols).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        q = catalog.REGISTRY[name]
        t0 = time.perf_counter()
        q.build(t).select(*q.cols).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    # The three jobs as the production driver runs them (fee split
    # computed once; outputs, frames and sheets written to the shared folder).
    t0 = time.perf_counter()
    run_all(spark, sf_dir)
    times["run_all"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
