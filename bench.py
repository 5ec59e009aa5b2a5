"""Benchmark of the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion through the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cachescope.plans import catalog  # noqa: E402
from cachescope.session import get_spark  # noqa: E402

HEADLINE = ["run_summary", "detect_hits", "running_metrics", "experiment_summary", "document_summary",
            "plan_requests", "exact_reuse", "semantic_reuse", "reuse_sweep", "embedding_reuse"]
WARMUP_SF = "/root/testdata/sf0.001"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(cpus, app="cachescope-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in catalog.QUERIES]
    # untimed warm-up on the smallest tables: JVM start, class loading and
    # code generation are paid once, not by the first timed query
    if os.path.isdir(WARMUP_SF):
        catalog.QUERIES["run_summary"](spark, WARMUP_SF).collect()
        spark.catalog.clearCache()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        # operators persist shared intermediates (MEMORY_AND_DISK); release them
        # so one query's cache does not slow the planning of the next
        spark.catalog.clearCache()
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
