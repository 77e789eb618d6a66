"""Benchmark: the seven extract files on the driver's test data.

Prints one JSON line. Each run builds the extract's plan and fully computes
it through the ``noop`` sink (no result is collected to the driver),
including the derivation of every input table from the parquet files; only
the lazy table definitions are built once per session. Per query: one
warm-up, then the median of ``BENCH_RUNS`` timed runs.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from patronage.plans.registry import run  # noqa: E402
from patronage.session import local_session  # noqa: E402

HEADLINE = ("constituent_extract", "activity_extract", "affiliation_extract", "degree_extract",
            "gift_extract", "gift_summary_extract", "relative_extract")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="patronage-bench")

    def once(name: str) -> float:
        t0 = time.perf_counter()
        run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times = {}
    for name in HEADLINE:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "extract_wall_seconds_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "runs": runs, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
