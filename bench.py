"""Benchmark: wall time of the registered queries, warm, median of N runs.

Each query is fully computed through the ``noop`` sink (nothing is collected to the driver).
Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3), ``BENCH_QUERIES`` (comma list, default all).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import local_session  # noqa: E402
from ledgerline.plans.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = local_session(cpus, shuffle_partitions=cpus, app="ledgerline-bench")
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = QUERIES[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 4)
        except Exception as e:  # keep measuring the others; report the failure
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    spark.stop()
    out = {"metric": "sum_of_median_query_seconds",
           "value": round(sum(v for v in times.values() if v is not None), 4),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
