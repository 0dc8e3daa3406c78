"""Benchmark the headline queries; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans import catalog  # noqa: E402
from tallyspark.session import local_session  # noqa: E402

HEADLINE = [
    "E3_monthly_category",    # flagship: statements -> clean -> transform -> monthly totals
    "P_clean",                # P1-P10 over every statement line
    "E3_transform",           # full transform incl. category tiers and keys
    "C_category_resolution",  # C1-C11 audit table
    "J2_incremental_load",    # two loads into month tables (second is the anti-join delta)
    "U2_dedup",               # consolidation de-duplication
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2)
    names = [q for q in HEADLINE if q in catalog.QUERIES] + [
        q for q in getattr(catalog, "BENCH_EXTRA", []) if q in catalog.QUERIES]
    # warm-up: JVM, codegen caches
    catalog.QUERIES[names[0]](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    def run(folder: str) -> dict[str, float]:
        times = {}
        for name in names:
            t0 = time.time()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        return times

    times = run(sf_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}
    # the same at a tenth of the rows: what stays is the fixed cost of a query, the rest grows with the rows
    small = os.environ.get("BENCH_SMALL_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(small) and os.path.realpath(small) != os.path.realpath(sf_dir):
        out["queries_small"], out["sf_small"] = run(small), small.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps(out))


if __name__ == "__main__":
    main()
