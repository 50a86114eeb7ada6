"""Benchmark the query catalogue.

Runs every catalogue query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` (default 8). Each query is fully computed with the
``noop`` sink (no collect): one warm-up run, then the median of
``$BENCH_REPEAT`` (default 3) timed executions of the built plan. The
construction of each DataFrame (and the jobs that some queries run in it, such
as writes that are read back) is timed too and reported as ``build_sec``; the
value is construction plus execution. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark.catalog.queries import QUERIES  # noqa: E402
from ledgerspark.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_spark(f"local[{cpus}]", app="ledgerspark-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g"})
    times: dict[str, float] = {}
    build: dict[str, float] = {}
    for name, q in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        df = q(spark, sf_dir)                              # driver-side plan construction
        build[name] = round(time.perf_counter() - t0, 4)
        df.write.format("noop").mode("overwrite").save()   # warm-up
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "catalogue_build_and_run_sec",
        "value": round(sum(times.values()) + sum(build.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
        "run_total_sec": round(sum(times.values()), 4),
        "build_sec": build,
        "build_total_sec": round(sum(build.values()), 4),
    }))


if __name__ == "__main__":
    main()
