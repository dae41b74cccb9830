"""Times every query over whole tables and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores, BENCH_RUNS the timed runs
per query (the median counts; one untimed run comes first). BENCH_ONLY may name
queries, separated by commas.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from orderloom.contract.queries import ALL
from orderloom.session import local_session


def seconds(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n]
    spark = local_session(cpus, shuffle_partitions=8 if cpus == "*" else int(cpus))
    times = {}
    for name in only or ALL:
        seconds(spark, ALL[name], sf_dir)
        times[name] = round(statistics.median(
            seconds(spark, ALL[name], sf_dir) for _ in range(runs)), 4)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 4),
                      "unit": "sec", "queries": times,
                      "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
