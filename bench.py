"""Benchmark: every registered query, cold and warm.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default
8) and prints one JSON line. Each query is fully executed through the ``noop`` sink (all
rows produced, nothing collected). ``gold_build`` is derive bronze -> silver -> star,
written to the scratch folder. ``queries`` has each query's cold run (results remembered by
earlier queries dropped, gold tables kept) and ``value`` is the sum of these; ``warm`` has the
median of ``$BENCH_WARM`` (1) further runs, which re-read remembered results where
``remembered`` names the query. ``$BENCH_QUERIES`` limits the run to some queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from keelson.catalog import QUERIES
    from keelson.plans.job import gold
    from keelson.session import local_session, scratch_dir

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="keelson-bench", memory="16g")
    def timed(fn) -> float:
        t = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t, 3)

    t = time.perf_counter()
    g = gold(spark, sf_dir)
    timings = {"gold_build": round(time.perf_counter() - t, 3)}
    warm, remembered = {}, []
    runs = int(os.environ.get("BENCH_WARM", "1"))
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        g.memo.clear()
        g.scratch = scratch_dir(spark, "memo")
        timings[name] = timed(fn)
        if g.memo:
            remembered.append(name)
        if runs:
            warm[name] = statistics.median(timed(fn) for _ in range(runs))
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_time_all_queries", "value": total, "unit": "sec",
                      "queries": timings, "warm": warm, "remembered": remembered,
                      "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
