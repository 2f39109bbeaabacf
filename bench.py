"""Benchmark: every registered warehouse query at $BENCH_SF_DIR.

Each query is fully executed with the ``noop`` sink (all rows computed, none
collected).  Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:]]
    from tidemart.session import build_session
    from tidemart.plans.registry import QUERIES
    from tidemart.sources.tables import SCAN_PARTITIONS

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, tz="UTC",
                          extra={"spark.driver.memory": "16g", SCAN_PARTITIONS: str(cpus)})
    # Warm the JVM (class loading, code generation paths) on the smallest
    # scale factor next to the measured one; not timed.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for name, fn in QUERIES.items():
            if not only or name in only:
                fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        QUERIES["user_register"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else sf_dir
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
