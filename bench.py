"""Benchmark: run every acceptance query at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line with per-query wall-clock seconds.

Each query's whole result is written to the ``noop`` sink, so no rows cross
to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from emberledger.plans.acceptance import QUERIES  # noqa: E402
from emberledger.session import get_session  # noqa: E402

HEADLINE = list(QUERIES)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, codegen caches, file listing
    QUERIES["q08_emissions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    label = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf: float | str = float(label)
    except ValueError:
        sf = label
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
