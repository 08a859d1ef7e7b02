"""Bench: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query's DataFrame is built and run once cold (JVM code generation, first planning), then built and
run ``BENCH_REPEAT`` more times; ``queries`` holds the median warm time per query and ``value`` their
sum, ``cold`` the first-run time. Building counts, because some reports look for hot groups while
they are built (rounds before the third timed the run alone). Every run is forced end to
end with the ``noop`` sink: every row computed, nothing collected. A short warm-up query runs first
so that JVM start-up is not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martlens.plans import registry  # noqa: E402
from martlens.session import build_session  # noqa: E402

# Headline set: every batch report plus the drained streams of R8 and R9 (streams run once: a
# rerun of a drained stream only re-reads its snapshot).
STREAMS = ["stream_ad_daily_city_counts", "stream_ad_daily_area_top3"]
HEADLINE = [k for k in registry.QUERIES if not k.startswith("stream_")] + STREAMS


def _run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [k for k in sys.argv[1:] if k in registry.QUERIES]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    _run(registry.QUERIES["page_visits"](spark, sf_dir))  # JVM warm-up

    warm: dict[str, float] = {}
    cold: dict[str, float] = {}
    failed: dict[str, str] = {}
    for key in only or HEADLINE:
        try:
            t0 = time.perf_counter()
            df = registry.QUERIES[key](spark, sf_dir)
            cold[key] = round(time.perf_counter() - t0 + _run(df), 3)
            if key.startswith("stream_"):
                warm[key] = cold[key]
                continue
            times = []
            for _ in range(repeat):
                t0 = time.perf_counter()
                df = registry.QUERIES[key](spark, sf_dir)
                times.append(time.perf_counter() - t0 + _run(df))
            warm[key] = round(statistics.median(times), 3)
        except Exception as e:  # report and go on: one failure must not hide the other timings
            failed[key] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {
        "metric": "sum_of_median_warm_query_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "sf": sf,
        "cold_total": round(sum(cold.values()), 3),
        "cold": cold,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
