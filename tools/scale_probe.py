"""Scale probe: time reports on K-fold inputs derived in Spark from the given tables.

    python tools/scale_probe.py BASE_SF_DIR OUT_DIR K [K ...]

For each K, ``events`` and ``customer`` are replicated K times with shifted ids (new users with the
same days and behaviour), the other tables are copied, and the probe queries run on the result.
Prints one JSON line per K with the median of 3 warm runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from martlens.plans import registry  # noqa: E402
from martlens.session import build_session  # noqa: E402
from martlens.sources.tables import read_table  # noqa: E402

PROBE = [
    "visits_filtered", "session_stage_ratio", "session_sample", "category_session_top10", "page_conversion",
    "area_product_top3", "ad_blacklist", "ad_clicks_clean", "ad_daily_area_top3", "ad_sliding_counts",
]


def replicate(spark, base: str, out: str, k: int) -> None:
    events = read_table(spark, base, "events")
    customer = read_table(spark, base, "customer")
    max_event = events.select(F.max("event_id")).first()[0] + 1
    max_cust = customer.select(F.max("c_custkey")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")  # k copies of each row
    (events.select("*", copy)
     .select((F.col("event_id") + F.col("copy") * max_event).alias("event_id"), "ts",
             (F.col("user_id") + F.col("copy") * max_cust).alias("user_id"), "event_type", "value", "props")
     .repartition(max(8, k), "event_id")
     .write.mode("overwrite").parquet(f"{out}/events.parquet"))
    (customer.select("*", copy)
     .select((F.col("c_custkey") + F.col("copy") * max_cust).alias("c_custkey"), "c_name", "c_nationkey",
             "c_acctbal", "c_mktsegment")
     .write.mode("overwrite").parquet(f"{out}/customer.parquet"))
    for t in ("part", "nation", "region"):
        read_table(spark, base, t).write.mode("overwrite").parquet(f"{out}/{t}.parquet")


def main() -> None:
    base, out, factors = sys.argv[1], sys.argv[2], [int(x) for x in sys.argv[3:]]
    spark = build_session("local[8]", 8)
    for k in factors:
        d = f"{out.rstrip('/')}/x{k}"
        if k != 1:
            replicate(spark, base, d, k)
        sf_dir = base if k == 1 else d
        n = read_table(spark, sf_dir, "events").count()
        times = {}
        for key in PROBE:
            df = registry.QUERIES[key](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()  # cold run, not timed
            runs = []
            for _ in range(3):
                t0 = time.perf_counter()
                df.write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
            times[key] = round(statistics.median(runs), 3)
        print(json.dumps({"factor": k, "events": n, "total": round(sum(times.values()), 3), "queries": times}),
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
