"""Compare every registered query with its DuckDB oracle at one scale factor.

    python tools/check_oracle.py [SF_DIR] [QUERY ...]

Prints one line per query (rows, schema and value match) and exits non-zero on any mismatch.
"""

from __future__ import annotations

import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from oracle_harness import compare, duck  # noqa: E402

from martlens.plans import registry  # noqa: E402
from martlens.session import build_session  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session("local[8]", 8)
    con = duck(sf)
    sql = registry.oracle_sql()
    bad = 0
    for key, fn in registry.QUERIES.items():
        if only and key not in only:
            continue
        t0 = time.perf_counter()
        r = compare(fn(spark, sf), con, sql[key])
        bad += not r["ok"]
        print(f"{key:32s} ok={r['ok']} rows={r['rows_spark']}/{r['rows_oracle']} "
              f"schema={r['schema_ok']} values={r['values_ok']} {time.perf_counter() - t0:.1f}s", flush=True)
        if not r["ok"]:
            print("   spark only:", r.get("only_spark"), "\n   oracle only:", r.get("only_oracle"))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
