"""Benchmark: headline queries of the catalogue on ``$BENCH_SF_DIR``.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is executed in full with the ``noop`` sink (no collect to the driver);
``dds_first_load`` builds and materialises the whole detail layer, the marts then
read it, like the nightly refresh does.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart.plans import catalog, landing  # noqa: E402
from starmart.plans.refresh import build_warehouse  # noqa: E402
from starmart.session import get_session  # noqa: E402

HEADLINE = [
    "explode_payments", "stage_documents_incremental", "normalise_documents", "upsert_last_wins",
    "insert_if_absent", "dedupe_last", "surrogate_keys", "agg_count_distinct", "lookup_rejects",
    "scd2_build", "scd2_apply", "scd2_asof", "dm_settlement_report", "dm_courier_ledger",
    "dm_courier_ledger_avg_rate", "stream_daily_totals",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", app="starmart-bench", partitions=int(cpus) * 2)
    run(spark.range(1000).selectExpr("sum(id)"))   # JVM warm-up
    qs = catalog.queries()
    times = {}
    t0 = time.time()
    stg = catalog._stg(spark, sf_dir)        # staging layer, written once
    w = build_warehouse(spark, stg, floor=landing.FIRST_LOAD_FLOOR)
    for df in w.values():
        run(df)
    times["dds_first_load"] = round(time.time() - t0, 3)
    catalog._WAREHOUSES[(spark.sparkContext.applicationId, sf_dir)] = w
    for name in HEADLINE:
        t0 = time.time()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "starmart_headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
