"""Time the headline queries and print one JSON line.

Each query runs ``BENCH_RUNS`` times (2 by default) and the last, warm run
counts. A query's time holds everything it does: staging, gates, publishing,
and writing its whole result to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import time

from moorage.catalog import QUERIES
from moorage.session import session

HEADLINE = [
    "run_sales_star",
    "run_encounter_star",
    "run_appointment_snowflake",
    "load_fact_upsert",
    "allocate_keys",
    "join_extract_5way",
    "agg_sales_by_month_category",
    "dq_warehouse_quality",
    "dq_duplicate_key",
    "compare_both_ways",
    "flatten_offer_items_services",
    "select_offer",
    "carry_state_last_value",
    "report_totals",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(
        "bench", spark__master=f"local[{cores}]", spark__sql__shuffle__partitions=cores, spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
