"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_ROUNDS
(default 3, the best of which counts). Every query is run to the end into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import time

from plumbline.plans.catalog import QUERIES
from plumbline.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))

HEADLINE = (
    "material_normalise", "customer_masked", "price_history_build", "profile_lineitem", "recon_checksum_bands",
    "recon_report", "recon_drilldown", "duplicate_keys", "three_way_parity", "rules_suite", "rules_extended",
    "pii_audit", "upsert_orders", "merge_full_outer", "cdc_latest", "cdc_silver", "ledger_items", "debounce_5min",
    "lag_alarm", "shadow_diff_rate", "orphan_check", "run_incremental",
)
# Runs that write to disk, once each.
RUNS = ("cdc_silver_stream", "run_table")

# Rows a query works through, for rows per second.
WORK = {"material_normalise": ("part", 1), "recon_report": ("orders", 2), "cdc_silver": ("events", 1)}


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "bench")
    times = {name: min(seconds(spark, name) for _ in range(ROUNDS)) for name in HEADLINE}
    times.update({name: seconds(spark, name) for name in RUNS})
    rates = {}
    for name, (table, sides) in WORK.items():
        rows = spark.read.parquet(f"{FOLDER}/{table}.parquet").count() * sides
        rates[name] = round(rows / times[name])
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "cores": CPUS,
        "rows_per_second": rates,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
