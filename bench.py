"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores. Each query is
built and run in full, every row and column computed and dropped; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from stagecheck.catalog import QUERIES
from stagecheck.session import build_session
from stagecheck.storage import drop_pins

HEADLINE = (
    "recon1_items_summary", "recon1_items_detail", "recon2_summary", "recon2_detail", "hash_archive", "stage1_run",
    "stage2_run", "explode_list", "renumber_rows", "remap_keys", "number_groups", "points_ledger", "points_spending",
    "order_totals", "customer_balance", "fk_orphans", "fk_repair", "pk_duplicates", "constraint_audit",
    "tracker_upsert", "parse_file_names", "parse_errors", "reload_file", "merge_csv",
)
RUNS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["recon1_summary"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    drop_pins(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
