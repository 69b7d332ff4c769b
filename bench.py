"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.
``prepare`` is the time to write the stored domain tables that all queries read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcount.derived.registry import QUERIES
from shelfcount.derived.views import Tables
from shelfcount.session import drop_copies, local_session

HEADLINE = (
    "holdings_counts_by_org_type", "enum_chron", "scrub_file", "dedupe_holdings", "replace_holdings",
    "cluster_ocns", "item_formats", "overlap_fact", "frequency_table", "cost_by_member",
    "estimate_new_member", "overlap_report_all", "deposit_analysis", "non_current_pivot",
    "item_access", "record_held_by", "concordance_validated", "alma_convert", "cost_history_diff",
    "holdings_stream_ingest",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "16g", **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/nation.parquet").count()

    times: dict[str, float] = {}
    begin = time.perf_counter()
    Tables(spark, folder).prepare()
    times["prepare"] = round(time.perf_counter() - begin, 3)
    for name in chosen:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None, "cores": int(cores),
    }))
    drop_copies(spark)
    spark.stop()


if __name__ == "__main__":
    main()
