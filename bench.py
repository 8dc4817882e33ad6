"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: tables (default /root/testdata/sf0.1). BENCH_CPUS: cores (default 8).
BENCH_QUERIES: comma-separated names to time instead; ``all`` times everything.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chronovault.session import build_session  # noqa: E402
from chronovault.suite import QUERIES  # noqa: E402

HEADLINE = [
    "agg1_yearly_totals", "win1_latest_versions", "win2_asof", "win3_common_indicators", "win8_timestep",
    "win9_returns", "agg4_schema", "agg7_series_stats", "agg8_correlation", "mlr1_trend_ols", "mlr3_compare_assets",
    "jon1_facts_sources", "jon3_linked_sources", "jon4_vendor_assets", "jon6_asset_analytics", "jon10_nearest_date",
    "tso1_gap_fill", "tso2_backfill", "tso6_asset_lineage", "snk1_insert_if_absent", "snk3_asset_dim",
    "snk4_source_dim", "src3_fallback_rows", "src5_ingest_status", "str4_classify", "str11_ingest_id", "map2_derive_metrics",
    "stm1_stream_dedupe", "stm3_stream_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "agg1_yearly_totals", sf_dir)  # start-up is not part of the first query
    times = {name: run(spark, name, sf_dir) for name in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))
    spark.stop()


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


if __name__ == "__main__":
    main()
