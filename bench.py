"""Timings of the whole run and of the single analyses.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. The raw CSV files are written first and not timed. ``full_load`` takes them
through cleaning to the stored star and its rollups; ``full_results`` stores audits, classification, inventory model and report
tables; the other entries run one analysis each on a stored star and read its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from tidelane.functions.lineage import shared_path  # noqa: E402
from tidelane.operators import quality  # noqa: E402
from tidelane.plans.batch import build_results, load_star  # noqa: E402
from tidelane.plans.session import session  # noqa: E402
from tidelane.schema import SOURCE_POSITION  # noqa: E402
from tidelane.sources.raw_orders import read_raw_orders  # noqa: E402
from tidelane.sources.tpch import raw_lines  # noqa: E402

HEADLINES = [
    "dedupe_order_items", "dq_duplicate_keys", "dq_scorecard", "register_views",
    "otif_by_route", "monthly_delivery_trends", "segment_fulfillment", "late_cost_impact",
    "lead_time_distribution", "overall_kpis", "category_revenue_ranked", "product_revenue_pareto",
    "product_weekly_demand", "loss_making_products", "abc_classify", "xyz_classify", "segment_strategy",
    "route_lead_time", "daily_demand_stats", "primary_route", "inventory_master", "route_scorecard",
    "monthly_report", "heatmap_otif", "reorder_roster", "sku_lookup",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # the library's own session; beyond it only what a single machine needs
    machine = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = session("tidelane-bench", f"local[{cpus}]", **machine)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)

    root = shared_path(spark, "bench")
    files = shared_path(spark, "bench-raw")
    (
        raw_lines(spark, folder).drop(SOURCE_POSITION).repartition(int(cpus))
        .write.option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(files)
    )
    timed("full_load", lambda: load_star(read_raw_orders(spark, files, position=True), root))
    timed("full_results", lambda: build_results(spark, root))
    timed("store_star", lambda: registry.stored_root(spark, folder))
    star = registry.stored_star(spark, folder)
    for name, audit in (
        ("dq_null_audit", lambda: quality.dq_null_audit(star.fact)),
        ("dq_range_audit", lambda: quality.dq_range_audit(star.fact)),
        ("dq_constraints", lambda: quality.dq_constraints(star)),
    ):
        timed(name, lambda: audit().collect())
    queries = registry.queries()
    timed("stored_models", lambda: queries["route_scorecard"](spark, folder).collect())
    for name in HEADLINES:
        timed(name, lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "load, results and single analyses",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
