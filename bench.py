"""Time the load steps and the headline queries; prints one JSON line.

Load steps (``load_*``) are timed once, from the raw tables to the written table. Queries read the written
tables and are timed on a warm session (second run), each into a sink that takes every row.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfline.session import build_session  # noqa: E402
from testbed import registry  # noqa: E402
from testbed.tables import Bed, bed  # noqa: E402

HEADLINE = [
    "q01_top_products", "q02_monthly_season", "q03_ramadan_impact", "q04_stockout_hotspots", "q05_store_ranking",
    "q06_weekend_weekday", "q07_promotion_lift", "q08_yoy_growth", "q09_payday_effect", "q10_reorder_alerts",
    "lag_features", "rolling_mean", "rolling_std", "consecutive_zeros", "cap_outliers_quantile", "join_oil_asof",
    "join_back_aggregates", "star_join", "stockout_overall", "stockout_by_season", "stockout_heatmap", "risk_scores",
    "reorder_points", "alert_ladder", "timeline_buckets", "regression_metrics", "error_histogram", "profile_sales",
    "dash_kpis", "dash_monthly_sales", "seasonal_forecast", "flow_alerts",
]
LOADS = {
    "load_raw": lambda b: [b.raw.sales, b.raw.stores, b.raw.holidays, b.raw.oil, b.raw.cpi],
    "load_merged": lambda b: b.merged,
    "load_featured": lambda b: b.featured,
    "load_warehouse": lambda b: [b.house.fact, b.house.rejects, b.house.dim_economic, b.house.dim_cpi],
    "load_ml_ready": lambda b: b.ml_ready,
    "train_gbt": lambda b: b.trees(),
}


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("shelfline-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    tables: Bed = bed(spark, sf_dir)
    for name, load in LOADS.items():
        times[name] = timed(lambda: load(tables))
    for key in HEADLINE:
        def run(key=key):
            registry.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        times[key] = timed(run)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus}))
    tables.stage.close()
    spark.stop()


if __name__ == "__main__":
    main()
