import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.functions.lookups import ALERT_LEVELS
from shelfline.operators import features as ft, reports as rp, stockout as so

SNAPSHOT = ("store_id int, family string, city string, category string, is_fmcg int, is_zero_sale int, "
            "consecutive_zeros int, sales_rolling_mean_7d double, predicted_sales double, date date")
DAY = dt.date(2020, 1, 31)


def snapshot(spark, *rows):
    return spark.createDataFrame([(k, "F", None, None, *r, DAY) for k, r in enumerate(rows)], SNAPSHOT)


def test_every_rung_and_its_text(spark):
    rows = snapshot(spark, (1, 1, 3, 10.5, 0.0), (0, 1, 3, 10.5, 0.0), (1, 1, 2, 10.5, 99.0), (0, 1, 1, 2.5, 3.5),
                    (0, 1, 1, 5.5, 0.0), (0, 1, 1, 5.0, 0.0), (1, 1, 9, 10.0, 12.0), (1, 0, 0, 50.0, 99.0))
    got = {r.store_id: r for r in so.alert_ladder(rows).collect()}
    assert {k: r.alert_level for k, r in got.items()} == {0: "CRITICAL", 1: "HIGH", 2: "HIGH", 3: "MEDIUM", 4: "LOW",
                                                          6: "LOW"}
    assert got[0].alert_reason == "3 consecutive zero-sale days for high-demand FMCG product"
    assert got[1].alert_reason == "3 consecutive zero-sale days, avg demand: 10"
    assert got[3].alert_reason == "Stockout today, predicted demand (4) above average (2)"
    assert got[4].alert_reason == "Stockout today for product with avg demand 6"
    assert (got[0].city, got[0].category, got[0].suggested_order, got[0].date) == ("Unknown", "Unknown", 74.0, "2020-01-31")


def test_dead_series_is_medium_and_long_streaks_are_never_critical(spark, series):
    panel = ft.stockout_features(ft.rolling_mean(series({(1, "A"): [90] * 20 + [0] * 7, (2, "A"): [90] * 20 + [0] * 6,
                                                         (3, "A"): [0] * 300})))
    ready = panel.withColumns({"is_fmcg": F.lit(1), "city": F.lit("x"), "category": F.lit("FMCG"),
                               "predicted_sales": F.lit(0.4)})
    levels = {(r.store_id, r.consecutive_zeros): r.alert_level for r in so.alert_ladder(ready).collect()}
    assert levels[(2, 6)] == "CRITICAL" and levels[(1, 7)] == "MEDIUM" and levels[(3, 300)] == "MEDIUM"
    assert {c for (s, c), level in levels.items() if level == "CRITICAL"} == {3, 4, 5, 6}


def test_risk_bands_are_right_closed(spark):
    scores = [0.0, 0.1, 25.0, 25.1, 50.0, 75.0, 100.0, 100.1, None]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in scores], "s double").select(so.risk_category(F.col("s"))).collect()]
    want = pd.cut(pd.Series(scores), [0, 25, 50, 75, 100], labels=["Low", "Medium", "High", "Critical"])
    assert got == [None if pd.isna(w) else w for w in want]


@pytest.fixture(scope="module")
def ready(series):
    rng = np.random.default_rng(5)
    values = {(s, f): (rng.integers(0, 9, 40) * rng.integers(0, 2, 40)).tolist() for s in (1, 2, 3) for f in "AB"}
    df = ft.stockout_features(ft.history_features(series(values)))
    return df.withColumns({"city": F.concat(F.lit("c"), "store_id"), "store_type": F.lit("A"), "is_fmcg": F.lit(1),
                           "category": F.when(F.col("family") == "A", "FMCG").otherwise("Fresh"),
                           "day_name": F.date_format("date", "EEEE")}).cache()


@pytest.fixture(scope="module")
def two(series):
    """Two series of four days, small enough to work out by hand."""
    df = ft.stockout_features(ft.history_features(series({(1, "A"): [4, 0, 0, 8], (2, "B"): [2, 2, 0, 4]})))
    return df.withColumns({"city": F.lit("c"), "store_type": F.lit("A"), "is_fmcg": F.lit(1), "category": F.lit("FMCG")})


def test_risk_scores_by_hand(two, ready):
    # volatility: mean of the deviations of the days so far, (0 + 2.83 + 2.31 + 3.83) / 4 and (0 + 0 + 1.15 + 1.63) / 4
    got = {r.store_id: r for r in so.risk_scores(two).collect()}
    assert (got[1].stockout_rate, got[2].stockout_rate) == (50.0, 25.0)
    assert got[1].risk_score == 85.0  # 50 * 0.3, and the most of all in the other three
    assert got[2].risk_score == 43.7  # 25 * 0.3 + 66.67 * 0.3 + 50 * 0.2 + 31.09 * 0.2
    assert so.risk_distribution(so.risk_scores(ready)).agg(F.sum("pct")).first()[0] == pytest.approx(100)


def test_reorder_points_by_hand(two):
    got = {r.store_id: r for r in so.reorder_points(two).collect()}
    assert (got[1].safety_stock_95, got[2].safety_stock_95) == (9.0, 4.0)  # 8.94 and 3.81 over two days of lead time
    assert (got[1].reorder_point_95, got[2].reorder_point_95) == (15.0, 8.0)
    assert (got[1].max_stock_level, got[2].max_stock_level) == (30.0, 18.0)
    assert (got[1].median_demand, got[2].median_demand) == (2.0, 2.0)


def test_reorder_joins_risk_on_shared_partitioning(ready):
    joined = so.reorder_with_risk(so.reorder_points(ready), so.risk_scores(ready))
    assert joined.count() == 6
    plan = joined._jdf.queryExecution().executedPlan().toString()
    main = plan[:plan.index("Subquery")] if "Subquery" in plan else plan
    assert main.count("Exchange hashpartitioning(store_id") <= 2  # one for each side's sums, none for the join


def test_heatmap_fills_missing_cells(ready):
    only = ready.where((F.col("store_id") != 3) | (F.col("category") == "FMCG"))
    got = {r.store_id: r for r in so.stockout_heatmap(only, ["FMCG", "Fresh"], n=3).collect()}
    assert len(got) == 3 and got[3]["Fresh"] == 0.0
    assert so.stockout_heatmap(only, ["FMCG", "Fresh"], n=1).count() == 1


def test_snapshot_and_last_rows(ready):
    assert so.latest_snapshot(ready).count() == 6
    assert so.latest_snapshot(ready, "2020-01-05").select("date").distinct().first()[0] == dt.date(2020, 1, 5)
    gone = ready.where((F.col("store_id") != 2) | (F.col("date") < "2020-02-07"))
    rows = {(r.store_id, r.family): r.date for r in so.last_per_series(gone).collect()}
    assert rows[(2, "A")] == dt.date(2020, 2, 6) and rows[(1, "B")] == dt.date(2020, 2, 9)


def test_alert_summary_lists_every_level(spark):
    alerts = so.alert_ladder(snapshot(spark, (1, 1, 3, 10.5, 0.0), (1, 1, 4, 11.5, 0.0)))
    assert [(r.alert_level, r.alerts) for r in so.alert_summary(alerts).collect()] == list(zip(ALERT_LEVELS, (2, 0, 0, 0)))
    assert [r.store_id for r in so.sort_alerts_by_severity(alerts).collect()] == [1, 0]
    none = alerts.where("store_id < 0")
    assert [r.alerts for r in so.alert_summary(none).collect()] == [0, 0, 0, 0]


def test_predictions_join_by_key_or_fall_back(spark, ready):
    preds = ready.where("store_id = 1").select("store_id", "family", "date", F.lit(7.0).alias("predicted"))
    got = so.attach_predictions(ready, preds.orderBy(F.rand(1)))
    assert got.where("predicted_sales = 7.0").count() == 80 and got.where("predicted_sales is null").count() == 160
    assert so.attach_predictions(ready).where("predicted_sales <> sales").count() == 0


def test_weekday_without_rows_stays(ready):
    rows = rp.dash_dow_pattern(ready.where("day_name <> 'Friday'")).collect()
    assert [r.day_name for r in rows][0] == "Monday" and len(rows) == 7
    assert rows[4].avg_sales is None


def test_reports_on_no_rows(ready):
    row = rp.dash_stockout_kpis(ready.where("store_id < 0")).first()
    assert (row.total_days, row.stockout_pct, row.avg_selling) == (0, 0.0, 0.0)
