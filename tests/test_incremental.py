"""New days on top of a state, and reports from sums, against runs over the whole panel."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import features as ft, incremental as ic, reports as rp, rollup, stockout as so
from shelfline.plans.staging import WrittenTables

DAYS = 60
VALUES = {(1, "A"): [k * 7 % 5 for k in range(DAYS)], (1, "B"): [0] * DAYS, (2, "A"): [3, 0, 0, 9] + [0] * (DAYS - 4),
          (2, "B"): [float(k) for k in range(DAYS - 3)] + [0, 0, 0], (9, "C"): [0] * 20 + [5] * 20 + [0] * 20}


def plain(df):
    return df.toPandas().sort_values(["store_id", "family", "date"], ignore_index=True)


@pytest.fixture(scope="module")
def merged(series):
    return series(VALUES).withColumn("onpromotion", F.lit(1)).cache()


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    return WrittenTables(spark, str(tmp_path_factory.mktemp("steps")))


@pytest.fixture(scope="module")
def whole(merged, written):
    return written(ft.build_features(merged), "whole")


def cut(df, day, to=DAYS):
    start = dt.date(2020, 1, 1)
    return df.where(F.col("date").between(F.lit(start + dt.timedelta(days=day)), F.lit(start + dt.timedelta(days=to - 1))))


def history(whole, day):
    """Sales and streaks look back only, so the first days of the whole run are those of a run that ended there."""
    return cut(whole, 0, day)


@pytest.mark.parametrize("day,exclude", [(1, False), (40, False), (40, True)])
def test_new_days_are_those_of_a_whole_run(merged, whole, written, day, exclude):
    state = written(ic.series_state(history(whole, day)), "state")
    assert state.agg(F.max(F.size("recent"))).first()[0] == min(day, ic.DEPTH)
    got = ic.new_day_features(state, cut(merged, day), exclude)
    want = cut(ft.build_features(merged, exclude), day)
    assert set(got.columns) == set(want.columns) and dict(got.dtypes) == dict(want.dtypes)
    pd.testing.assert_frame_equal(plain(got.select(want.columns)), plain(want))


def test_day_by_day_states_add_up(merged, whole, written):
    state = written(ic.series_state(history(whole, 50)), "state")
    for day in range(50, 53):
        new = written(ic.new_day_features(state, cut(merged, day, day + 1), stage=written), "new")
        pd.testing.assert_frame_equal(plain(new.select("store_id", "family", "date", "consecutive_zeros", "sales_rolling_mean_30d", "sales_lag_28d")),
                                      plain(cut(whole, day, day + 1).select("store_id", "family", "date", "consecutive_zeros", "sales_rolling_mean_30d", "sales_lag_28d")))
        state = written(ic.advance_state(state, new), "state")
    want = ic.series_state(cut(whole, 0, 53))
    keys = ["store_id", "family"]
    pd.testing.assert_frame_equal(*[s.select(want.columns).toPandas().sort_values(keys, ignore_index=True).astype({"recent": str}) for s in (state, want)])


def test_series_that_begin_or_end(merged, whole, written):
    state = written(ic.series_state(history(whole, 40).where("store_id <> 9")), "state")
    days = cut(merged, 40).where("store_id <> 2")
    got = written(ic.new_day_features(state, days, stage=written), "new")
    fresh = {r.date: r.consecutive_zeros for r in got.where("store_id = 9").collect()}
    assert list(dict(sorted(fresh.items())).values()) == list(range(1, 21))
    after = {(r.store_id, r.family): r for r in ic.advance_state(state, got).collect()}
    assert after[2, "A"].last_day == dt.date(2020, 2, 9) and after[2, "A"]._n == 40  # untouched
    assert after[9, "C"].recent == [0.0] * 20 and after[9, "C"].streak == 20
    assert ic.new_day_features(state, days.limit(0)).count() == 0


def test_only_the_last_rows_of_a_series_are_read_back(merged, whole, written):
    state = written(ic.series_state(history(whole, 59)), "state")
    read = {path.split("/")[-2] for path in ic.new_day_features(state, cut(merged, 59)).inputFiles()}
    assert len(read) == 1 and read.pop().endswith("-state")  # and the days, which are not in files here
    assert ic.series_state(whole)._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") == 1


@pytest.fixture(scope="module")
def ready(whole, written):
    return written(whole.withColumns({"city": F.concat(F.lit("c"), "store_id"), "store_type": F.when(F.col("store_id") == 1, "A").otherwise("B"),
                              "category": F.concat(F.lit("k"), "family"), "day_name": F.date_format("date", "EEEE")}), "ready")


@pytest.mark.parametrize("report,part", [
    (rp.dash_kpis, rollup.by_month), (rp.dash_monthly_sales, rollup.by_month), (rp.dash_sales_by_type, rollup.by_month),
    (rp.dash_top_products, rollup.by_month), (rp.dash_dow_pattern, rollup.by_weekday), (rp.dash_season_impact, rollup.by_month),
    (rp.dash_stockout_kpis, rollup.by_month), (rp.dash_stockout_by_type, rollup.by_month), (rp.dash_stockout_by_category, rollup.by_month),
    (rp.dash_monthly_stockout, rollup.by_month), (so.stockout_overall, rollup.by_month), (so.stockout_by_store_type, rollup.by_month),
    (so.stockout_by_category, rollup.by_month), (so.stockout_by_dow, rollup.by_weekday), (so.stockout_by_season, rollup.by_month),
    (so.stockout_by_family, rollup.by_month), (so.stockout_by_month, rollup.by_month),
    (lambda df: rp.dash_stockout_heatmap(df, ["kA", "kB"]), rollup.by_month), (lambda df: rp.dash_store_card(df, 2), rollup.by_month),
    (lambda df: rp.dash_store_monthly(df, 2), rollup.by_month), (lambda df: rp.dash_store_top_products(df, 2), rollup.by_month),
    (lambda df: rp.dash_store_stockout_by_product(df, 2), rollup.by_month)])
def test_reports_from_sums_are_those_of_the_panel(ready, report, part):
    sums = rollup.panel_rollup(ready)
    want, got = report(ready), report(part(sums))
    assert got.columns == want.columns
    both = [df.toPandas().sort_values(list(df.columns), ignore_index=True) for df in (got, want)]
    pd.testing.assert_frame_equal(*both, check_dtype=False)


def test_sums_take_one_pass_and_counting_expands_no_panel_rows(ready):
    assert rollup.panel_rollup(ready)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    plan = rp.dash_kpis(ready)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.index("Aggregate [store_id")  # only the sums per series are expanded


def test_the_plan_of_the_totals_does_not_hang_on_the_ids_of_columns(spark, ready):
    for _ in range(16):  # each read gives new ids; about every second one failed before
        again = spark.read.schema(ready.schema).parquet(*ready.inputFiles())
        plan = rp.dash_kpis(again)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Expand") == 1 and plan.index("Expand") < plan.index("Aggregate [store_id")
    assert rp.dash_kpis(ready).first()[2:4] == tuple(ready.agg(F.countDistinct("store_id"), F.countDistinct("family")).first())
