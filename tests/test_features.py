import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import features as ft
from shelfline.operators.panel import densify_panel
from shelfline.plans.staging import WrittenTables
from shelfline.schemas import SALES
from shelfline.sources.sinks import write_bucketed

rng = np.random.default_rng(3)
VALUES = {(1, "A"): rng.integers(0, 4, 60).tolist(), (1, "B"): [5], (2, "A"): [3, 4], (2, "B"): [0] * 300}


@pytest.fixture(scope="module")
def panel(series):
    return series(VALUES)


def by_pandas(panel):
    return panel.toPandas().sort_values(["store_id", "family", "date"], ignore_index=True)


def each_day(past):
    """Expected values by hand: ``past`` gets the sales of a series up to and with a day."""
    return [past(values[:day + 1]) for _, values in sorted(VALUES.items()) for day in range(len(values))]


def deviation(xs):
    middle = sum(xs) / len(xs)
    return (sum((x - middle) ** 2 for x in xs) / (len(xs) - 1)) ** 0.5 if len(xs) > 1 else 0.0


def test_history_columns(panel):
    got = by_pandas(ft.history_features(panel))
    for n in (7, 14, 28):
        lagged = each_day(lambda xs, n=n: xs[-1 - n] if len(xs) > n else None)
        assert [None if pd.isna(x) else x for x in got[f"sales_lag_{n}d"]] == lagged
    for n in (7, 14, 30):
        np.testing.assert_allclose(got[f"sales_rolling_mean_{n}d"], each_day(lambda xs, n=n: np.mean(xs[-n:])))
    for n in (7, 14):
        np.testing.assert_allclose(got[f"sales_rolling_std_{n}d"], each_day(lambda xs, n=n: deviation(xs[-n:])), atol=1e-9)
    assert got["sales_rolling_min_7d"].tolist() == each_day(lambda xs: min(xs[-7:]))
    assert got["sales_rolling_max_7d"].tolist() == each_day(lambda xs: max(xs[-7:]))


def test_exclude_current_sees_only_the_past(panel):
    got = by_pandas(ft.history_features(panel, exclude_current=True))
    want = each_day(lambda xs: np.mean(xs[-8:-1]) if len(xs) > 1 else np.nan)
    np.testing.assert_allclose(got["sales_rolling_mean_7d"], want)


def test_streaks(panel):
    def streak(xs):
        count = 0
        while count < len(xs) and xs[-1 - count] == 0:
            count += 1
        return count

    got = by_pandas(ft.stockout_features(panel))
    assert got["consecutive_zeros"].tolist() == each_day(streak)
    assert got["consecutive_zeros"].max() == 300  # no 255 limit
    assert got["zero_sales_last_7d"].tolist() == each_day(lambda xs: xs[-7:].count(0))


def test_group_means_and_rank(panel):
    got = by_pandas(ft.join_back_aggregates(panel))

    def mean(keep):
        chosen = [x for key, values in VALUES.items() if keep(key) for x in values]
        return sum(chosen) / len(chosen)

    for row in got.itertuples():
        assert row.store_avg_daily_sales == pytest.approx(mean(lambda key, row=row: key[0] == row.store_id))
        assert row.family_avg_sales == pytest.approx(mean(lambda key, row=row: key[1] == row.family))
        assert row.store_product_avg == pytest.approx(mean(lambda key, row=row: key == (row.store_id, row.family)))
    assert set(zip(got["family"], got["family_popularity_rank"], strict=True)) == {("A", 1.0), ("B", 2.0)}


def test_many_unknown_groups_are_not_broadcast(spark):
    panel = spark.range(3_000_000).select(F.col("id").cast("int").alias("store_id"), F.lit("A").alias("family"),
                                          F.lit(dt.date(2020, 1, 1)).alias("date"), F.lit(1.0).alias("sales"))
    plan = ft.join_back_aggregates(panel)._jdf.queryExecution().analyzed().toString()
    assert plan.count("ResolvedHint") == 1  # the offsets of the ranking buckets, nothing that grows with the groups


def test_zero_store_mean_divides_by_one(series):
    got = ft.join_back_aggregates(series({(1, "A"): [0, 0]})).toPandas()
    assert got["sales_vs_store_avg"].tolist() == [0.0, 0.0]


def test_shuffled_input_gives_the_same(panel):
    one = by_pandas(ft.build_features(panel))
    two = by_pandas(ft.build_features(panel.orderBy(F.rand(5)).repartition(6)))
    pd.testing.assert_frame_equal(one, two)
    assert not one.isna().any().any()


def test_one_exchange_serves_all_windows(panel):
    plan = ft.stockout_features(ft.history_features(panel))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store_id") == 1
    assert plan.count("Sort [") == 1


def test_densify(spark):
    day = lambda k: dt.date(2020, 1, k)
    rows = [(day(1), 1, "A", 2.0, 1), (day(1), 1, "A", 3.0, 1), (day(3), 1, "A", 1.0, 0), (day(2), 2, "B", 4.0, 0)]
    out = densify_panel(spark.createDataFrame(rows, SALES), ["store_nbr", "family"]).toPandas()
    out = out.sort_values(["store_nbr", "date"], ignore_index=True)
    assert out["sales"].tolist() == [5.0, 0.0, 1.0, 0.0, 4.0, 0.0]
    assert out["onpromotion"].tolist() == [2, 0, 0, 0, 0, 0]


def test_dense_panel_feeds_windows_without_another_shuffle(spark):
    raw = spark.createDataFrame([(dt.date(2020, 1, 1), 1, "A", 2.0, 1)], SALES).withColumnRenamed("store_nbr", "store_id")
    dense = densify_panel(raw, ["store_id", "family"])
    plan = ft.lag_features(dense)._jdf.queryExecution().executedPlan().toString()
    series_exchanges = [l for l in plan.split("\n") if "Exchange hashpartitioning(store_id" in l and "date" not in l]
    assert len(series_exchanges) == 1


def test_bucketed_panel_is_not_exchanged(spark, panel, tmp_path):
    table = write_bucketed(panel.select("store_id", "family", "date", "sales"), "bucketed_panel_test", str(tmp_path / "panel"), 4)
    sums = ft.series_sums(table)
    windows = ft.stockout_features(ft.history_features(table))
    joined = windows.join(sums, ["store_id", "family"]).hint("merge")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table of any size
    try:
        for df in (sums, windows, joined):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    cols = windows.columns
    pd.testing.assert_frame_equal(by_pandas(windows), by_pandas(ft.stockout_features(ft.history_features(panel)).select(cols)))
    spark.sql("DROP TABLE bucketed_panel_test")


def test_densify_from_written_sums_is_the_same(spark, tmp_path):
    day = lambda k: dt.date(2020, 1, k)
    rows = [(day(1), 1, "A", 2.0, 1), (day(1), 1, "A", 3.0, 1), (day(3), 1, "A", 1.0, 0), (day(2), 2, "B", 4.0, 0)]
    sales = spark.createDataFrame(rows, SALES)
    with WrittenTables(spark, str(tmp_path)) as stage:
        written = densify_panel(sales, ["store_nbr", "family"], stage=stage)
        keys = ["store_nbr", "family", "date"]
        pd.testing.assert_frame_equal(*[df.toPandas().sort_values(keys, ignore_index=True) for df in (written, densify_panel(sales, keys[:2]))])
