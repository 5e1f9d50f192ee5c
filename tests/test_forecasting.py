import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfline.operators import encoding as en, features as ft, forecasting as fc


@pytest.fixture(scope="module")
def ready(series):
    rng = np.random.default_rng(11)
    day = np.arange(800)
    values = {(s, f): np.clip(40 + 10 * s + 15 * np.sin(2 * np.pi * day / 365.25) + 8 * (day % 7 > 4)
                              + rng.normal(0, 2, 800), 0, None).tolist() for s in (1, 2) for f in ("A", "B")}
    return ft.build_features(series(values)).cache()


def test_metrics_match_definition(spark):
    pdf = pd.DataFrame({"actual": [0.0, 2.0, 4.0, 5.0], "predicted": [1.0, 2.0, 5.0, 3.0]})
    row = fc.regression_metrics(spark.createDataFrame(pdf)).first()
    e = pdf.actual - pdf.predicted
    assert row.MAE == pytest.approx(e.abs().mean()) and row.RMSE == pytest.approx(np.sqrt((e ** 2).mean()))
    assert row.R2 == pytest.approx(1 - (e ** 2).sum() / ((pdf.actual - pdf.actual.mean()) ** 2).sum())
    sold = pdf.actual > 0
    assert row.MAPE == pytest.approx((e[sold] / pdf.actual[sold]).abs().mean() * 100)


def test_mape_without_sales_is_zero(spark):
    assert fc.regression_metrics(spark.createDataFrame([(0.0, 1.0)], "actual double, predicted double")).first().MAPE == 0.0


def test_trees_beat_the_mean_and_keep_keys(spark, ready, tmp_path):
    train, test = fc.split_by_year(ready, 2022)
    model, seconds = fc.train_gbt(train, maxIter=8, maxDepth=4, stepSize=0.3, seed=42)
    predictions = fc.predict_gbt(model, test).cache()
    metrics = fc.evaluate_gbt(predictions, seconds)
    assert metrics.first().R2 > 0.5 and seconds > 0
    assert predictions.count() == test.count() and predictions.where("predicted < 0").count() == 0
    importance = fc.feature_importance(spark, model)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert importance.count() == len(fc.available_features(ready))
    fc.save_model(model, metrics, str(tmp_path))
    again, _ = fc.load_model(spark, str(tmp_path))
    assert fc.predict_gbt(again, test).exceptAll(predictions).count() == 0


def test_seasonal_forecast(ready):
    forecast = fc.seasonal_forecast(ready, 2022).cache()
    assert forecast.count() == ready.where("year >= 2022").count() and forecast.where("predicted < 0").count() == 0
    metrics = fc.seasonal_metrics(forecast).toPandas()
    assert (metrics.R2 > 0.5).all() and (metrics.train_size == 731).all()
    assert fc.seasonal_forecast(ready, 2022, k=1).select("store_id", "family").distinct().count() == 1
    assert fc.seasonal_forecast(ready, 2022, min_train=732).count() == 0


def plain_fit(days, sales, train):
    """The ridge fit of one series over its whole design matrix."""
    start, span = days[train].min(), max(np.ptp(days[train]), 1.0)
    t = (days - start) / span
    columns = [np.ones_like(t), t, *[np.maximum(t - k, 0.0) for k in np.linspace(0, 0.8, 26)[1:]]]
    for period, order in ((365.25, 10), (7.0, 3)):
        for k in range(1, order + 1):
            columns += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    design = np.column_stack(columns)
    penalty = np.diag([1e-6] * 2 + [20.0] * 25 + [0.1] * 26)
    weights = np.linalg.solve(design[train].T @ design[train] + penalty, design[train].T @ sales[train])
    return np.clip(design[~train] @ weights, 0, None)


def test_sums_give_the_fit_of_the_whole_series(ready):
    got = fc.seasonal_forecast(ready.repartition(7), 2022).toPandas().sort_values(["store_id", "family", "date"])
    rows = ready.toPandas().sort_values(["store_id", "family", "date"])
    for key, own in rows.groupby(["store_id", "family"]):
        stamps = np.array(own["date"], "datetime64[D]")
        want = plain_fit((stamps - np.datetime64(fc.EPOCH)).astype(float), own["sales"].to_numpy(float), stamps < np.datetime64("2022-01-01"))
        mine = got[(got.store_id == key[0]) & (got.family == key[1])]
        np.testing.assert_allclose(mine["predicted"], want, rtol=1e-6, atol=1e-6)


def test_model_comparison_names_a_winner(spark):
    trees = spark.createDataFrame([(1.0, 1.0, 0.9)], "MAE double, RMSE double, R2 double")
    series_ = spark.createDataFrame([(2.0, 2.0, 0.7), (2.0, 4.0, 0.9)], "MAE double, RMSE double, R2 double")
    rows = {r.metric: r for r in fc.model_comparison(trees, series_).collect()}
    assert rows["R2"].seasonal == pytest.approx(0.8) and rows["MAE"].winner == "boosted_trees"
    assert {r.winner for r in fc.model_comparison(trees, series_.where("R2 > 1")).collect()} == {"boosted_trees"}


def test_histogram_counts_every_row(spark):
    frame = spark.range(1000).select(F.col("id").cast("double").alias("actual"), F.lit(0.0).alias("predicted"))
    bins = fc.error_histogram(frame, 100).toPandas()
    assert bins["rows"].sum() == 1000 and bins.bin.min() == 1 and bins.bin.max() == 100
    same = fc.error_histogram(frame.where("id = 3"), 10).collect()
    assert [(r.bin, r.rows) for r in same] == [(1, 1)]


def test_timeline_runs_are_equal(spark, ready):
    predictions = ready.select("store_id", "family", "date", F.col("sales").alias("actual"), F.lit(1.0).alias("predicted"))
    got = fc.timeline_buckets(predictions, 30).toPandas().sort_values("period")
    rows = predictions.toPandas().sort_values(["date", "store_id", "family"])["actual"].to_numpy()
    size = len(rows) // 30
    np.testing.assert_allclose(got.actual, [rows[k * size:(k + 1) * size].mean() for k in range(30)])


def test_feature_matrix_skips_missing(ready):
    assert "store_type_encoded" not in fc.available_features(ready)
    assert fc.feature_matrix(ready).first().features.size == len(fc.available_features(ready))


def test_encodings(spark):
    frame = spark.createDataFrame([("A", "FMCG"), ("E", "Other"), (None, None)], "store_type string, category string")
    out = en.encode_category(en.encode_store_type(frame)).collect()
    assert [(r.store_type_encoded, r.category_encoded) for r in out] == [(5, 3), (2, 0), (0, 0)]


def test_season_tag(spark):
    frame = spark.createDataFrame([("is_friday", 0.1), ("oil_price", 0.2)], "feature string, importance double")
    assert {r.feature: r.is_season_feature for r in fc.season_feature_tag(frame).collect()} == {"is_friday": 1, "oil_price": 0}
