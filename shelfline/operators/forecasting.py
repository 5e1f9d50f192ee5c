"""Forecast models and their evaluation."""

from __future__ import annotations

import time
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shelfline.functions.lookups import MODEL_FEATURES, SEASON_WORDS
from shelfline.operators.features import SERIES
from shelfline.plans.ordering import with_row_number
from shelfline.plans.staging import Stage
from shelfline.session import ensure_checkpoint_dir

# The two published settings; penalties and minimum child weight have no Spark match.
LARGE_TREES = {"maxIter": 500, "maxDepth": 8, "stepSize": 0.05, "subsamplingRate": 0.8,
               "featureSubsetStrategy": "0.8", "minInstancesPerNode": 5, "seed": 42}
SMALL_TREES = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
               "minInstancesPerNode": 10, "seed": 42}


def split_by_year(df: DataFrame, test_from: int) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("year") < test_from), df.where(F.col("year") >= test_from)


def available_features(df: DataFrame) -> list[str]:
    return [c for c in MODEL_FEATURES if c in df.columns]


def feature_matrix(df: DataFrame, out: str = "features") -> DataFrame:
    """Keys, target and the feature vector; missing features are skipped, nulls are 0."""
    names = available_features(df)
    numbers = df.select(*SERIES, "date", F.col("sales").cast("double").alias("sales"),
                        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    return (VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep").transform(numbers)
            .select(*SERIES, "date", "sales", out))


def train_gbt(train: DataFrame, **params) -> tuple[PipelineModel, float]:
    """Fit boosted trees; returns the model and the seconds it took.

    Spark grows each level from histograms the executors build, so rows never leave them. The lineage
    over iterations is cut by checkpoints in the shared folder.
    """
    ensure_checkpoint_dir(train.sparkSession)
    names = available_features(train)
    rows = train.select(F.col("sales").cast("double").alias("label"),
                        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    trees = GBTRegressor(featuresCol="features", labelCol="label", predictionCol="raw_prediction",
                         checkpointInterval=10, **(params or LARGE_TREES))
    assembler = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    started = time.time()
    model = Pipeline(stages=[assembler, trees]).fit(rows)
    return model, time.time() - started


def predict_gbt(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Keyed predictions, not below 0."""
    names = model.stages[0].getInputCols()
    rows = test.select(*SERIES, "date", F.col("sales").cast("double").alias("actual"),
                       *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names])
    return model.transform(rows).select(*SERIES, "date", "actual",
                                        F.greatest("raw_prediction", F.lit(0.0)).alias("predicted"))


def metric_columns() -> list[Column]:
    actual, predicted = F.col("actual"), F.col("predicted")
    error = actual - predicted
    total = F.var_pop("actual") * F.count("actual")
    return [
        F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"),
        (1 - F.try_divide(F.sum(error * error), total)).alias("R2"),
        F.coalesce(F.avg(F.when(actual > 0, F.abs(error / F.nullif(actual, F.lit(0.0))))) * 100, F.lit(0.0))
        .alias("MAPE")]


def regression_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE, R2 and MAPE (over rows that sold) in one pass."""
    return predictions.agg(*metric_columns())


def evaluate_gbt(predictions: DataFrame, seconds: float) -> DataFrame:
    return regression_metrics(predictions).withColumn("Training_Time", F.lit(float(seconds)))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def top_features(importance: DataFrame, n: int = 15) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(n)


def season_feature_tag(importance: DataFrame) -> DataFrame:
    words = F.lower("feature").rlike("|".join(SEASON_WORDS))
    return importance.withColumn("is_season_feature", words.cast("int"))


def save_model(model: PipelineModel, metrics: DataFrame, path: str) -> None:
    model.write().overwrite().save(f"{path}/model")
    metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/metrics")


EPOCH = "2000-01-01"
KNOTS, PERIODS = 25, ((365.25, 10), (7.0, 3))
TERMS = 2 + KNOTS + 2 * sum(order for _, order in PERIODS)


def season_terms(day: Column, start: Column, span: Column) -> list[Column]:
    """Level, trend with hinges over the first 80 % of the training span, yearly and weekly Fourier terms of a day."""
    t = (day - start) / span
    hinges = [F.greatest(t - F.lit(float(k)), F.lit(0.0)) for k in np.linspace(0, 0.8, KNOTS + 1)[1:]]
    waves = [wave(day * F.lit(2 * np.pi * k / period)) for period, order in PERIODS for k in range(1, order + 1) for wave in (F.sin, F.cos)]
    return [F.lit(1.0), t, *hinges, *waves]


def _term_matrix(day: np.ndarray, start: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The terms of ``season_terms`` for many rows."""
    t = (day - start) / span
    hinges = [np.maximum(t - k, 0.0) for k in np.linspace(0, 0.8, KNOTS + 1)[1:]]
    waves = [wave(day * (2 * np.pi * k / period)) for period, order in PERIODS for k in range(1, order + 1) for wave in (np.sin, np.cos)]
    return np.column_stack([np.ones_like(t), t, *hinges, *waves])


def _normal_sums(batches):
    """X'X (upper half) and X'y of the rows of each series in a batch, in one array; such arrays add up."""
    upper = np.triu_indices(TERMS)
    for batch in batches:
        if not batch.num_rows:
            continue
        terms = _term_matrix(*[batch.column(c).to_numpy() for c in ("_day", "_start", "_span")])
        sales = batch.column("sales").to_numpy()
        keys = pd.MultiIndex.from_arrays([batch.column(c).to_pandas() for c in SERIES])
        codes, series = keys.factorize()
        order = np.argsort(codes, kind="stable")
        ends = np.searchsorted(codes[order], np.arange(len(series) + 1))
        sums = []
        for first, last in zip(ends[:-1], ends[1:]):
            rows = order[first:last]
            x = terms[rows]
            sums.append(np.concatenate([(x.T @ x)[upper], x.T @ sales[rows]]))
        yield pa.RecordBatch.from_arrays([
            pa.array(series.get_level_values(0), pa.int32()), pa.array(series.get_level_values(1), pa.string()), pa.array(sums, pa.list_(pa.float64()))],
            [*SERIES, "sums"])


def _solve(batches):
    """Ridge weights of each series from its sums; hinges are held back most, level and slope hardly."""
    penalty = np.full(TERMS, 0.1)
    penalty[:2], penalty[2:2 + KNOTS] = 1e-6, 20.0
    upper = np.triu_indices(TERMS)
    for batch in batches:
        out = []
        for sums in batch.column("sums").to_pylist():
            square = np.zeros((TERMS, TERMS))
            square[upper] = sums[:-TERMS]
            square += np.triu(square, 1).T
            out.append(np.linalg.solve(square + np.diag(penalty), np.array(sums[-TERMS:])))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in SERIES], pa.array(out, pa.list_(pa.float64()))], [*SERIES, "weights"])


def top_series(df: DataFrame, k: int = 3) -> DataFrame:
    return (df.groupBy(*SERIES).agg(F.sum("sales").alias("total_sales"))
            .orderBy(F.desc("total_sales"), *SERIES).limit(k))


def seasonal_forecast(df: DataFrame, test_from: int, k: int | None = None, min_train: int = 100,
                      min_test: int = 10) -> DataFrame:
    """A trend and season model per series, all series in parallel (or the k with most sales).

    The fit of a series rests on sums over its training days alone, which tasks add up in arrays; weights are solved per series and
    predictions are expressions over the test rows. No series is ever gathered. Predictions are made on the dates of the test
    rows themselves.
    """
    rows = df.groupBy(*SERIES, "date").agg(F.sum(F.col("sales").cast("double")).alias("sales"))
    if k is not None:
        rows = rows.join(F.broadcast(top_series(df, k).select(*SERIES)), SERIES, "left_semi")  # k rows
    rows = rows.withColumns({"store_id": F.col("store_id").cast("int"), "_day": F.datediff("date", F.lit(EPOCH).cast("date")).cast("double"),
                             "_test": F.year("date") >= test_from})
    day = F.when(~F.col("_test"), F.col("_day"))
    series = Window.partitionBy(*SERIES)  # at most one row per day
    first, last = F.min(day).over(series), F.max(day).over(series)
    placed = rows.withColumns({
        "_start": first, "_span": F.greatest(last - first, F.lit(1.0)), "train_size": F.count_if(~F.col("_test")).over(series).cast("int"),
        "_tests": F.count_if("_test").over(series)}).where((F.col("train_size") >= min_train) & (F.col("_tests") >= min_test))
    parts = placed.where(~F.col("_test")).select(*SERIES, "sales", "_day", "_start", "_span").mapInArrow(
        _normal_sums, "store_id int, family string, sums array<double>")
    none = F.array_repeat(F.lit(0.0), TERMS * (TERMS + 1) // 2 + TERMS)
    # an array for each batch that held days of the series, so no more than it has days
    sums = parts.groupBy(*SERIES).agg(F.aggregate(F.collect_list("sums"), none, lambda a, x: F.zip_with(a, x, lambda p, q: p + q)).alias("sums"))
    weights = sums.mapInArrow(_solve, "store_id int, family string, weights array<double>")
    terms = season_terms(F.col("_day"), F.col("_start"), F.col("_span"))
    fitted = reduce(lambda a, b: a + b, [F.col("weights")[k] * term for k, term in enumerate(terms)])
    return placed.where("_test").join(weights, SERIES).select(
        *SERIES, "date", F.col("sales").alias("actual"), F.greatest(fitted, F.lit(0.0)).alias("predicted"), "train_size")


def seasonal_metrics(forecast: DataFrame) -> DataFrame:
    mae, rmse, r2, _ = metric_columns()
    return forecast.groupBy(*SERIES).agg(mae, rmse, r2, F.max("train_size").alias("train_size"),
                                         F.count(F.lit(1)).alias("test_size"))


def model_comparison(tree_metrics: DataFrame, series_metrics: DataFrame) -> DataFrame:
    """Boosted trees against the mean of the series models, one row per metric, winner by R2."""
    mean = series_metrics.agg(*[F.avg(m).alias(m) for m in ("MAE", "RMSE", "R2")])
    both = tree_metrics.select(F.struct("MAE", "RMSE", "R2").alias("trees")).withColumn(
        "series", mean.select(F.struct("MAE", "RMSE", "R2").alias("s")).scalar())
    winner = (F.when(F.col("series.R2").isNull() | (F.col("trees.R2") > F.col("series.R2")), "boosted_trees")
              .otherwise("seasonal"))
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"trees.{m}").alias("boosted_trees"),
                              F.col(f"series.{m}").alias("seasonal"), winner.alias("winner"))
                     for m in ("MAE", "RMSE", "R2")])
    return both.select(F.inline(rows))


def prediction_errors(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("error", F.col("actual") - F.col("predicted"))


def error_histogram(predictions: DataFrame, bins: int = 100) -> DataFrame:
    """Equal-width bins of the error between its extremes; the top edge belongs to the last bin."""
    errors = prediction_errors(predictions)
    ends = errors.agg(F.struct(F.min("error").alias("lo"), F.max("error").alias("hi")).alias("e")).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo"))
    index = F.floor(F.try_divide(F.col("error") - F.col("_e.lo"), width) * bins) + 1
    return (errors.withColumn("_e", ends)
            .withColumn("bin", F.least(F.coalesce(index, F.lit(1)), F.lit(bins)).cast("int"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("rows"), F.min("_e.lo").alias("lowest_error"),
                                F.min("_e.hi").alias("highest_error")))


def prediction_sample(predictions: DataFrame, n: int = 5000) -> DataFrame:
    """n rows in the order of a hash of their keys: a sample that repeats on any cluster."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in (*SERIES, "date")]).cast("binary"))
    return predictions.orderBy(digest, *SERIES, "date").limit(n)


def timeline_buckets(predictions: DataFrame, groups: int = 100, stage: Stage | None = None) -> DataFrame:
    """Predictions in (date, store, family) order cut into equal runs; the rest after the last run is dropped."""
    rows = predictions.select(*SERIES, "date", "actual", "predicted")
    numbered = with_row_number(rows, ["date", *SERIES], "rn", total="n", stage=stage)
    size = F.greatest(F.floor(F.col("n") / groups), F.lit(1))
    return (numbered.withColumn("period", F.floor((F.col("rn") - 1) / size).cast("int"))
            .where(F.col("period") < groups)
            .groupBy("period").agg(F.avg("actual").alias("actual"), F.avg("predicted").alias("predicted")))
