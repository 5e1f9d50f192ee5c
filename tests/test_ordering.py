import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from shelfline.plans.ordering import _spans_near, exact_quantile, with_rank, with_row_number
from shelfline.plans.staging import lazy

rng = np.random.default_rng(7)
HOT = np.concatenate([np.zeros(700), rng.lognormal(3, 2, 300), [1e9]])


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.7, 0.93, 0.995, 1.0])
@pytest.mark.parametrize("buckets", [2, 16, 64])
def test_exact_quantile(spark, q, buckets):
    frame = spark.createDataFrame(pd.DataFrame({"v": HOT}))
    got = exact_quantile(frame, "v", q, buckets).first()[0]
    assert got == pytest.approx(pd.Series(HOT).quantile(q), rel=1e-12)


def test_quantile_of_1_to_100(spark):
    assert exact_quantile(spark.range(1, 101), "id", 0.995).first()[0] == pytest.approx(99.505)


def test_quantile_of_nothing_is_null(spark):
    assert exact_quantile(spark.range(0), "id", 0.5).first()[0] is None


@pytest.mark.parametrize("n, q", [(1, 0.1), (2, 0.995), (3, 0.1), (7, 0.5), (1999, 0.995)])
def test_quantiles_of_any_size_and_type(spark, n, q):
    values = pd.DataFrame({"v": rng.integers(0, max(2, n // 3), n), "w": rng.normal(0, 9, n)})
    frame = spark.createDataFrame(values).repartition(3).withColumn("d", F.col("w").cast("decimal(20,6)"))
    assert exact_quantile(frame, "v", q, 4).first()[0] == pytest.approx(values.v.quantile(q))
    assert exact_quantile(frame, "d", q, 4).first()[0] == pytest.approx(values.w.round(6).quantile(q))


def test_quantile_moves_only_values_near_it(spark, tmp_path):
    rows = spark.range(200_000).select(F.hash("id").cast("double").alias("v"), F.col("id"))
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    near = _spans_near(table, "v", 0.9, 8)
    assert near.count() < 200  # distinct values are 200,000
    got = exact_quantile(table, "v", 0.9, 8)
    assert got.first()[0] == pytest.approx(table.toPandas().v.quantile(0.9), rel=1e-12)
    plan = got._jdf.queryExecution().executedPlan()
    got.collect()
    run = plan.toString().rsplit("\n+- == Initial Plan ==", 1)[0]
    assert "ReusedExchange" in run and "ReusedSubquery" in run  # one scan for the sketch, one for the values


@pytest.mark.parametrize("method", ["min", "average"])
@pytest.mark.parametrize("bounded", [True, False])
def test_rank_with_ties(spark, tmp_path, method, bounded):
    bound = None
    if bounded:
        spark.range(500).write.parquet(str(tmp_path / "b"))
        bound = spark.read.parquet(str(tmp_path / "b"))
    values = pd.DataFrame({"k": range(500), "v": rng.integers(0, 40, 500).astype(float)})
    got = with_rank(spark.createDataFrame(values), "v", "r", method, bound, buckets=8).toPandas().sort_values("k")
    assert got["r"].tolist() == values["v"].rank(ascending=False, method=method).tolist()


def test_two_equal_totals_share_rank_one_and_a_half(spark):
    frame = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0)], "k string, v double")
    got = {r.k: r.r for r in with_rank(frame, "v", "r", method="average").collect()}
    assert got == {"a": 1.5, "b": 1.5, "c": 3.0}


def test_row_number_is_global_and_dense(spark):
    frame = pd.DataFrame({"k": np.sort(rng.integers(0, 5, 300)), "t": [f"{x:04d}" for x in range(300)]})
    got = with_row_number(spark.createDataFrame(frame).repartition(5), ["k", "t"], "rn", total="n").toPandas()
    got = got.sort_values(["k", "t"])
    assert got["rn"].tolist() == list(range(1, 301))
    assert set(got["n"]) == {300}


@pytest.mark.parametrize("kind", ["decimal(38,0)", "bigint"])
@pytest.mark.parametrize("bounded", [True, False])
def test_ranks_of_keys_beyond_doubles(spark, tmp_path, kind, bounded):
    first = 9007199254740993 if kind == "bigint" else 90071992547409930001
    rows = spark.createDataFrame([(str(first + k),) for k in (0, 1, 1, 2)], "k string").selectExpr(f"cast(k as {kind}) k")
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    got = with_rank(table, "k", "r", bound=table if bounded else None).orderBy("k").collect()
    assert [r.r for r in got] == [4, 2, 2, 1]


def test_row_numbers_refuse_a_lazy_stage(spark):
    with pytest.raises(ValueError, match="stage that writes"):
        with_row_number(spark.range(3), ["id"], stage=lazy)
