import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import features as ft, flows, questions as qs, warehouse as wh
from shelfline.plans.staging import WrittenTables
from shelfline.sources.calendar import dim_date, generate_calendar
from shelfline.sources.products import product_seed

PRODUCTS = [("A", "FMCG", "x", 1, 0), ("B", "Fresh", "y", 1, 1)]


@pytest.fixture(scope="module")
def featured(series):
    panel = series({(1, "A"): [30, 0, 0, 0, 0], (1, "B"): [4, 5, 6, 7, 8], (2, "C"): [1] * 5, (9, "A"): [2] * 5})
    full = ft.build_features(panel.withColumns({"onpromotion": F.lit(1), "onpromotion_count": F.lit(3)}))
    return full.withColumn("oil_price", F.lit(50.125)).cache()


@pytest.fixture(scope="module")
def stores(spark):
    return spark.createDataFrame([(1, "x", "s", "A", 1), (2, "y", "s", "Q", 1)], schemas.STORES)


@pytest.fixture(scope="module")
def dims(spark, featured, stores):
    days = dim_date(generate_calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 4)))
    return days, wh.load_dim_store(stores, featured), wh.load_dim_product(product_seed(spark, PRODUCTS))


def test_published_calendar_and_seed(spark):
    assert generate_calendar(spark).count() == 1826
    seed = product_seed(spark)
    assert seed.count() == 33
    assert {r.category: r["count"] for r in seed.groupBy("category").count().collect()} == {"FMCG": 7, "Fresh": 10, "Non-Food": 16}


def test_dim_date_with_holidays(spark):
    events = spark.createDataFrame([(dt.date(2013, 1, 1), 1), (dt.date(2013, 1, 1), 0), (dt.date(2013, 1, 2), 0)],
                                   "date date, is_national int")
    rows = dim_date(generate_calendar(spark, dt.date(2013, 1, 1), dt.date(2013, 1, 3)), events).orderBy("date_key").collect()
    assert [(r.is_holiday, r.is_national_holiday) for r in rows] == [(1, 1), (1, 0), (0, 0)]
    assert (rows[0].date_key, rows[0].month_name, rows[0].day_name) == (20130101, "January", "Tuesday")
    assert rows[0].asDict().keys() == {f.name for f in schemas.DIM_DATE}


def test_keep_and_reject_add_up(featured, dims, stores):
    rows = wh.classify_fact_rows(featured, *dims, stores)
    kept, rejected = wh.fact_rows(rows), wh.fact_rejects(rows)
    assert kept.count() + rejected.count() == featured.count() == 20
    reasons = {r.reject_reason: r["count"] for r in rejected.groupBy("reject_reason").count().collect()}
    assert reasons == {"unknown_family": 5, "unknown_date": 3, "unknown_store": 4}
    assert kept.select("sale_key").distinct().count() == kept.count() == 8


def test_value_out_of_range_is_rejected_not_fatal(featured, dims, stores):
    huge = featured.withColumn("sales", F.when(F.col("family") == "B", 1e12).otherwise(F.col("sales")))
    rejected = wh.fact_rejects(wh.classify_fact_rows(huge, *dims, stores))
    assert rejected.where("reject_reason = 'value_out_of_range'").count() == 4
    assert wh.load_fact(huge, *dims, stores).agg(F.max("sales")).first()[0] == Decimal("30.00")


def test_fact_types_and_rounding(featured, dims):
    fact = wh.load_fact(featured, *dims)
    kinds = dict(fact.dtypes)
    assert kinds["sales"] == "decimal(12,2)" and kinds["oil_price"] == "decimal(8,2)" and kinds["consecutive_zeros"] == "int"
    assert fact.first().oil_price == Decimal("50.12")


def test_star_join_broadcasts_every_dimension(featured, dims, stores):
    star = wh.star_join(wh.load_fact(featured, *dims, stores), *dims, stores)
    assert len(star.columns) == 53 and star.count() == 8
    plan = star._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 3


def test_store_dimension_defaults(dims):
    rows = {r.store_id: r for r in dims[1].collect()}
    assert rows[2].store_size == "Unknown" and rows[1].store_size == "Large"
    assert rows[1].avg_daily_sales == Decimal("6.00") and rows[1].stockout_rate == Decimal("40.00")


def test_updates_keep_rows_without_metrics(featured, dims):
    panel = featured.where("store_id = 1 and family = 'B'")
    products = {r.family: r for r in wh.update_product_metrics(dims[2], panel).collect()}
    assert products["B"].popularity_rank == 1 and products["B"].total_revenue == Decimal("30.00")
    assert products["A"].popularity_rank == 0 and products["A"].avg_daily_sales == Decimal("0.00")


def test_economic_skips_unknown_days(spark, dims):
    oil = spark.createDataFrame([(dt.date(2020, 1, 1), None), (dt.date(2020, 1, 2), 10.0), (dt.date(2020, 1, 3), 13.0),
                                 (dt.date(2020, 2, 1), 1.0)], schemas.OIL)
    rows = wh.load_dim_economic(oil, dims[0]).orderBy("date_key").collect()
    assert [r.oil_price for r in rows] == [Decimal("10.00"), Decimal("10.00"), Decimal("13.00")]
    assert [r.oil_price_change for r in rows] == [Decimal("0.00"), Decimal("0.00"), Decimal("3.00")]
    assert rows[2].oil_price_7d_avg == Decimal("11.00")


def test_cpi_defaults(spark):
    cpi = spark.createDataFrame([(None, None, None, None, None, None, None, None, None),
                                 (dt.date(2020, 1, 1), 2020, 1, 7, "n" * 300, 2.675, 0.125, "c" * 150, 1.0)], schemas.CPI)
    rows = wh.load_dim_cpi(cpi).orderBy("cpi_key").collect()
    assert (rows[0].year, rows[0].item_name, rows[0].city_price) == (2019, "Unknown", Decimal("0.00"))
    assert (len(rows[1].item_name), len(rows[1].city)) == (200, 100)
    assert (rows[1].national_avg_price, rows[1].pct_change) == (Decimal("2.67"), Decimal("0.12"))


def test_q10_and_latest_day(featured, dims):
    fact = wh.load_fact(featured, *dims)
    assert qs.latest_fact_day(fact, dims[0]).first()[0] == dt.date(2020, 1, 4)
    got = qs.q10_reorder_alerts(fact, dims[0], dims[1], dims[2], min_demand=5).collect()
    assert [(r.store_id, r.family, r.days_without_sale, r.normal_daily_demand) for r in got] == [(1, "A", 3, 7.5)]


def test_q07_without_plain_days_has_null_lift(featured, dims):
    rows = qs.q07_promotion_lift(wh.load_fact(featured, *dims), dims[2]).collect()
    assert {r.promotion_lift for r in rows} == {None}


def test_format_report(spark):
    frame = spark.createDataFrame([(1234.5, 0.5)], "a double, b double")
    row = qs.format_report(frame, {"a": 0, "b": 1}, percent=("b",)).first()
    assert (row.a, row.b) == ("1,234", "0.5%")


def test_flows_lazy_and_written_agree(spark, tmp_path):
    from testbed.tables import StandIns
    raw = StandIns(spark, "/root/testdata/sf0.001")
    lazy = flows.clean_flow(raw)
    written = flows.clean_flow(raw, WrittenTables(spark, str(tmp_path)))
    assert lazy.dtypes == written.dtypes
    assert lazy.agg(F.sum("sales"), F.count("*"), F.sum("is_anomaly_day")).first() == \
        written.agg(F.sum("sales"), F.count("*"), F.sum("is_anomaly_day")).first()


def test_sale_keys_hold_any_product_and_refuse_negative_ones(spark, featured, dims, stores):
    classified = wh.classify_fact_rows(featured, *dims, stores)
    wide = classified.withColumn("product_key", F.col("product_key") + 20_000).withColumn("store_key", F.col("store_key") * 100_000)
    kept = wh.fact_rows(wide)
    assert kept.select("sale_key").distinct().count() == kept.count() == 8
    with pytest.raises(Exception, match="negative key"):
        wh.fact_rows(classified.withColumn("store_key", F.lit(-1))).select("sale_key").collect()
