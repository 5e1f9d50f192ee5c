"""Every registered query: key -> callable(spark, sf_dir) -> DataFrame.

Each runs over the whole tables. ``tidy`` gives columns a form that two engines print alike: doubles to
six decimals, decimals as doubles, dates as text, booleans as 0/1.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.operators import (cleaning as cl, encoding as en, features as ft, flows, forecasting as fc,
                                 incremental as ic, merging as mg, profiling as pf, questions as qs, reports as rp, stockout as so,
                                 warehouse as wh)
from shelfline.schemas import CPI, FACT_DECIMALS, FACT_INTEGERS, HOLIDAYS, OIL, SALES, STORES
from shelfline.sources import calendar as ca, readers as rd, sinks as sk
from shelfline.sources.products import product_seed
from testbed.tables import PRODUCTS, TEST_FROM, Bed, bed, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CATEGORIES = ["FMCG", "Fresh", "Non-Food"]
SERIES_DAY = ["store_id", "family", "date"]


def tidy(df: DataFrame) -> DataFrame:
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float") or kind.startswith("decimal"):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        elif kind == "boolean":
            c = c.cast("int")
        out.append(c.alias(name))
    return df.select(out)


def query(build: Callable[[Bed], DataFrame]) -> Callable[[Bed], DataFrame]:
    """Register a builder under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: tidy(build(bed(spark, sf_dir)))
    return build


def _count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _first_store(df: DataFrame) -> Column:
    """The smallest store with rows."""
    return df.agg(F.min("store_id")).scalar()


# ---- sources and sinks ------------------------------------------------------------------------------------

@query
def read_sales(b):
    return rd.read_sales(b.spark, b.raw.sales.inputFiles()[0].rsplit("/", 1)[0], "parquet").select(SALES.fieldNames())


def _reread(b: Bed, df: DataFrame, reader) -> DataFrame:
    return reader(b.spark, df.inputFiles()[0].rsplit("/", 1)[0], "parquet")


@query
def read_stores(b):
    return _reread(b, b.raw.stores, rd.read_stores).select(STORES.fieldNames())


@query
def read_holidays(b):
    return _reread(b, b.raw.holidays, rd.read_holidays).select(HOLIDAYS.fieldNames())


@query
def read_oil(b):
    return _reread(b, b.raw.oil, rd.read_oil).select(OIL.fieldNames())


@query
def read_cpi(b):
    return _reread(b, b.raw.cpi, rd.read_cpi).select(CPI.fieldNames())


@query
def generate_calendar(b):
    return ca.calendar_of(b.raw.sales)


@query
def product_seed_check(b):
    """Families that were sold, with their seed attributes; families without a seed row show nulls."""
    sold = b.raw.sales.groupBy("family").agg(F.sum("sales").alias("total_sales"))
    return sold.join(product_seed(b.spark, PRODUCTS), "family", "left").fillna("none", ["category", "subcategory"]) \
        .fillna(-1, ["is_fmcg", "is_perishable"])


QUERIES["product_seed"] = QUERIES.pop("product_seed_check")


@query
def load_dim_store(b):
    return b.house.dim_store


@query
def load_dim_economic(b):
    return b.house.dim_economic


@query
def load_dim_cpi(b):
    return b.house.dim_cpi


@query
def load_fact(b):
    return b.house.fact.withColumn("sale_key", F.col("sale_key").cast("string")).drop("fact_year")


@query
def update_store_metrics(b):
    stale = b.house.dim_store.withColumn("avg_daily_sales", F.lit(0).cast("decimal(12,2)"))
    return wh.update_store_metrics(stale, b.ml_ready, b.raw.stores)


@query
def update_product_metrics(b):
    return wh.update_product_metrics(b.house.dim_product, b.ml_ready)


@query
def export_subset(b):
    return sk.export_subset_stable(b.ml_ready.select(*SERIES_DAY, "sales"), TEST_FROM)


@query
def table_row_counts(b):
    h = b.house
    return wh.table_row_counts({"dim_date": h.dim_date, "dim_store": h.dim_store, "dim_product": h.dim_product,
                                "dim_economic": h.dim_economic, "dim_cpi": h.dim_cpi, "fact_daily_sales": h.fact})


@query
def union_all_counts(b):
    r = b.raw
    return wh.table_row_counts({"sales": r.sales, "stores": r.stores, "holidays": r.holidays, "oil": r.oil,
                                "cpi": r.cpi})


@query
def concat_subset(b):
    """Rows of the export by year: the whole test year, and the drawn share of the rest."""
    return _count(sk.export_subset_stable(b.ml_ready.select("year", *SERIES_DAY), TEST_FROM), "year")


# ---- cleaning ---------------------------------------------------------------------------------------------

def _doubled(b: Bed) -> DataFrame:
    """Raw sales with every promoted row present twice."""
    return b.raw.sales.unionByName(b.raw.sales.where(F.col("onpromotion") > 0))


@query
def dedup_rows(b):
    return cl.dedup_rows(_doubled(b))


@query
def dedup_by_key(b):
    return cl.dedup_by_key(table(b.spark, b.dir, "supplier").select("s_nationkey", "s_suppkey", "s_name"),
                           "s_nationkey")


@query
def coerce_dates(b):
    return cl.coerce_dates(b.raw.holidays)


@query
def promo_count_to_flag(b):
    return cl.promo_count_to_flag(b.raw.sales)


@query
def clip_negative(b):
    shifted = b.raw.sales.withColumn("sales", F.col("sales") - 10)
    return cl.clip_negative(shifted)


@query
def cap_outliers_quantile(b):
    return cl.cap_outliers_quantile(b.raw.sales)


@query
def flag_anomaly_days(b):
    return cl.flag_anomaly_days(b.raw.sales)


@query
def standardise_text(b):
    return cl.standardise_text(b.raw.stores, upper=("type",), title=("city", "state"))


@query
def drop_transferred(b):
    return cl.drop_transferred(b.raw.holidays)


@query
def flag_national(b):
    return cl.flag_national(b.raw.holidays)


@query
def clean_stores(b):
    return cl.clean_stores(b.raw.stores)


@query
def clean_sales(b):
    return cl.clean_sales(b.raw.sales, b.stage)


@query
def clean_holidays(b):
    return cl.clean_holidays(b.raw.holidays)


@query
def fill_forward_backward(b):
    return cl.fill_forward_backward(b.raw.oil, "dcoilwtico")


@query
def fill_numeric_nulls(b):
    return cl.fill_numeric_nulls(b.raw.cpi)


@query
def fill_critical_nulls(b):
    holes = b.panel.select(*SERIES_DAY, F.when(F.col("onpromotion") == 0, F.col("sales")).alias("sales")).withColumn(
        "family", F.when(F.col("family") != "LARGE", F.col("family")))
    return cl.fill_critical_nulls(holes)


@query
def map_store_size(b):
    return cl.map_store_size(b.raw.stores.withColumn("type", F.upper("type")).select("store_nbr", "type"))


@query
def encode_store_type(b):
    return en.encode_store_type(b.raw.stores.select("store_nbr", F.upper("type").alias("store_type")))


@query
def encode_category(b):
    sold = b.raw.sales.groupBy("family").agg(F.sum("sales").alias("total_sales"))
    named = sold.join(product_seed(b.spark, PRODUCTS).select("family", "category"), "family", "left")
    return en.encode_category(named).fillna("none", ["category"])


@query
def encode_family_rank(b):
    return en.encode_family_rank(b.panel).select(*SERIES_DAY, "family_encoded")


@query
def interaction_features(b):
    return b.ml_ready.select(*SERIES_DAY, "promo_weekend", "ramadan_fmcg", "wedding_grocery", "payday_spending")


@query
def alert_ladder(b):
    """Every day of the test year through the ladder, so that each rung has rows."""
    return so.alert_ladder(b.predicted)


@query
def risk_category(b):
    scored = b.risk.select("store_id", "family", (F.col("risk_score") * 2).alias("score"))
    return scored.withColumn("risk_category", F.coalesce(so.risk_category(F.col("score")), F.lit("none")))


@query
def latest_snapshot(b):
    return so.latest_snapshot(b.panel)


@query
def filter_store_year_category(b):
    return rp.filter_store_year_category(b.ml_ready.select("year", *SERIES_DAY, "category", "sales"),
                                         [1, 3, 5, 7], [1999, 2000], ["FMCG", "Fresh"])


@query
def filter_alert_levels(b):
    return so.filter_alert_levels(so.alert_ladder(b.predicted), ["CRITICAL", "HIGH"]).select(
        *SERIES_DAY, "alert_level", "suggested_order")


@query
def filter_store(b):
    return rp.filter_store(b.ml_ready.select(*SERIES_DAY, "sales"), _first_store(b.ml_ready))


@query
def split_by_year(b):
    train, test = fc.split_by_year(b.ml_ready.select("year", "sales"), TEST_FROM)
    return _count(train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test"))), "part")


@query
def filter_fmcg_having(b):
    return qs.fmcg_zero_rates(b.house.fact, b.house.dim_product).select(
        "store_key", "family", "total_days", "zero_sale_days", "stockout_rate")


@query
def latest_fact_date_filter(b):
    return qs.latest_fact_date_filter(b.house.fact, b.house.dim_date).select(
        "full_date", "store_key", "product_key", "sales")


@query
def scd_defaults_truncate(b):
    holes = b.raw.cpi.withColumns({"city": F.when(F.col("month") != 2, F.col("city")),
                                   "item_name": F.repeat("item_name", 30)})
    return wh.scd_defaults_truncate(holes)


@query
def to_warehouse_decimals(b):
    return wh.to_warehouse_decimals(b.featured).select(*SERIES_DAY, *FACT_DECIMALS, *FACT_INTEGERS)


@query
def period_label_case(b):
    return _count(b.house.dim_date.select(qs.period_label().alias("period")), "period")


@query
def format_report(b):
    return qs.format_report(qs.q01_top_products(b.house.fact, b.house.dim_product),
                            {"total_revenue": 0, "avg_daily_sales": 2})


# ---- joins ------------------------------------------------------------------------------------------------

@query
def join_store_attrs(b):
    return mg.join_store_attrs(b.raw.sales, cl.clean_stores(b.raw.stores))


@query
def join_holiday_flags(b):
    return mg.join_holiday_flags(b.raw.sales.select("store_nbr", "family", "date"), cl.clean_holidays(b.raw.holidays))


@query
def join_oil_asof(b):
    return mg.join_oil_asof(b.raw.sales.select("store_nbr", "family", "date"), b.raw.oil)


@query
def merge_all(b):
    return mg.merge_all(cl.clean_sales(b.raw.sales, b.stage), cl.clean_stores(b.raw.stores),
                        cl.clean_holidays(b.raw.holidays), cl.clean_oil(b.raw.oil))


@query
def join_sales_store_inner(b):
    return mg.join_sales_store_inner(b.raw.sales, b.raw.stores)


@query
def star_join(b):
    h = b.house
    return wh.star_join(h.fact, h.dim_date, h.dim_store, h.dim_product, b.raw.stores)


@query
def fact_date_join(b):
    return (b.house.fact.join(F.broadcast(b.house.dim_date.select("date_key", "quarter", "is_holiday")), "date_key")
            .groupBy("quarter", "is_holiday").agg(F.sum(F.col("sales").cast("double")).alias("total_sales")))


@query
def fact_product_join(b):
    names = b.house.dim_product.select("product_key", "category")
    return (b.house.fact.join(names, "product_key").groupBy("category")
            .agg(F.sum(F.col("sales").cast("double")).alias("total_sales")))


@query
def fact_store_join(b):
    return (b.house.fact.join(b.house.dim_store.select("store_key", "state"), "store_key").groupBy("state")
            .agg(F.sum(F.col("sales").cast("double")).alias("total_sales")))


@query
def fact_store_product_join(b):
    return (b.house.fact.join(b.house.dim_store.select("store_key", "state"), "store_key")
            .join(b.house.dim_product.select("product_key", "category"), "product_key").groupBy("state", "category")
            .agg(F.sum(F.col("sales").cast("double")).alias("total_sales")))


@query
def stores_with_metrics(b):
    return wh.stores_with_metrics(b.raw.stores, wh.store_metrics(b.featured))


@query
def product_key_lookup(b):
    """Rows per family with its key; the rejected family has key -1."""
    keyed = wh.product_key_lookup(b.panel, b.house.dim_product)
    return _count(keyed.fillna(-1, ["product_key"]), "family", "product_key")


@query
def fk_conformance(b):
    late = b.house.dim_date.where(F.col("full_date") >= "1996-01-01").select("date_key")
    kept, rejected = wh.fk_conformance(ft.add_date_key(b.panel.select("date", "sales")), late, "date_key")
    both = kept.withColumn("kept", F.lit(1)).unionByName(rejected.withColumn("kept", F.lit(0)))
    return _count(both.withColumn("year", F.year("date")), "year", "kept")


@query
def semi_join_in(b):
    return mg.semi_join_in(b.raw.sales, cl.anomaly_days(b.raw.sales).select("date"), "date", bounded=True)


@query
def join_back_aggregates(b):
    return ft.join_back_aggregates(b.panel, b.stage).drop("onpromotion")


@query
def attribute_lookup(b):
    return so.attribute_lookup(b.ml_ready, "store_id", ["city", "store_type"])


@query
def reorder_with_risk(b):
    return so.reorder_with_risk(so.reorder_points(b.analysed), b.risk).select(
        "store_id", "family", "reorder_point_95", "stockout_rate", "risk_score", F.coalesce(
            "risk_category", F.lit("none")).alias("risk_category"))


@query
def attach_predictions(b):
    """Predictions keyed by series and day; rows before the test year have none (-1 here)."""
    return so.attach_predictions(b.analysed.select(*SERIES_DAY, "sales"), b.predictions).fillna(
        -1.0, ["predicted_sales"])


# ---- aggregations -----------------------------------------------------------------------------------------

@query
def profile_table(b):
    return pf.profile_table(b.raw.cpi).drop("data_type")


@query
def profile_sales(b):
    return pf.profile_sales(b.raw.sales)


@query
def zero_negative_profile(b):
    return pf.zero_negative_profile(b.raw.sales)


@query
def family_stats(b):
    return pf.family_stats(b.raw.sales)


@query
def promotion_summary(b):
    return pf.promotion_summary(b.raw.sales)


@query
def promo_flag_means(b):
    return pf.promo_flag_means(b.raw.sales)


@query
def store_value_counts(b):
    return pf.store_value_counts(cl.clean_stores(b.raw.stores))


@query
def holiday_profile(b):
    return pf.holiday_profile(cl.coerce_dates(b.raw.holidays))


@query
def oil_profile(b):
    return pf.oil_profile(b.raw.oil)


@query
def cpi_profile(b):
    return pf.cpi_profile(b.raw.cpi)


@query
def preview_rows(b):
    events = pf.preview_events(cl.clean_holidays(b.raw.holidays)).select(F.lit("event").alias("kind"),
                                                                         F.col("description").alias("value"))
    items = pf.preview_items(b.raw.cpi).select(F.lit("item").alias("kind"), F.col("item_name").alias("value"))
    return events.unionByName(items)


@query
def cpi_city_mean(b):
    return pf.cpi_city_mean(b.raw.cpi, "NATION_5")


@query
def cpi_item_monthly(b):
    return pf.cpi_item_monthly(b.raw.cpi, "brand#2", city="NATION_5")


@query
def daily_sales_total(b):
    return pf.daily_sales_total(b.raw.sales)


@query
def sales_by_month(b):
    return pf.sales_by_month(b.raw.sales)


@query
def sales_by_dow(b):
    return pf.sales_by_dow(b.raw.sales)


@query
def sales_by_store_type(b):
    return pf.sales_by_store_type(b.raw.sales, b.raw.stores)


@query
def sales_by_year(b):
    return pf.sales_by_year(b.raw.sales)


@query
def zero_days_by_family(b):
    return pf.zero_days_by_family(b.raw.sales)


@query
def cleaning_report(b):
    return cl.cleaning_report(_doubled(b), cl.clean_stores(b.raw.stores), cl.clean_holidays(b.raw.holidays),
                              b.raw.oil, b.merged, b.stage)


@query
def null_summary(b):
    return pf.null_summary(b.raw.cpi)


@query
def store_metrics(b):
    return wh.store_metrics(b.featured)


@query
def product_metrics(b):
    return wh.product_metrics(b.featured)


@query
def store_avg_daily_sales(b):
    return ft.store_avg_daily_sales(b.panel.select(*SERIES_DAY, "sales"))


@query
def family_avg_sales(b):
    return ft.family_avg_sales(b.panel.select(*SERIES_DAY, "sales"))


@query
def store_product_avg(b):
    return ft.store_product_avg(b.panel.select(*SERIES_DAY, "sales"))


@query
def sales_vs_store_avg(b):
    with_mean = ft.store_avg_daily_sales(b.panel.select(*SERIES_DAY, "sales"))
    return ft.sales_vs_store_avg(with_mean).select(*SERIES_DAY, "sales_vs_store_avg")


@query
def stockout_overall(b):
    return so.stockout_overall(b.monthly)


@query
def stockout_by_store_type(b):
    return so.stockout_by_store_type(b.monthly)


@query
def stockout_by_category(b):
    return so.stockout_by_category(b.monthly, 10)


@query
def stockout_by_dow(b):
    return so.stockout_by_dow(b.weekdays)


@query
def stockout_by_season(b):
    return so.stockout_by_season(b.monthly)


@query
def stockout_by_family(b):
    return so.stockout_by_family(b.monthly)


@query
def stockout_by_month(b):
    return so.stockout_by_month(b.monthly)


@query
def risk_scores(b):
    return so.risk_scores(b.analysed, b.stage).fillna("none", ["risk_category"])


@query
def risk_distribution(b):
    return so.risk_distribution(b.risk).fillna("none", ["risk_category"])


@query
def reorder_points(b):
    return so.reorder_points(b.analysed)


def _alerts(b: Bed) -> DataFrame:
    return so.alert_ladder(b.predicted)


@query
def alert_summary(b):
    return so.alert_summary(_alerts(b))


@query
def alert_volume_by_family(b):
    return so.alert_volume_by_family(_alerts(b))


@query
def stockout_heatmap(b):
    return so.stockout_heatmap(b.monthly, CATEGORIES)


@query
def fact_quality_check(b):
    return wh.fact_quality_check(b.house.fact)


@query
def panel_verification(b):
    return ft.panel_verification(b.featured)


@query
def regression_metrics(b):
    return fc.regression_metrics(b.predictions)


@query
def conditional_avg(b):
    return qs.promo_means(b.house.fact, "store_key")


@query
def count_distinct_days(b):
    return b.raw.sales.groupBy(F.year("date").alias("year")).agg(F.countDistinct("date").alias("active_days"))


# ---- windows ----------------------------------------------------------------------------------------------

def _panel(b: Bed) -> DataFrame:
    return b.panel.select(*SERIES_DAY, "sales")


@query
def lag_features(b):
    return ft.lag_features(_panel(b)).fillna(-1.0)


@query
def rolling_mean(b):
    return ft.rolling_mean(_panel(b))


@query
def rolling_std(b):
    return ft.rolling_std(_panel(b))


@query
def rolling_max_min(b):
    return ft.rolling_max_min(_panel(b))


@query
def sales_trend(b):
    return ft.sales_trend(_panel(b))


@query
def zero_sales_last_7d(b):
    return ft.zero_sales_last_7d(ft.is_zero_sale(_panel(b)))


@query
def consecutive_zeros(b):
    return ft.consecutive_zeros(ft.is_zero_sale(_panel(b)))


@query
def oil_rolling_mean(b):
    return wh.oil_rolling_mean(cl.clean_oil(b.raw.oil))


@query
def oil_change(b):
    return wh.oil_change(cl.clean_oil(b.raw.oil))


@query
def family_popularity_rank(b):
    return ft.family_popularity_rank(_panel(b))


@query
def store_revenue_rank(b):
    return qs.store_revenue_rank(b.house.fact)  # no bound given: the distributed rank


@query
def yoy_growth(b):
    return qs.yoy_growth(qs.yearly_sales(b.house.fact, b.house.dim_date)).fillna(-999.0, ["yoy_growth"])


@query
def timeline_buckets(b):
    return fc.timeline_buckets(b.predictions, 100, b.stage)


@query
def last_per_series(b):
    return so.last_per_series(b.panel)


# ---- sorts and top-k --------------------------------------------------------------------------------------

@query
def top_families(b):
    best, worst = pf.top_families(b.raw.sales, 3), pf.top_families(b.raw.sales, 2, best=False)
    return best.withColumn("side", F.lit("best")).unionByName(worst.withColumn("side", F.lit("worst")))


@query
def top_n_sql(b):
    return (b.house.fact.orderBy(F.desc("sales"), "date_key", "store_key", "product_key").limit(30)
            .select("date_key", "store_key", "product_key", "sales"))


@query
def top_series(b):
    return fc.top_series(b.panel, 3)


@query
def top_risks(b):
    return so.top_risks(b.risk, 20).select("store_id", "family", "city", "stockout_rate",
                                                               "risk_score")


@query
def top_reorders(b):
    table_ = so.reorder_with_risk(so.reorder_points(b.analysed), b.risk)
    return so.top_reorders(table_, 50, active_only=True).select("store_id", "family", "avg_daily_demand",
                                                                "reorder_point_95", "risk_score")


@query
def sort_alerts_by_severity(b):
    return so.sort_alerts_by_severity(_alerts(b)).select("alert_level", *SERIES_DAY, "avg_daily_demand")


@query
def weekday_order(b):
    return so.weekday_order(b.ml_ready.groupBy("day_name").agg(F.avg(F.col("sales").cast("double")).alias("avg_sales")))


# ---- scalar functions -------------------------------------------------------------------------------------

@query
def calendar_features(b):
    return ft.calendar_features(b.panel.select(*SERIES_DAY))


@query
def season_flags(b):
    return ft.season_flags(b.panel.select(*SERIES_DAY))


@query
def dim_date(b):
    return b.house.dim_date


@query
def date_key(b):
    return ft.add_date_key(b.panel.select(*SERIES_DAY))


@query
def is_zero_sale(b):
    return ft.is_zero_sale(_panel(b))


# ---- the ten questions ------------------------------------------------------------------------------------

@query
def q01_top_products(b):
    return qs.q01_top_products(b.house.fact, b.house.dim_product)


@query
def q02_monthly_season(b):
    return qs.q02_monthly_season(b.house.fact, b.house.dim_date)


@query
def q03_ramadan_impact(b):
    return qs.q03_ramadan_impact(b.house.fact, b.house.dim_date)


@query
def q04_stockout_hotspots(b):
    return qs.q04_stockout_hotspots(b.house.fact, b.house.dim_store, b.house.dim_product, stores=b.raw.stores)


@query
def q05_store_ranking(b):
    return qs.q05_store_ranking(b.house.fact, b.house.dim_store, b.raw.stores)


@query
def q06_weekend_weekday(b):
    return qs.q06_weekend_weekday(b.house.fact, b.house.dim_date)


@query
def q07_promotion_lift(b):
    return qs.q07_promotion_lift(b.house.fact, b.house.dim_product)


@query
def q08_yoy_growth(b):
    return qs.q08_yoy_growth(b.house.fact, b.house.dim_date).fillna(-999.0, ["yoy_growth"])


@query
def q09_payday_effect(b):
    return qs.q09_payday_effect(b.house.fact, b.house.dim_date)


@query
def q10_reorder_alerts(b):
    h = b.house
    return qs.q10_reorder_alerts(h.fact, h.dim_date, h.dim_store, h.dim_product, stores=b.raw.stores)


# ---- forecasting ------------------------------------------------------------------------------------------

@query
def feature_matrix(b):
    from pyspark.ml.functions import vector_to_array
    matrix = fc.feature_matrix(b.analysed)
    return matrix.select(*SERIES_DAY, "sales", F.aggregate(
        vector_to_array("features"), F.lit(0.0), lambda a, x: a + x).alias("feature_sum"))


@query
def train_gbt(b):
    """Training error by year of the fitted trees."""
    train, _ = fc.split_by_year(b.analysed, TEST_FROM)
    fitted = fc.predict_gbt(b.trees()[0], train)
    return fitted.groupBy(F.year("date").alias("year")).agg(*fc.metric_columns())


@query
def predict_gbt(b):
    return fc.predict_gbt(b.trees()[0], fc.split_by_year(b.analysed, TEST_FROM)[1])


def _tree_predictions(b: Bed) -> DataFrame:
    return fc.predict_gbt(b.trees()[0], fc.split_by_year(b.analysed, TEST_FROM)[1])


@query
def evaluate_gbt(b):
    return fc.evaluate_gbt(_tree_predictions(b), b.trees()[1])


@query
def feature_importance(b):
    return fc.feature_importance(b.spark, b.trees()[0])


@query
def top_features(b):
    return fc.top_features(fc.feature_importance(b.spark, b.trees()[0]), 15)


@query
def seasonal_forecast(b):
    return fc.seasonal_forecast(b.analysed, TEST_FROM)


@query
def seasonal_forecast_facts(b):
    """What SQL can tell of the forecast: the rows, days and sales of each series that has enough of them."""
    return fc.seasonal_forecast(b.analysed, TEST_FROM).groupBy("store_id", "family").agg(
        F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("predicted") >= 0).alias("forecast_rows"), F.min("date").alias("first_day"),
        F.max("date").alias("last_day"), F.sum("actual").alias("sales"), F.min("train_size").alias("train_size"))


@query
def seasonal_metrics(b):
    return fc.seasonal_metrics(fc.seasonal_forecast(b.analysed, TEST_FROM, k=3))


@query
def model_comparison(b):
    return fc.model_comparison(fc.regression_metrics(_tree_predictions(b)),
                               fc.seasonal_metrics(fc.seasonal_forecast(b.analysed, TEST_FROM, k=3)))


@query
def prediction_errors(b):
    return fc.prediction_errors(b.predictions)


@query
def error_histogram(b):
    return fc.error_histogram(b.predictions)


@query
def prediction_sample(b):
    return fc.prediction_sample(b.predictions, 5000)


@query
def season_feature_tag(b):
    """Features ranked by their mean over the panel stand in for importances."""
    flags = [c for c in fc.available_features(b.analysed) if c.startswith("is_") or c in (
        "promo_weekend", "ramadan_fmcg", "wedding_grocery", "payday_spending")]
    means = b.analysed.agg(*[F.avg(c).alias(c) for c in flags])
    rows = means.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance"))
                                           for c in flags])))
    return fc.season_feature_tag(rows)


# ---- dashboard tables -------------------------------------------------------------------------------------

@query
def dash_kpis(b):
    return rp.dash_kpis(b.monthly)


@query
def dash_filter_counts(b):
    chosen = F.col("store_id").isin(1, 3, 5, 7) & F.col("year").isin(1999, 2000)
    return rp.dash_filter_counts(b.analysed, chosen)


@query
def dash_monthly_sales(b):
    return rp.dash_monthly_sales(b.monthly)


@query
def dash_sales_by_type(b):
    return rp.dash_sales_by_type(b.monthly)


@query
def dash_top_products(b):
    return rp.dash_top_products(b.monthly)


@query
def dash_dow_pattern(b):
    return rp.dash_dow_pattern(b.weekdays)


@query
def dash_season_impact(b):
    return rp.dash_season_impact(b.monthly)


@query
def dash_stockout_kpis(b):
    return rp.dash_stockout_kpis(b.monthly)


@query
def dash_stockout_by_type(b):
    return rp.dash_stockout_by_type(b.monthly)


@query
def dash_stockout_by_category(b):
    return rp.dash_stockout_by_category(b.monthly)


@query
def dash_monthly_stockout(b):
    return rp.dash_monthly_stockout(b.monthly)


@query
def dash_stockout_heatmap(b):
    return rp.dash_stockout_heatmap(b.monthly, CATEGORIES)


@query
def dash_alert_counts(b):
    return rp.dash_alert_counts(_alerts(b))


@query
def dash_alert_products(b):
    return rp.dash_alert_products(_alerts(b))


@query
def dash_store_card(b):
    return rp.dash_store_card(b.monthly, _first_store(b.monthly))


@query
def dash_store_monthly(b):
    return rp.dash_store_monthly(b.monthly, _first_store(b.monthly))


@query
def dash_store_top_products(b):
    return rp.dash_store_top_products(b.monthly, _first_store(b.monthly))


@query
def dash_store_stockout_by_product(b):
    return rp.dash_store_stockout_by_product(b.monthly, _first_store(b.monthly))


@query
def alert_totals(b):
    return so.alert_totals(b.risk, _alerts(b))


@query
def dash_store_alerts(b):
    return rp.dash_store_alerts(_alerts(b), _first_store(_alerts(b)))


# ---- whole flows ------------------------------------------------------------------------------------------

@query
def flow_clean(b):
    return b.merged


@query
def flow_features(b):
    return b.featured


@query
def flow_warehouse(b):
    """The accepted and the rejected rows of the load, by reason."""
    kept = b.house.fact.agg(F.lit("accepted").alias("outcome"), F.count(F.lit(1)).alias("n"))
    return kept.unionByName(_count(b.house.rejects.withColumnRenamed("reject_reason", "outcome"), "outcome"))


@query
def bucketed_features(b):
    """Lags, streaks and series means over the bucketed panel: no row of it is exchanged."""
    panel = b.bucketed.select(*SERIES_DAY, "sales")
    sums = ft.series_sums(panel).select("store_id", "family", (F.col("_sum") / F.col("_n")).alias("store_product_avg"))
    return ft.stockout_features(ft.lag_features(panel)).join(sums, ["store_id", "family"]).fillna(-1.0)


@query
def read_sales_csv(b):
    """Sales written as CSV and read back by the CSV reader, which is the default."""
    folder = f"{b.stage.root}/sales_csv_{uuid.uuid4().hex}"
    b.raw.sales.select(SALES.fieldNames()).write.csv(folder, header=True)
    return rd.read_sales(b.spark, folder).select(SALES.fieldNames())


@query
def critical_null_counts(b):
    """Null counts of the key columns, on a panel with holes: no family in May, no sales on Sundays."""
    holes = b.panel.withColumns({"family": F.when(F.month("date") != 5, F.col("family")), "sales": F.when(F.weekday("date") != 6, F.col("sales"))})
    return cl.critical_null_counts(holes)


@query
def incremental_features(b):
    """The last seven days from the state of the days before them: what a run over the whole history gives for those days."""
    first = F.date_sub(b.merged.agg(F.max("date")).scalar(), 6)
    state = b.stage(ic.series_state(b.featured.where(F.col("date") < first)), "series_state")
    return ic.new_day_features(state, b.merged.where(F.col("date") >= first), stage=b.stage).select(b.featured.columns)


@query
def panel_rollup(b):
    return b.rollup.fillna("-", ["year_month", "day_name"]).fillna(-1, ["month"])


@query
def flow_ml_ready(b):
    return b.ml_ready


@query
def flow_etl_report(b):
    """The counts of a first run; the times are read by no one, but must be in order."""
    return flows.run_etl(b.raw, b.house, f"{b.stage.root}/etl_run_{uuid.uuid4().hex}").select(
        "rows_extracted", "rows_transformed", "rows_loaded", "rows_repaired", "errors", "stores_updated", "products_updated",
        ((F.col("end_time") > F.col("start_time")) & (F.col("seconds") > 0)).alias("timed"))


@query
def full_reload(b):
    """Dimensions as a run has published them: the new version is read, the old one only counted."""
    stores, products = flows.publish_dimensions(b.house, b.ml_ready, f"{b.stage.root}/reload_{uuid.uuid4().hex}", b.raw.stores)
    stale = products.read(products.versions()[0]).where("total_revenue > 0").agg(F.count(F.lit(1))).scalar()
    return products.read().select("family", "avg_daily_sales", "total_revenue", "popularity_rank", "stockout_rate").withColumns(
        {"stale_rows": stale, "stores": stores.read().agg(F.count(F.lit(1))).scalar()})


@query
def flow_alerts(b):
    return flows.alerts_flow(b.analysed, b.predictions)
