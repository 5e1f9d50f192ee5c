"""The tables under each chart of the dashboard, on the model-ready panel or its sums (``rollup``), and on the alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.calendar import year_month
from shelfline.functions.lookups import SEASON_LABELS, WEEKDAYS
from shelfline.functions.rounding import round_scaled
from shelfline.operators.stockout import mean_of, row_count, season_means, stockout_heatmap


def filter_store_year_category(df: DataFrame, stores: list[int] | None = None, years: list[int] | None = None,
                               categories: list[str] | None = None) -> DataFrame:
    """Membership filters as plain predicates: they reach the scan, and the year prunes partitions."""
    if stores:
        df = df.where(F.col("store_id").isin(stores))
    if years:
        df = df.where((F.col("year") if "year" in df.columns else F.year("date")).isin(years))
    return df.where(F.col("category").isin(categories)) if categories else df


def filter_store(df: DataFrame, store_id: int | Column) -> DataFrame:
    return df.where(F.col("store_id") == store_id)


def _month(df: DataFrame) -> Column:
    return F.col("year_month") if "year_month" in df.columns else year_month(F.col("date"))


def dash_kpis(df: DataFrame) -> DataFrame:
    """Totals, and the distinct stores and families; these are counted over the sums per series, not by expanding the panel's rows.

    The sums have names of their own: Spark puts the columns it expands in an order of their ids, so a plan where both
    steps go by ``store_id`` and ``family`` shows now the one and now the other first.
    """
    keys = F.col("store_id").alias("store"), F.col("family").alias("product")
    series = df.groupBy(*keys).agg(F.sum("sales").alias("sales"), F.sum("is_zero_sale").alias("is_zero_sale"), row_count(df).alias("_rows"))
    return series.agg(F.sum("sales").alias("total_revenue"), mean_of(series, "sales").alias("avg_daily_sales"),
                      F.countDistinct("store").alias("stores"), F.countDistinct("product").alias("families"),
                      (mean_of(series, "is_zero_sale") * 100).alias("stockout_rate"))


def dash_filter_counts(df: DataFrame, chosen) -> DataFrame:
    """Rows shown against all rows for a filter condition, and the date range, in one pass."""
    return df.agg(F.count_if(chosen).alias("shown_rows"), F.count(F.lit(1)).alias("all_rows"),
                  F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def dash_monthly_sales(df: DataFrame) -> DataFrame:
    return df.groupBy(_month(df).alias("month")).agg(F.sum("sales").alias("sales")).orderBy("month")


def dash_sales_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("store_type").agg(mean_of(df, "sales").alias("avg_sales"), F.sum("sales").alias("total_sales"))


def dash_top_products(df: DataFrame, n: int = 10) -> DataFrame:
    return (df.groupBy("family").agg(F.sum("sales").alias("sales"))
            .orderBy(F.desc("sales"), "family").limit(n))


def dash_dow_pattern(df: DataFrame) -> DataFrame:
    """Mean per weekday, Monday first; a weekday without rows stays with a null mean."""
    def on(day: str, column: str) -> Column:
        return F.when(F.col("day_name") == day, F.col(column))

    columns = [(F.try_divide(F.sum(on(d, "sales")), F.sum(on(d, "_rows"))) if "_rows" in df.columns else F.avg(on(d, "sales"))).alias(d)
               for d in WEEKDAYS]
    rows = F.array(*[F.struct(F.lit(i).alias("day_order"), F.lit(d).alias("day_name"), F.col(d).alias("avg_sales"))
                     for i, d in enumerate(WEEKDAYS)])
    return df.agg(*columns).select(F.inline(rows)).orderBy("day_order")


# The labels the dashboard shows.
_DASH_SEASONS = {**SEASON_LABELS, "is_ramadan_period": "Ramadan"}


def dash_season_impact(df: DataFrame) -> DataFrame:
    means = season_means(df, "sales", list(_DASH_SEASONS))
    name = F.coalesce(*[F.when(F.col("flag") == f, F.lit(label)) for f, label in _DASH_SEASONS.items()])
    impact = F.when(F.col("outside") > 0, (F.col("inside") - F.col("outside")) / F.col("outside") * 100).otherwise(0.0)
    return means.select(name.alias("season"), round_scaled(F.col("inside"), 1).alias("during_season"),
                        round_scaled(F.col("outside"), 1).alias("normal_period"),
                        round_scaled(impact, 1).alias("impact_pct"))


def dash_stockout_kpis(df: DataFrame) -> DataFrame:
    # sales are never below 0, so those of the rows that sold are all sales
    selling = F.try_divide(F.sum("sales"), F.sum("_sold")) if "_rows" in df.columns else F.avg(F.when(F.col("sales") > 0, F.col("sales")))
    row = df.agg(F.coalesce(row_count(df), F.lit(0)).alias("total_days"), F.sum("is_zero_sale").alias("stockout_days"),
                 F.coalesce(mean_of(df, "is_zero_sale") * 100, F.lit(0.0)).alias("stockout_pct"),
                 F.coalesce(selling, F.lit(0.0)).alias("avg_selling"))
    return row.withColumn("est_lost", F.col("avg_selling") * F.col("stockout_days"))


def _rate(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg((mean_of(df, "is_zero_sale") * 100).alias("stockout_rate"))


def dash_stockout_by_type(df: DataFrame) -> DataFrame:
    return _rate(df, "store_type")


def dash_stockout_by_category(df: DataFrame) -> DataFrame:
    return _rate(df, "category").orderBy("stockout_rate", "category")


def dash_monthly_stockout(df: DataFrame) -> DataFrame:
    return _rate(df, _month(df).alias("month")).orderBy("month")


def dash_stockout_heatmap(df: DataFrame, categories: list[str]) -> DataFrame:
    return stockout_heatmap(df, categories, n=15)


def dash_alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_level").agg(F.count(F.lit(1)).alias("alerts"))


def dash_alert_products(alerts: DataFrame, n: int = 10) -> DataFrame:
    return (alerts.groupBy("family").agg(F.count(F.lit(1)).alias("alerts"))
            .orderBy(F.desc("alerts"), "family").limit(n))


def dash_store_card(df: DataFrame, store_id: int | Column) -> DataFrame:
    return filter_store(df, store_id).agg(
        F.min("city").alias("city"), F.min("store_type").alias("store_type"), F.sum("sales").alias("revenue"),
        mean_of(df, "sales").alias("avg_sales"), (mean_of(df, "is_zero_sale") * 100).alias("stockout_rate"))


def dash_store_monthly(df: DataFrame, store_id: int | Column) -> DataFrame:
    return dash_monthly_sales(filter_store(df, store_id))


def dash_store_top_products(df: DataFrame, store_id: int | Column, n: int = 10) -> DataFrame:
    return dash_top_products(filter_store(df, store_id), n)


def dash_store_stockout_by_product(df: DataFrame, store_id: int | Column) -> DataFrame:
    return (filter_store(df, store_id).groupBy("family")
            .agg(row_count(df).alias("total"), F.sum("is_zero_sale").alias("stockouts"))
            .withColumn("rate", round_scaled(F.col("stockouts") / F.col("total") * 100, 1))
            .orderBy(F.desc("rate"), "family"))


def dash_store_alerts(alerts: DataFrame, store_id: int | Column) -> DataFrame:
    return filter_store(alerts, store_id)
