"""The ten analytical questions on the star schema. Results are numbers; see ``format_report`` for text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.plans.ordering import with_rank
from shelfline.plans.sizing import broadcast_bounded, join_dim


def _sales() -> Column:
    return F.col("sales").cast("double")


def _total(name: str = "total_sales") -> Column:
    return F.sum(_sales()).alias(name)


def _mean(name: str = "avg_sales") -> Column:
    return F.avg(_sales()).alias(name)


def _zero_rate() -> Column:
    return (F.avg("is_zero_sale") * 100).alias("stockout_rate")


def _by_day(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return fact.join(broadcast_bounded(dim_date), "date_key")


def q01_top_products(fact: DataFrame, dim_product: DataFrame, n: int = 10) -> DataFrame:
    """Aggregate on the key first: the join then touches one row per product."""
    sums = fact.groupBy("product_key").agg(_total("total_revenue"), _mean("avg_daily_sales"))
    names = dim_product.select("product_key", "family", "category")
    return (sums.join(names, "product_key").select("family", "category", "total_revenue", "avg_daily_sales")
            .orderBy(F.desc("total_revenue"), "family").limit(n))


def q02_monthly_season(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", "month", "month_name")
    return _by_day(fact, days).groupBy("month", "month_name").agg(_mean(), _zero_rate()).orderBy("month")


def q03_ramadan_impact(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    label = F.when(F.col("is_ramadan_period") == 1, "Ramadan").otherwise("Normal").alias("period")
    days = dim_date.select("date_key", "is_ramadan_period")
    return (_by_day(fact, days).groupBy("is_ramadan_period").agg(_mean(), _total(), _zero_rate())
            .orderBy(F.desc("is_ramadan_period")).select(label, "avg_sales", "total_sales", "stockout_rate"))


def _fmcg_only(df: DataFrame, dim_product: DataFrame) -> DataFrame:
    names = dim_product.where(F.col("is_fmcg") == 1).select("product_key", "family", "category")
    return join_dim(df, names, "product_key", bound=dim_product)


def fmcg_zero_rates(fact: DataFrame, dim_product: DataFrame, over: float = 0.3) -> DataFrame:
    """Store and fast-moving family with a zero share above a limit."""
    sums = fact.groupBy("store_key", "product_key").agg(
        F.count(F.lit(1)).alias("total_days"), F.sum("is_zero_sale").alias("zero_sale_days"))
    rate = F.col("zero_sale_days") / F.col("total_days")
    return (_fmcg_only(sums, dim_product).where(rate > over).withColumn("stockout_rate", rate * 100))


def q04_stockout_hotspots(fact: DataFrame, dim_store: DataFrame, dim_product: DataFrame, n: int = 20,
                          stores: DataFrame | None = None) -> DataFrame:
    places = dim_store.select("store_key", "store_id", "city", "store_type")
    return (join_dim(fmcg_zero_rates(fact, dim_product), places, "store_key", bound=stores)
            .select("store_id", "city", "store_type", "family", "total_days", "zero_sale_days", "stockout_rate")
            .orderBy(F.desc("zero_sale_days"), "store_id", "family").limit(n))


def store_totals(fact: DataFrame) -> DataFrame:
    sums = fact.groupBy("store_key", "product_key").agg(F.sum(_sales()).alias("s"), F.count("sales").alias("n"))
    return sums.groupBy("store_key").agg(F.sum("s").alias("total_revenue"),
                                         (F.sum("s") / F.sum("n")).alias("avg_daily_sales"))


def store_revenue_rank(fact: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    return with_rank(store_totals(fact), "total_revenue", "revenue_rank", bound=stores)


def q05_store_ranking(fact: DataFrame, dim_store: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    places = dim_store.select("store_key", "store_id", "city", "store_type", "store_size")
    return (join_dim(store_revenue_rank(fact, stores), places, "store_key", bound=stores)
            .select("store_id", "city", "store_type", "store_size", "total_revenue", "avg_daily_sales",
                    "revenue_rank").orderBy(F.desc("total_revenue"), "store_id"))


def q06_weekend_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    label = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday").alias("day_type")
    return (_by_day(fact, dim_date.select("date_key", "is_weekend")).groupBy("is_weekend").agg(_mean(), _total())
            .orderBy("is_weekend").select(label, "avg_sales", "total_sales"))


def promo_means(df: DataFrame, *keys: str) -> DataFrame:
    """Mean with and without promotion as conditional aggregates in one pass."""
    return df.groupBy(*keys).agg(
        F.avg(F.when(F.col("onpromotion") == 1, _sales())).alias("avg_with_promo"),
        F.avg(F.when(F.col("onpromotion") == 0, _sales())).alias("avg_without_promo"))


def q07_promotion_lift(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    means = promo_means(fact, "product_key").where(F.col("avg_with_promo").isNotNull())
    lift = F.try_divide(F.col("avg_with_promo") - F.col("avg_without_promo"), "avg_without_promo") * 100
    return (means.join(dim_product.select("product_key", "family", "category"), "product_key")
            .select("family", "category", "avg_with_promo", "avg_without_promo", lift.alias("promotion_lift"))
            .orderBy(F.desc("promotion_lift"), "family"))


def yearly_sales(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per day first (at most one row per calendar day), then per year: no distinct count over the fact."""
    daily = fact.groupBy("date_key").agg(F.sum(_sales()).alias("s"), F.count("sales").alias("n"))
    return (daily.join(broadcast_bounded(dim_date.select("date_key", "year")), "date_key").groupBy("year")
            .agg(F.sum("s").alias("total_sales"), (F.sum("s") / F.sum("n")).alias("avg_daily_sales"),
                 F.count(F.lit(1)).alias("active_days")))


def yoy_growth(yearly: DataFrame) -> DataFrame:
    """Growth against the year before (one row per year, one task)."""
    previous = F.lag("total_sales").over(Window.partitionBy().orderBy("year"))
    return yearly.withColumn("yoy_growth", F.try_divide(F.col("total_sales") - previous, previous) * 100)


def q08_yoy_growth(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return yoy_growth(yearly_sales(fact, dim_date)).orderBy("year")


def period_label() -> Column:
    return (F.when(F.col("is_payday_week") == 1, "Payday Week (1-7)")
            .when(F.col("is_end_of_month") == 1, "End of Month (25-31)").otherwise("Mid Month (8-24)"))


def q09_payday_effect(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    days = dim_date.select("date_key", period_label().alias("period"))
    return _by_day(fact, days).groupBy("period").agg(_mean(), _total()).orderBy(F.desc("avg_sales"), "period")


def newest_year(fact: DataFrame) -> DataFrame:
    """The fact's newest year; where years are folders, the scans read that folder alone, and no column to find it."""
    return fact.where(F.col("fact_year") == fact.agg(F.max("fact_year")).scalar()) if "fact_year" in fact.columns else fact


def latest_fact_day(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row: the newest day that the fact holds, from its newest year. Only the distinct keys of the fact are moved."""
    fact = newest_year(fact)
    held = dim_date.join(broadcast_bounded(fact.select("date_key").distinct()), "date_key", "left_semi")
    return held.agg(F.max("full_date").alias("day"), F.max_by("date_key", "full_date").alias("date_key"))


def latest_fact_date_filter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The fact's rows of that day; year and key are runtime values that the scan can filter on."""
    newest = latest_fact_day(fact, dim_date)
    return (newest_year(fact).where(F.col("date_key") == newest.select("date_key").scalar())
            .withColumn("full_date", newest.select("day").scalar()))


def q10_reorder_alerts(fact: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_product: DataFrame,
                       n: int = 30, stores: DataFrame | None = None, min_zeros: int = 3,
                       min_demand: float = 10) -> DataFrame:
    demand = F.col("sales_rolling_mean_7d").cast("double")
    due = latest_fact_date_filter(fact, dim_date).where(
        (F.col("consecutive_zeros") >= min_zeros) & (F.col("sales_rolling_mean_7d") > min_demand))
    places = dim_store.select("store_key", "store_id", "city")
    return (join_dim(_fmcg_only(due, dim_product), places, "store_key", bound=stores)
            .select("store_id", "city", "family", "category", F.col("consecutive_zeros").alias("days_without_sale"),
                    demand.alias("normal_daily_demand"), (demand * 7).alias("suggested_order_qty"),
                    F.lit("REORDER NOW").alias("alert_status"))
            .orderBy(F.desc("normal_daily_demand"), "store_id", "family").limit(n))


def format_report(df: DataFrame, decimals: dict[str, int], percent: tuple = ()) -> DataFrame:
    """Numbers as grouped text, e.g. 1,234.50; percent columns end in a percent sign."""
    texts = {c: F.format_number(c, d) for c, d in decimals.items()}
    return df.withColumns({c: F.concat(t, F.lit("%")) if c in percent else t for c, t in texts.items()})
