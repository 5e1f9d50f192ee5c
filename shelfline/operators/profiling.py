"""Profiles of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.operators.merging import join_sales_store_inner
from shelfline.plans.ordering import exact_quantile


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: type, nulls, and the table's row and column counts; one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type"),
                                 F.col(n).alias("null_count")) for n, t in df.dtypes])
    return counts.select(F.col("_rows").alias("row_count"), F.lit(len(df.columns)).alias("column_count"),
                         F.inline(entries))


def profile_sales(sales: DataFrame) -> DataFrame:
    """Counts and moments; the median comes from the bucketed exact quantile, not from one task."""
    median = exact_quantile(sales, "sales", 0.5).scalar()
    return sales.agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.countDistinct("date").alias("days"), F.countDistinct("store_nbr").alias("stores"),
        F.countDistinct("family").alias("families"), F.count(F.lit(1)).alias("row_count"),
        F.avg("sales").alias("mean_sales"), F.min("sales").alias("min_sales"), F.max("sales").alias("max_sales"),
        F.stddev_samp("sales").alias("std_sales")).withColumn("median_sales", median)


def zero_negative_profile(sales: DataFrame) -> DataFrame:
    zero = (F.col("sales") == 0).cast("int")
    return sales.agg(F.sum(zero).alias("zero_rows"), (F.avg(zero) * 100).alias("zero_pct"),
                     F.count_if(F.col("sales") != 0).alias("non_zero_rows"),
                     F.count_if(F.col("sales") < 0).alias("negative_rows"))


def family_stats(sales: DataFrame) -> DataFrame:
    return sales.groupBy("family").agg(
        F.sum("sales").alias("total_sales"), F.avg("sales").alias("avg_daily"),
        F.count_if(F.col("sales") == 0).alias("zero_days")).orderBy(F.desc("total_sales"), "family")


def promotion_summary(sales: DataFrame) -> DataFrame:
    with_promo = F.avg(F.when(F.col("onpromotion") > 0, F.col("sales")))
    without = F.avg(F.when(F.col("onpromotion") == 0, F.col("sales")))
    row = sales.agg(F.sum("onpromotion").alias("promo_total"),
                    (F.avg("onpromotion") * 100).alias("promo_pct"),
                    with_promo.alias("avg_with_promo"), without.alias("avg_without_promo"))
    lift = F.when(F.col("avg_without_promo") > 0,
                  (F.col("avg_with_promo") - F.col("avg_without_promo")) / F.col("avg_without_promo") * 100)
    return row.withColumn("promo_lift_pct", lift.otherwise(0.0))


def promo_flag_means(sales: DataFrame) -> DataFrame:
    return sales.groupBy((F.col("onpromotion") > 0).alias("on_promotion")).agg(F.avg("sales").alias("avg_sales"))


def store_value_counts(stores: DataFrame) -> DataFrame:
    """Stores per type, city, state and cluster in long form, in one pass over the table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"))
                                for c in ("type", "city", "state", "cluster")]))
    return (stores.select(pairs.alias("p")).groupBy("p.attribute", "p.value")
            .agg(F.count(F.lit(1)).alias("stores")))


def holiday_profile(holidays: DataFrame) -> DataFrame:
    """Events, days and transferred count per type, with a total row."""
    return (holidays.select(F.explode(F.array(F.col("type"), F.lit("(all)"))).alias("type"), "date", "transferred")
            .groupBy("type").agg(F.count(F.lit(1)).alias("events"), F.min("date").alias("first_date"),
                                 F.max("date").alias("last_date"), F.count_if("transferred").alias("transferred")))


def oil_profile(oil: DataFrame) -> DataFrame:
    missing = F.col("dcoilwtico").isNull().cast("int")
    return oil.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"),
                   F.count(F.lit(1)).alias("days"), F.sum(missing).alias("null_prices"),
                   (F.avg(missing) * 100).alias("null_pct"), F.min("dcoilwtico").alias("min_price"),
                   F.max("dcoilwtico").alias("max_price"), F.avg("dcoilwtico").alias("avg_price"))


def cpi_profile(cpi: DataFrame) -> DataFrame:
    """Rows, years, cities and items, with the sorted lists of years and cities; rows are grouped once, by all three."""
    groups = cpi.groupBy("year", "city", "item_name").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.sum("n").alias("row_count"), F.collect_set("year").alias("_y"), F.collect_set("city").alias("_c"),
                      F.countDistinct("item_name").alias("items")).select(
        F.coalesce("row_count", F.lit(0)).alias("row_count"), F.size("_y").cast("long").alias("years"),
        F.size("_c").cast("long").alias("cities"), "items",
        F.array_join(F.array_sort("_y").cast("array<string>"), ",").alias("year_list"),
        F.array_join(F.array_sort("_c"), ",").alias("city_list"))


def preview_events(holidays: DataFrame, n: int = 10) -> DataFrame:
    return holidays.orderBy("date", "type", "description").limit(n)


def preview_items(cpi: DataFrame, n: int = 20) -> DataFrame:
    return cpi.select("item_name").distinct().orderBy("item_name").limit(n)


def cpi_city_mean(cpi: DataFrame, city: str) -> DataFrame:
    return cpi.where(F.col("city") == city).agg(F.count(F.lit(1)).alias("row_count"),
                                                F.avg("city_price").alias("avg_price"))


def cpi_item_monthly(cpi: DataFrame, text: str, city: str | None = None) -> DataFrame:
    rows = cpi if city is None else cpi.where(F.col("city") == city)
    label = F.concat(F.col("year").cast("string"), F.lit("-"), F.lpad(F.col("month").cast("string"), 2, "0"))
    return (rows.where(F.contains(F.lower("item_name"), F.lit(text.lower())))
            .groupBy("year", "month").agg(F.avg("city_price").alias("avg_price")).withColumn("date_str", label)
            .orderBy("year", "month"))


def daily_sales_total(sales: DataFrame) -> DataFrame:
    return sales.groupBy("date").agg(F.sum("sales").alias("total_sales"))


def sales_by_month(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.month("date").alias("month")).agg(F.avg("sales").alias("avg_sales"))


def sales_by_dow(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.weekday("date").alias("dow")).agg(F.avg("sales").alias("avg_sales"))


def sales_by_store_type(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return (join_sales_store_inner(sales, stores).groupBy("type").agg(F.avg("sales").alias("avg_sales"))
            .orderBy("avg_sales", "type"))


def sales_by_year(sales: DataFrame) -> DataFrame:
    return sales.groupBy(F.year("date").alias("year")).agg(F.sum("sales").alias("total_sales"))


def zero_days_by_family(sales: DataFrame, n: int = 15) -> DataFrame:
    return (sales.where(F.col("sales") == 0).groupBy("family").agg(F.count(F.lit(1)).alias("zero_days"))
            .orderBy(F.desc("zero_days"), "family").limit(n))


def top_families(sales: DataFrame, n: int = 15, best: bool = True) -> DataFrame:
    totals = sales.groupBy("family").agg(F.sum("sales").alias("total_sales"))
    order = F.desc("total_sales") if best else F.asc("total_sales")
    return totals.orderBy(order, "family").limit(n)


def null_summary(df: DataFrame) -> DataFrame:
    return profile_table(df).where(F.col("null_count") > 0).select("column_name", "null_count")
