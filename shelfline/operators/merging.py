"""Joins that turn the clean sources into one panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.operators.cleaning import fill_forward_backward, fill_numeric_nulls
from shelfline.plans.sizing import broadcast_bounded, join_dim
from shelfline.sources.calendar import holiday_flags


def join_store_attrs(sales: DataFrame, stores: DataFrame) -> DataFrame:
    attrs = stores.select("store_nbr", "city", "state", "type", "cluster", "store_size")
    return join_dim(sales, attrs, "store_nbr", "left", bound=stores)


def join_holiday_flags(df: DataFrame, holidays: DataFrame) -> DataFrame:
    flags = broadcast_bounded(holiday_flags(holidays))
    return df.join(flags, "date", "left").fillna(0, ["is_holiday", "is_national_holiday"])


def daily_prices(oil: DataFrame) -> DataFrame:
    """Price for every day between the first and the last trading day, gaps filled."""
    span = oil.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))
    per_day = oil.groupBy("date").agg(F.max("dcoilwtico").alias("dcoilwtico"))
    return fill_forward_backward(days.join(per_day, "date", "left"), "dcoilwtico")


def join_oil_asof(df: DataFrame, oil: DataFrame, out: str = "dcoilwtico") -> DataFrame:
    """Last known price on each day, the first one before trading began.

    Days outside the price table are moved to its nearest end, which makes the as-of join an equi-join
    with a day table and needs no pass over the panel.
    """
    span = oil.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    first, last = span.select("a").scalar(), span.select("b").scalar()
    prices = daily_prices(oil).select(F.col("date").alias("_price_day"), F.col("dcoilwtico").alias(out))
    return (df.withColumn("_price_day", F.least(F.greatest("date", first), last))
            .join(broadcast_bounded(prices), "_price_day", "left").drop("_price_day"))


def merge_all(sales: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame) -> DataFrame:
    merged = join_oil_asof(join_holiday_flags(join_store_attrs(sales, stores), holidays), oil, "oil_price")
    return fill_numeric_nulls(merged.withColumnsRenamed({"store_nbr": "store_id", "type": "store_type"}))


def join_sales_store_inner(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return join_dim(sales, stores.select("store_nbr", "type"), "store_nbr", "inner", bound=stores)


def semi_join_in(df: DataFrame, keys: DataFrame, on: str | list[str], bounded: bool = False) -> DataFrame:
    """Rows whose key occurs in another frame; ``bounded`` says it has at most one row per calendar day."""
    return df.join(broadcast_bounded(keys) if bounded else keys, on, "left_semi")
