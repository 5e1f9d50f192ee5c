"""Model features on the panel.

Everything per series shares one window definition, so one exchange and one sort serve all of them.
Windows count rows, not days; a dense panel makes the two equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.calendar import date_key, date_parts, season_parts
from shelfline.operators.cleaning import fill_numeric_nulls
from shelfline.plans.ordering import with_rank
from shelfline.plans.sizing import join_dim
from shelfline.plans.staging import Stage, lazy

SERIES = ["store_id", "family"]


def _series() -> "Window":
    return Window.partitionBy(*SERIES).orderBy("date")


def _last(rows: int, exclude_current: bool = False) -> "Window":
    return _series().rowsBetween(-rows, -1) if exclude_current else _series().rowsBetween(-(rows - 1), 0)


def calendar_features(df: DataFrame) -> DataFrame:
    return df.withColumns(date_parts(F.col("date")))


def season_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(season_parts(F.col("date")))


def add_date_key(df: DataFrame) -> DataFrame:
    return df.withColumn("date_key", date_key(F.col("date")))


def is_zero_sale(df: DataFrame) -> DataFrame:
    return df.withColumn("is_zero_sale", (F.col("sales") == 0).cast("int"))


def lag_columns(steps: tuple = (7, 14, 28)) -> dict[str, Column]:
    return {f"sales_lag_{n}d": F.lag("sales", n).over(_series()) for n in steps}


def mean_columns(sizes: tuple = (7, 14, 30), exclude_current: bool = False) -> dict[str, Column]:
    return {f"sales_rolling_mean_{n}d": F.avg("sales").over(_last(n, exclude_current)) for n in sizes}


def std_columns(sizes: tuple = (7, 14), exclude_current: bool = False) -> dict[str, Column]:
    return {f"sales_rolling_std_{n}d":
            F.coalesce(F.stddev_samp("sales").over(_last(n, exclude_current)), F.lit(0.0)) for n in sizes}


def range_columns(size: int = 7, exclude_current: bool = False) -> dict[str, Column]:
    frame = _last(size, exclude_current)
    return {f"sales_rolling_max_{size}d": F.max("sales").over(frame),
            f"sales_rolling_min_{size}d": F.min("sales").over(frame)}


def trend_column(exclude_current: bool = False) -> dict[str, Column]:
    return {"sales_trend_7d": F.avg("sales").over(_last(7, exclude_current))
            - F.avg("sales").over(_last(30, exclude_current))}


def lag_features(df: DataFrame) -> DataFrame:
    return df.withColumns(lag_columns())


def rolling_mean(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    return df.withColumns(mean_columns(exclude_current=exclude_current))


def rolling_std(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    return df.withColumns(std_columns(exclude_current=exclude_current))


def rolling_max_min(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    return df.withColumns(range_columns(exclude_current=exclude_current))


def sales_trend(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    return df.withColumns(trend_column(exclude_current))


def history_features(df: DataFrame, exclude_current: bool = False) -> DataFrame:
    """All lag and rolling columns. With ``exclude_current`` the target day stays out of its own windows.

    The trend reuses the two means instead of sliding over the rows again.
    """
    windows = df.withColumns({**lag_columns(), **mean_columns(exclude_current=exclude_current),
                              **std_columns(exclude_current=exclude_current),
                              **range_columns(exclude_current=exclude_current)})
    return windows.withColumn("sales_trend_7d", F.col("sales_rolling_mean_7d") - F.col("sales_rolling_mean_30d"))


def zero_sales_last_7d(df: DataFrame) -> DataFrame:
    return df.withColumn("zero_sales_last_7d", F.sum("is_zero_sale").over(_last(7)).cast("int"))


def consecutive_zeros(df: DataFrame) -> DataFrame:
    """Length of the zero streak up to each day: distance to the last day that sold."""
    position = F.row_number().over(_series())
    so_far = _series().rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("_pos", position)
            .withColumn("_sold", F.max(F.when(F.col("is_zero_sale") == 0, F.col("_pos"))).over(so_far))
            .withColumn("consecutive_zeros", F.col("_pos") - F.coalesce("_sold", F.lit(0)))
            .drop("_pos", "_sold"))


def stockout_features(df: DataFrame) -> DataFrame:
    return consecutive_zeros(zero_sales_last_7d(is_zero_sale(df)))


def series_sums(df: DataFrame) -> DataFrame:
    return df.groupBy(*SERIES).agg(F.sum("sales").alias("_sum"), F.count("sales").alias("_n"))


def group_means(sums: DataFrame, key: str, out: str) -> DataFrame:
    """Mean of sales per key from the sums per series, so a hot key moves few rows."""
    return sums.groupBy(key).agg((F.sum("_sum") / F.sum("_n")).alias(out), F.sum("_sum").alias("_total"))


def store_avg_daily_sales(df: DataFrame, stage: Stage = lazy) -> DataFrame:
    sums = stage(series_sums(df), "series_sums")
    means = group_means(sums, "store_id", "store_avg_daily_sales").drop("_total")
    return join_dim(df, means, "store_id", "left", bound=sums)


def family_avg_sales(df: DataFrame, stage: Stage = lazy) -> DataFrame:
    sums = stage(series_sums(df), "series_sums")
    return join_dim(df, group_means(sums, "family", "family_avg_sales").drop("_total"), "family", "left", bound=sums)


def store_product_avg(df: DataFrame) -> DataFrame:
    return df.withColumn("store_product_avg", F.avg("sales").over(Window.partitionBy(*SERIES)))


def sales_vs_store_avg(df: DataFrame) -> DataFrame:
    base = F.when(F.col("store_avg_daily_sales") == 0, 1.0).otherwise(F.col("store_avg_daily_sales"))
    return df.withColumn("sales_vs_store_avg", F.col("sales") / base)


def family_ranks(sums: DataFrame, out: str = "family_popularity_rank") -> DataFrame:
    """Family, mean sales and average rank of its total, largest first, from the sums per series."""
    totals = group_means(sums, "family", "family_avg_sales")
    return with_rank(totals, "_total", out, method="average", bound=sums).drop("_total")


def family_popularity_rank(df: DataFrame, stage: Stage = lazy) -> DataFrame:
    sums = stage(series_sums(df), "series_sums")
    return join_dim(df, family_ranks(sums).drop("family_avg_sales"), "family", "left", bound=sums)


def join_back_aggregates(df: DataFrame, stage: Stage = lazy) -> DataFrame:
    """Store, family and series means, the family rank, and sales against the store mean.

    One table of sums per series serves all of them. Its size bounds the groups of the panel, whatever the dimensions
    hold, so it decides what may be broadcast.
    """
    sums = stage(series_sums(df), "series_sums")
    means = group_means(sums, "store_id", "store_avg_daily_sales").drop("_total")
    out = join_dim(store_product_avg(df), means, "store_id", "left", bound=sums)
    return sales_vs_store_avg(join_dim(out, family_ranks(sums), "family", "left", bound=sums))


def build_features(merged: DataFrame, exclude_current: bool = False, stage: Stage = lazy) -> DataFrame:
    """Calendar, history, season, aggregate and stock-out columns; numeric nulls become 0."""
    joined = join_back_aggregates(merged, stage)
    df = stockout_features(history_features(joined, exclude_current))
    return fill_numeric_nulls(season_flags(calendar_features(df)))


def panel_verification(df: DataFrame) -> DataFrame:
    """Date range, stores, families and zero days; stores and families are counted over one row per series, not by expanding all rows."""
    series = df.groupBy("store_id", "family").agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.count_if(F.col("sales") == 0).alias("zero_sales"), F.count("sales").alias("_days"))
    return series.agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
                      F.countDistinct("store_id").alias("stores"), F.countDistinct("family").alias("families"),
                      F.coalesce(F.sum("zero_sales"), F.lit(0)).alias("zero_sales"),
                      (F.try_divide(F.sum("zero_sales"), F.sum("_days")) * 100).alias("zero_share"))
