"""Features of new days from a small state per series, without the history.

The state holds, for each series, its last ``DEPTH`` values, its zero streak, and the sum and number of its rows. New days are
put behind the values, the same windows run over both, and the rows of the new days are kept: the same rows that a run over the
whole history would give for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfline.operators.cleaning import fill_numeric_nulls
from shelfline.operators.features import (SERIES, calendar_features, family_ranks, group_means, history_features, is_zero_sale, sales_vs_store_avg,
                                          season_flags, zero_sales_last_7d)
from shelfline.plans.sizing import join_dim
from shelfline.plans.staging import Stage, lazy

#: rows before a day that the longest window looks at, the day itself left out
DEPTH = 30


def series_state(featured: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per series: ``recent`` (its last values, oldest first), last_day, streak, and the sums _sum and _n.

    ``featured`` has sales and consecutive_zeros for each day. Only the last rows of a series are moved, and its sums.
    """
    newest = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("date")))
    last = (featured.select(*SERIES, "date", F.col("sales").cast("double").alias("sales")).withColumn("_k", newest).where(F.col("_k") <= depth)
            .groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("date", "sales"))).alias("_r")))
    sums = featured.groupBy(*SERIES).agg(
        F.max("date").alias("last_day"), F.max_by("consecutive_zeros", "date").cast("int").alias("streak"),
        F.sum(F.col("sales").cast("double")).alias("_sum"), F.count("sales").alias("_n"))
    return sums.join(last, SERIES).select(*SERIES, F.col("_r.sales").alias("recent"), "last_day", "streak", "_sum", "_n")


def _behind(state: DataFrame, days: DataFrame) -> DataFrame:
    """The new days behind the values of their series, told apart by ``_new``; the values stand on the days before, one a day."""
    before = (state.join(days.select(*SERIES).distinct(), SERIES, "left_semi")
              .select(*SERIES, "last_day", F.size("recent").alias("_size"), F.posexplode("recent").alias("_k", "sales"))
              .select(*SERIES, F.date_sub("last_day", F.col("_size") - 1 - F.col("_k")).alias("date"), "sales", F.lit(0).alias("_new")))
    new = days.withColumns({"sales": F.col("sales").cast("double"), "_new": F.lit(1)}).join(state.select(*SERIES, "streak"), SERIES, "left")
    return new.unionByName(before, allowMissingColumns=True)


def _streaks(rows: DataFrame) -> DataFrame:
    """Zero streak of the new days: to the last new day that sold, or on from the streak of the state."""
    so_far = Window.partitionBy(*SERIES).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    place = F.sum("_new").over(so_far)
    rows = rows.withColumn("_pos", place)
    sold = F.max(F.when((F.col("_new") == 1) & (F.col("is_zero_sale") == 0), F.col("_pos"))).over(so_far)
    return (rows.withColumn("_sold", sold)
            .withColumn("consecutive_zeros", (F.col("_pos") - F.coalesce("_sold", -F.coalesce("streak", F.lit(0)))).cast("int")).drop("_pos", "_sold"))


def advance_sums(state: DataFrame, days: DataFrame) -> DataFrame:
    """Sums and rows of every series with the new days."""
    new = days.groupBy(*SERIES).agg(F.sum(F.col("sales").cast("double")).alias("_sum"), F.count("sales").alias("_n"))
    return state.select(*SERIES, "_sum", "_n").unionByName(new).groupBy(*SERIES).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"))


def new_day_features(state: DataFrame, days: DataFrame, exclude_current: bool = False, stage: Stage = lazy) -> DataFrame:
    """The columns of ``features.build_features`` for merged rows of days after the state's.

    A series that the state lacks begins with these days. The means and ranks are those of the history and the new days together.
    """
    rows = zero_sales_last_7d(is_zero_sale(history_features(_behind(state, days), exclude_current)))
    rows = _streaks(rows).where(F.col("_new") == 1).drop("_new", "streak")
    sums = stage(advance_sums(state, days), "series_sums")
    own = sums.select(*SERIES, (F.col("_sum") / F.col("_n")).alias("store_product_avg"))
    rows = rows.join(own, SERIES)
    rows = join_dim(rows, group_means(sums, "store_id", "store_avg_daily_sales").drop("_total"), "store_id", "left", bound=sums)
    rows = sales_vs_store_avg(join_dim(rows, family_ranks(sums), "family", "left", bound=sums))
    return fill_numeric_nulls(season_flags(calendar_features(rows)))


def advance_state(state: DataFrame, featured: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The state with the features of new days put in; series without new days stay as they are."""
    new = featured.groupBy(*SERIES).agg(
        F.sort_array(F.collect_list(F.struct("date", F.col("sales").cast("double").alias("sales")))).alias("_r"), F.max("date").alias("_day"),
        F.max_by("consecutive_zeros", "date").cast("int").alias("_streak"), F.sum(F.col("sales").cast("double")).alias("_s"), F.count("sales").alias("_c"))
    none = F.array().cast("array<double>")
    both = F.concat(F.coalesce("recent", none), F.coalesce(F.col("_r.sales"), none))
    first = F.greatest(F.size(both) - depth, F.lit(0)) + 1
    return state.join(new, SERIES, "full").select(
        *SERIES, F.slice(both, first, F.lit(depth)).alias("recent"), F.coalesce("_day", "last_day").alias("last_day"),
        F.coalesce("_streak", "streak").alias("streak"), (F.coalesce("_sum", F.lit(0.0)) + F.coalesce("_s", F.lit(0.0))).alias("_sum"),
        (F.coalesce("_n", F.lit(0)) + F.coalesce("_c", F.lit(0))).alias("_n"))
