"""Additive sums of the panel that many reports share.

One pass gives the sums of every series by month, and by weekday. Sums keep the panel's names (``sales``, ``is_zero_sale``,
``onpromotion``), ``_rows`` is the number of rows behind them and ``_sold`` of those that sold. A report that asks for sums, counts and
means reads the panel or these sums alike (``stockout.row_count``, ``stockout.mean_of``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.calendar import year_month
from shelfline.functions.lookups import SEASON_LABELS
from shelfline.operators.features import SERIES

ATTRIBUTES = ["city", "store_type", "category"]
SEASONS = list(SEASON_LABELS)


def panel_rollup(ready: DataFrame) -> DataFrame:
    """Sums by series and month (``part`` month), and by series and weekday (``part`` weekday), from one pass over the model-ready panel,
    whose sales, flags and zero marks are never null. The attributes of store and family are constant, so they add no groups.

    For each season flag there are the rows, sales and zeros of its days.
    """
    keys = [*SERIES, *ATTRIBUTES]
    rows = ready.select(*keys, "day_name", "month", year_month(F.col("date")).alias("year_month"), F.col("sales").cast("double").alias("sales"),
                        "is_zero_sale", "onpromotion", *SEASONS)
    sums = {"sales": F.sum("sales"), "is_zero_sale": F.sum("is_zero_sale"), "onpromotion": F.sum("onpromotion"), "_rows": F.count(F.lit(1)),
            "_sold": F.count_if(F.col("sales") > 0)}
    for flag in SEASONS:
        on = F.col(flag) == 1
        sums |= {f"{flag}_rows": F.count_if(on), f"{flag}_sales": F.sum(F.when(on, F.col("sales")).otherwise(0.0)),
                 f"{flag}_zeros": F.sum(F.when(on, F.col("is_zero_sale")).otherwise(0))}
    sets = [[F.col(k) for k in (*keys, "year_month", "month")], [F.col(k) for k in (*keys, "day_name")]]
    found = rows.groupingSets(sets, *keys, "year_month", "month", "day_name").agg(
        F.grouping("day_name").alias("_by_month"), *[column.alias(name) for name, column in sums.items()])
    return found.withColumn("part", F.when(F.col("_by_month") == 1, "month").otherwise("weekday")).drop("_by_month")


def by_month(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("part") == "month").drop("day_name")


def by_weekday(rollup: DataFrame) -> DataFrame:
    return rollup.where(F.col("part") == "weekday").drop("year_month", "month")
