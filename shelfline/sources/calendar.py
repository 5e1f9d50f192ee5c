"""Day tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions.calendar import date_key, date_parts, season_parts
from shelfline.plans.sizing import broadcast_bounded
from shelfline.schemas import DIM_DATE

# The published range of the day dimension.
FIRST_DAY, LAST_DAY = dt.date(2013, 1, 1), dt.date(2017, 12, 31)


def generate_calendar(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date = LAST_DAY) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def calendar_of(df: DataFrame, column: str = "date") -> DataFrame:
    """Every day of the calendar years a table touches."""
    span = df.agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return span.select(F.explode(F.sequence(
        F.trunc("a", "year"), F.last_day(F.add_months(F.trunc("b", "year"), 11)),
        F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def holiday_flags(holidays: DataFrame) -> DataFrame:
    """One row per date with an event, at most one per calendar day."""
    return holidays.groupBy("date").agg(F.lit(1).alias("is_holiday"),
                                        F.max("is_national").alias("is_national_holiday"))


def dim_date(calendar: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Day dimension. Holiday flags come from the events, 0 where no event table is given."""
    day = F.col("full_date")
    dated = calendar.select(
        date_key(day).alias("date_key"), day,
        *[c.alias(n) for n, c in {**date_parts(day), **season_parts(day)}.items()],
        F.date_format(day, "MMMM").alias("month_name"), F.date_format(day, "EEEE").alias("day_name"))
    if holidays is None:
        dated = dated.withColumns({"is_holiday": F.lit(0), "is_national_holiday": F.lit(0)})
    else:
        flags = holiday_flags(holidays).withColumnRenamed("date", "full_date")
        dated = dated.join(broadcast_bounded(flags), "full_date", "left").fillna(
            0, ["is_holiday", "is_national_holiday"])
    return dated.select(DIM_DATE.fieldNames())
