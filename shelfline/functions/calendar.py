"""Date parts and season flags as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _flag(condition: Column) -> Column:
    return condition.cast("int")


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_parts(day: Column) -> dict[str, Column]:
    """Ten calendar columns; Monday is 0 and weeks are ISO weeks."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day_of_week": F.weekday(day),
        "day_of_month": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "quarter": F.quarter(day),
        "day_of_year": F.dayofyear(day),
        "is_weekend": _flag(F.weekday(day) >= 5),
        "is_month_start": _flag(F.dayofmonth(day) == 1),
        "is_month_end": _flag(F.last_day(day) == day),
    }


def season_parts(day: Column) -> dict[str, Column]:
    """Eight season flags on fixed months and days of the month."""
    month, dom = F.month(day), F.dayofmonth(day)
    return {
        "is_ramadan_period": _flag(month.isin(3, 4)),
        "is_eid_preparation": _flag(month.isin(4, 6) & (dom >= 15)),
        "is_summer_peak": _flag(month.between(5, 8)),
        "is_wedding_season": _flag(month.isin(11, 12, 1, 2)),
        "is_school_season": _flag(month.isin(3, 8, 9)),
        "is_payday_week": _flag(dom <= 7),
        "is_friday": _flag(F.weekday(day) == 4),
        "is_end_of_month": _flag(dom >= 25),
    }
