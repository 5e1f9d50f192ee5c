"""Fixed word lists and code tables, and a null-safe way to apply them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

# These must equal the published ones for results to agree.
SIZE_BY_STORE_TYPE = {"A": "Large", "B": "Medium-Large", "C": "Small", "D": "Medium", "E": "Medium-Small"}
CODE_BY_STORE_TYPE = {"A": 5, "B": 4, "C": 1, "D": 3, "E": 2}
CODE_BY_CATEGORY = {"FMCG": 3, "Fresh": 2, "Non-Food": 1}
STAPLE_FAMILY = "GROCERY I"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
ALERT_LEVELS = ["CRITICAL", "HIGH", "MEDIUM", "LOW"]
RISK_LEVELS = ["Low", "Medium", "High", "Critical"]
SEASON_LABELS = {
    "is_ramadan_period": "Ramadan Period",
    "is_wedding_season": "Wedding Season",
    "is_summer_peak": "Summer Peak",
    "is_payday_week": "Payday Week",
    "is_school_season": "School Season",
}
SEASON_WORDS = ["ramadan", "eid", "wedding", "payday", "friday", "summer", "school"]
MODEL_FEATURES = [
    "year", "month", "day_of_week", "day_of_month", "week_of_year", "quarter", "day_of_year",
    "is_weekend", "is_month_start", "is_month_end",
    "is_ramadan_period", "is_eid_preparation", "is_summer_peak", "is_wedding_season", "is_school_season",
    "is_payday_week", "is_friday", "is_end_of_month", "is_holiday", "is_national_holiday",
    "sales_lag_7d", "sales_lag_14d", "sales_lag_28d",
    "sales_rolling_mean_7d", "sales_rolling_mean_14d", "sales_rolling_mean_30d",
    "sales_rolling_std_7d", "sales_rolling_std_14d", "sales_trend_7d",
    "is_zero_sale", "zero_sales_last_7d", "consecutive_zeros",
    "store_type_encoded", "family_encoded", "category_encoded", "cluster",
    "store_avg_daily_sales", "family_avg_sales", "store_product_avg", "oil_price",
    "onpromotion", "onpromotion_count",
    "promo_weekend", "ramadan_fmcg", "wedding_grocery", "payday_spending",
    "is_fmcg", "is_perishable",
]


def lookup(key: Column, table: dict, default=None) -> Column:
    """Value of a small fixed table; unknown and null keys give the default."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))
