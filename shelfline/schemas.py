"""Table schemas, declared once, and helpers that make a frame conform to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, NumericType,
    StringType, StructField, StructType,
)

_I, _L, _D, _S, _DT, _B = IntegerType(), LongType(), DoubleType(), StringType(), DateType(), BooleanType()


def _table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


SALES = _table(date=_DT, store_nbr=_I, family=_S, sales=_D, onpromotion=_I)
STORES = _table(store_nbr=_I, city=_S, state=_S, type=_S, cluster=_I)
HOLIDAYS = _table(date=_S, type=_S, locale=_S, description=_S, transferred=_B)
OIL = _table(date=_DT, dcoilwtico=_D)
CPI = _table(date=_DT, year=_I, month=_I, item_id=_I, item_name=_S, national_avg_price=_D,
             pct_change=_D, city=_S, city_price=_D)
PRODUCT_SEED = _table(family=_S, category=_S, subcategory=_S, is_fmcg=_I, is_perishable=_I)
PREDICTIONS = _table(store_id=_I, family=_S, date=_DT, actual=_D, predicted=_D)

CALENDAR_FLAGS = ["is_weekend", "is_month_start", "is_month_end"]
SEASON_FLAGS = ["is_ramadan_period", "is_eid_preparation", "is_summer_peak", "is_wedding_season",
                "is_school_season", "is_payday_week", "is_friday", "is_end_of_month"]
HOLIDAY_FLAGS = ["is_holiday", "is_national_holiday"]

DIM_DATE = _table(date_key=_I, full_date=_DT, year=_I, quarter=_I, month=_I, month_name=_S,
                  week_of_year=_I, day_of_month=_I, day_of_week=_I, day_name=_S, day_of_year=_I,
                  **{flag: _I for flag in CALENDAR_FLAGS + SEASON_FLAGS + HOLIDAY_FLAGS})
DIM_STORE = _table(store_key=_I, store_id=_I, city=_S, state=_S, store_type=_S, store_size=_S, cluster=_I,
                   avg_daily_sales=DecimalType(12, 2), total_revenue=DecimalType(25, 2),
                   stockout_rate=DecimalType(5, 2))
DIM_PRODUCT = _table(product_key=_I, family=_S, category=_S, subcategory=_S, is_fmcg=_I, is_perishable=_I,
                     avg_daily_sales=DecimalType(12, 2), total_revenue=DecimalType(25, 2),
                     popularity_rank=_I, stockout_rate=DecimalType(5, 2))
DIM_ECONOMIC = _table(date_key=_I, full_date=_DT, oil_price=DecimalType(8, 2),
                      oil_price_7d_avg=DecimalType(8, 2), oil_price_change=DecimalType(8, 2))
DIM_CPI = _table(cpi_key=_L, date=_DT, year=_I, month=_I, item_id=_I, item_name=_S,
                 national_avg_price=DecimalType(10, 2), pct_change=DecimalType(6, 2), city=_S,
                 city_price=DecimalType(10, 2))

FACT_DECIMALS = ["sales", "sales_lag_7d", "sales_lag_14d", "sales_lag_28d", "sales_rolling_mean_7d",
                 "sales_rolling_mean_14d", "sales_rolling_mean_30d", "sales_rolling_std_7d",
                 "sales_rolling_std_14d", "sales_trend_7d", "store_avg_daily_sales", "family_avg_sales",
                 "store_product_avg", "oil_price"]
FACT_INTEGERS = ["onpromotion", "onpromotion_count", "is_zero_sale", "zero_sales_last_7d", "consecutive_zeros"]


def fact_decimal_type(column: str) -> str:
    return "decimal(8,2)" if column == "oil_price" else "decimal(12,2)"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Add each missing column as a typed default (0 for numbers, null otherwise)."""
    missing = [f for f in schema.fields if f.name not in df.columns]
    return df.withColumns({
        f.name: F.lit(0 if isinstance(f.dataType, NumericType) else None).cast(f.dataType) for f in missing
    }) if missing else df


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]
