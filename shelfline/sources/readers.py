"""Table readers: explicit schemas, CSV by default, Parquet as an option."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfline import schemas


def _read(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True) if fmt == "csv" else reader.format(fmt).load(path)


def read_sales(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.SALES, fmt)


def read_stores(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.STORES, fmt)


def read_holidays(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.HOLIDAYS, fmt)


def read_oil(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, schemas.OIL, fmt)


def read_cpi(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Price table; an absent file gives an empty frame, as the input is optional."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.CPI)
    return _read(spark, path, schemas.CPI, fmt)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_first_available(spark: SparkSession, paths: list[str], fmt: str = "parquet",
                         schema: StructType | None = None) -> DataFrame | None:
    """Frame of the first path that exists, or None."""
    for path in paths:
        if path_exists(spark, path):
            reader = spark.read if schema is None else spark.read.schema(schema)
            return reader.csv(path, header=True, inferSchema=schema is None) if fmt == "csv" \
                else reader.format(fmt).load(path)
    return None


# The columns the star query hands to the model, by alias of the table that holds them.
STAR_COLUMNS = {
    "d": ["year", "quarter", "month", "month_name", "week_of_year", "day_of_month", "day_of_week", "day_name",
          "day_of_year", *schemas.CALENDAR_FLAGS, *schemas.SEASON_FLAGS, *schemas.HOLIDAY_FLAGS],
    "s": ["store_id", "city", "state", "store_type", "store_size", "cluster"],
    "p": ["family", "category", "subcategory", "is_fmcg", "is_perishable"],
    "f": ["sales", "onpromotion", "onpromotion_count", "sales_lag_7d", "sales_lag_14d", "sales_lag_28d",
          "sales_rolling_mean_7d", "sales_rolling_mean_14d", "sales_rolling_mean_30d", "sales_rolling_std_7d",
          "sales_rolling_std_14d", "sales_trend_7d", "is_zero_sale", "zero_sales_last_7d", "consecutive_zeros",
          "store_avg_daily_sales", "family_avg_sales", "store_product_avg", "oil_price"],
}


def star_query() -> str:
    """The star join as SQL text for a database that holds the warehouse tables."""
    columns = ["f.date_key", "d.full_date AS date"] + [f"{a}.{c}" for a, cs in STAR_COLUMNS.items() for c in cs]
    return ("SELECT " + ", ".join(columns) + " FROM fact_daily_sales f"
            " JOIN dim_date d ON f.date_key = d.date_key"
            " JOIN dim_store s ON f.store_key = s.store_key"
            " JOIN dim_product p ON f.product_key = p.product_key")


def jdbc_options(url: str, lower: int, upper: int, partitions: int, **extra: str) -> dict[str, str]:
    """Options for a read split on date_key, so that many tasks fetch ranges of it at once."""
    return {"url": url, "dbtable": f"({star_query()}) q", "partitionColumn": "date_key",
            "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions),
            "fetchsize": "10000", **extra}


def read_star_jdbc(spark: SparkSession, url: str, lower: int, upper: int, partitions: int = 64,
                   **extra: str) -> DataFrame:
    return (spark.read.format("jdbc").options(**jdbc_options(url, lower, upper, partitions, **extra))
            .load().drop("date_key"))
