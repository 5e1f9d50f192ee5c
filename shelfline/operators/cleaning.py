"""Row-level cleaning and the clean form of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import NumericType

from shelfline.functions.lookups import SIZE_BY_STORE_TYPE, lookup
from shelfline.functions.rounding import round_scaled
from shelfline.functions.text import contains_text, title_case
from shelfline.plans.ordering import exact_quantile
from shelfline.plans.sizing import broadcast_bounded
from shelfline.plans.staging import Stage, lazy
from shelfline.schemas import numeric_columns

CAP_QUANTILE, ANOMALY_QUANTILE = 0.995, 0.01


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedup_by_key(df: DataFrame, key: str = "store_nbr") -> DataFrame:
    """One row per key: the smallest by its other columns, so the choice never depends on row order."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min(F.struct(*others)).alias("r")).select(key, "r.*").select(df.columns)


def coerce_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Parse to DATE and drop rows that do not parse."""
    return df.withColumn(column, F.col(column).try_cast("date")).na.drop(subset=[column])


def promo_count_to_flag(df: DataFrame, column: str = "onpromotion") -> DataFrame:
    return df.withColumn(f"{column}_count", F.col(column)).withColumn(column, (F.col(column) > 0).cast("int"))


def clip_negative(df: DataFrame, column: str = "sales") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) < 0, F.lit(0)).otherwise(F.col(column)))


def cap_outliers_quantile(df: DataFrame, column: str = "sales", q: float = CAP_QUANTILE,
                          stage: Stage = lazy) -> DataFrame:
    """Cap at the exact quantile of the whole column."""
    limit = stage(exact_quantile(df, column, q), "sales_cap").scalar()
    return df.withColumn("_cap", limit).withColumn(
        column, F.when(F.col(column) > F.col("_cap"), F.col("_cap")).otherwise(F.col(column))).drop("_cap")


def daily_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("date").agg(F.sum("sales").alias("total"))


def anomaly_days(df: DataFrame, q: float = ANOMALY_QUANTILE) -> DataFrame:
    """Days whose total is under the q-quantile of the daily totals (one row per day, one task)."""
    limit = F.percentile("total", q).over(Window.partitionBy())
    return (daily_totals(df).withColumn("_limit", limit).where(F.col("total") < F.col("_limit"))
            .select("date", F.lit(1).alias("is_anomaly_day")))


def flag_anomaly_days(df: DataFrame, q: float = ANOMALY_QUANTILE, stage: Stage = lazy) -> DataFrame:
    days = stage(anomaly_days(df, q), "anomaly_days")
    return df.join(broadcast_bounded(days), "date", "left").fillna(0, ["is_anomaly_day"])


def standardise_text(df: DataFrame, upper: tuple = (), title: tuple = (), lower: tuple = (),
                     strip: tuple = ()) -> DataFrame:
    changes = {c: F.upper(F.trim(c)) for c in upper}
    changes |= {c: title_case(F.trim(c)) for c in title}
    changes |= {c: F.lower(F.trim(c)) for c in lower}
    changes |= {c: F.trim(c) for c in strip}
    return df.withColumns(changes)


def drop_transferred(holidays: DataFrame) -> DataFrame:
    return holidays.where(~F.col("transferred"))


def flag_national(holidays: DataFrame) -> DataFrame:
    return holidays.withColumn("is_national", contains_text(F.col("locale"), "national"))


def map_store_size(df: DataFrame, column: str = "type", unknown: str | None = None) -> DataFrame:
    return df.withColumn("store_size", lookup(F.col(column), SIZE_BY_STORE_TYPE, unknown))


def fill_forward_backward(df: DataFrame, column: str, order: str = "date") -> DataFrame:
    """Last known value, else the next known one. For day tables: one row per calendar day, one task."""
    ordered = Window.partitionBy().orderBy(order)
    before = F.last(column, True).over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(column, True).over(ordered.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(column, F.coalesce(before, after))


def fill_numeric_nulls(df: DataFrame) -> DataFrame:
    return df.na.fill(0, numeric_columns(df))


def fill_critical_nulls(df: DataFrame, columns: tuple = ("date", "store_id", "family", "sales")) -> DataFrame:
    """Numbers to 0, text to Unknown. Dates keep their type, so a null date stays null."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in columns if isinstance(kinds[c], NumericType)]
    words = [c for c in columns if kinds[c].simpleString() == "string"]
    return df.na.fill(0, numbers).na.fill("Unknown", words)


def critical_null_counts(df: DataFrame, columns: tuple = ("date", "store_id", "family", "sales")) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def clean_sales(raw: DataFrame, stage: Stage = lazy) -> DataFrame:
    """All sales steps in order. The cap and the anomaly days each read the de-duplicated rows once more,
    so a writing ``stage`` keeps those rows, the cap and the days as tables."""
    df = stage(clip_negative(promo_count_to_flag(coerce_dates(dedup_rows(raw)))), "sales_base")
    df = flag_anomaly_days(cap_outliers_quantile(df, stage=stage), stage=stage)
    return standardise_text(df, upper=("family",))


def clean_stores(raw: DataFrame) -> DataFrame:
    df = standardise_text(dedup_by_key(raw), title=("city", "state"), upper=("type",))
    return map_store_size(df)


def clean_holidays(raw: DataFrame) -> DataFrame:
    df = standardise_text(coerce_dates(raw), lower=("type",), strip=("description",))
    return flag_national(drop_transferred(df))


def clean_oil(raw: DataFrame) -> DataFrame:
    return fill_forward_backward(coerce_dates(raw), "dcoilwtico")


def _long_report(source: str, row: DataFrame) -> DataFrame:
    pairs = F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in row.columns]), F.array(*[F.col(c).cast("double") for c in row.columns])))
    return row.select(F.lit(source).alias("source"), pairs.alias("metric", "value"))


def sales_report(raw: DataFrame, stage: Stage = lazy) -> DataFrame:
    """Counts of the sales steps. The raw table is read once: each row's copies are counted as it is de-duplicated, and all else
    comes from that table, which a writing ``stage`` keeps."""
    counted = stage(raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_copies")), "sales_counted")
    dated = clip_negative(promo_count_to_flag(counted.withColumn("date", F.col("date").try_cast("date"))))
    kept = F.col("date").isNotNull()
    limit = stage(exact_quantile(dated.where(kept), "sales", CAP_QUANTILE), "sales_cap").scalar()
    capped = dated.where(kept).withColumn("sales", F.least("sales", limit))
    flagged = stage(anomaly_days(capped).agg(F.count(F.lit(1)).alias("n")), "anomaly_count").scalar()
    row = dated.withColumn("_cap", limit).agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count_if(kept).alias("final_rows"),
        F.count_if(kept & (F.col("sales") > F.col("_cap"))).alias("outliers_capped"),
        round_scaled(F.max(F.when(kept, F.col("_cap"))), 2).alias("outlier_threshold"),
        round_scaled(F.avg(F.when(kept, F.col("onpromotion"))) * 100, 1).alias("actual_promo_rate"),
        F.count_if(kept & (F.col("sales") == 0)).alias("zero_sales_kept"))
    return _long_report("sales", row.withColumn("anomaly_days_flagged", flagged))


def stores_report(stores: DataFrame) -> DataFrame:
    totals = stores.agg(F.count(F.lit(1)).alias("total_stores"), F.countDistinct("city").alias("cities"))
    by_type = stores.groupBy("type").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("stores").alias("source"), F.concat(F.lit("type_"), "type").alias("metric"),
        F.col("n").cast("double").alias("value"))
    return _long_report("stores", totals).unionByName(by_type)


def holidays_report(holidays: DataFrame) -> DataFrame:
    totals = holidays.agg(F.count(F.lit(1)).alias("total_events"))
    by_type = holidays.groupBy("type").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("holidays").alias("source"), F.concat(F.lit("type_"), "type").alias("metric"),
        F.col("n").cast("double").alias("value"))
    return _long_report("holidays", totals).unionByName(by_type)


def oil_report(raw: DataFrame) -> DataFrame:
    dated = coerce_dates(raw)
    return _long_report("oil", dated.agg(
        F.count(F.lit(1)).alias("total_days"),
        F.when(F.count("dcoilwtico") > 0, F.count_if(F.col("dcoilwtico").isNull())).otherwise(0)
        .alias("nulls_filled"),
        F.min("dcoilwtico").alias("lowest_price"), F.max("dcoilwtico").alias("highest_price")))


def merged_report(merged: DataFrame) -> DataFrame:
    return _long_report("merged", merged.agg(
        F.count(F.lit(1)).alias("final_rows")).withColumn("final_columns", F.lit(len(merged.columns))))


def cleaning_report(sales: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame,
                    merged: DataFrame, stage: Stage = lazy) -> DataFrame:
    """All sources' counts as (source, metric, value)."""
    parts = [sales_report(sales, stage), stores_report(stores), holidays_report(holidays), oil_report(oil),
             merged_report(merged)]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
