"""Star schema: dimensions, the daily fact, its rejects, and the join that reads it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline import schemas
from shelfline.functions.calendar import date_key
from shelfline.functions.lookups import SIZE_BY_STORE_TYPE, lookup
from shelfline.functions.rounding import round_exact, round_scaled, to_decimal
from shelfline.operators.cleaning import fill_forward_backward
from shelfline.operators.features import SERIES
from shelfline.plans.ordering import with_rank, with_row_number
from shelfline.plans.sizing import broadcast_bounded, join_dim
from shelfline.plans.staging import Stage
from shelfline.sources.readers import STAR_COLUMNS


def _metrics(df: DataFrame, key: str) -> DataFrame:
    """Mean, total and zero share per key, from sums per series so that a hot key moves few rows."""
    sums = df.groupBy(*SERIES).agg(F.sum(F.col("sales").cast("double")).alias("s"), F.count("sales").alias("n"),
                                   F.sum("is_zero_sale").alias("z"), F.count("is_zero_sale").alias("zn"))
    return sums.groupBy(key).agg((F.sum("s") / F.sum("n")).alias("avg_daily_sales"),
                                 F.sum("s").alias("total_revenue"),
                                 (F.sum("z") / F.sum("zn")).alias("zero_share"))


def store_metrics(df: DataFrame) -> DataFrame:
    return _metrics(df, "store_id").select(
        "store_id", "avg_daily_sales", "total_revenue",
        round_scaled(F.col("zero_share") * 100, 2).alias("stockout_rate"))


def product_metrics(df: DataFrame) -> DataFrame:
    ranked = with_rank(_metrics(df, "family"), "total_revenue", "rank", method="average")
    return ranked.select("family", "avg_daily_sales", "total_revenue",
                         round_exact(F.col("zero_share") * 100, 2).alias("stockout_rate"),
                         F.col("rank").cast("int").alias("popularity_rank"))


def stores_with_metrics(stores: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metrics of the stores in the dimension; the semi-join makes the size of ``stores`` a bound of what is broadcast."""
    known = join_dim(metrics, stores.select(F.col("store_nbr").alias("store_id")).distinct(), "store_id", "left_semi", bound=stores)
    return join_dim(stores, known, stores["store_nbr"] == known["store_id"], "left", bound=stores)


def load_dim_store(stores: DataFrame, panel: DataFrame) -> DataFrame:
    joined = stores_with_metrics(stores, store_metrics(panel))
    kind = F.trim("type")
    return joined.select(
        F.col("store_nbr").alias("store_key"), F.col("store_nbr").alias("store_id"),
        F.trim("city").alias("city"), F.trim("state").alias("state"), kind.alias("store_type"),
        lookup(kind, SIZE_BY_STORE_TYPE, "Unknown").alias("store_size"), "cluster",
        to_decimal(F.col("avg_daily_sales"), "decimal(12,2)").alias("avg_daily_sales"),
        to_decimal(F.col("total_revenue"), "decimal(25,2)").alias("total_revenue"),
        to_decimal(F.col("stockout_rate"), "decimal(5,2)").alias("stockout_rate"))


def load_dim_product(seed: DataFrame) -> DataFrame:
    """Surrogate keys by family name; the seed is a table fixed in code, so one task orders it."""
    return seed.select(
        F.row_number().over(Window.partitionBy().orderBy("family")).alias("product_key"),
        "family", "category", "subcategory", "is_fmcg", "is_perishable",
        F.lit(0).cast("decimal(12,2)").alias("avg_daily_sales"),
        F.lit(0).cast("decimal(25,2)").alias("total_revenue"), F.lit(0).alias("popularity_rank"),
        F.lit(0).cast("decimal(5,2)").alias("stockout_rate"))


def oil_rolling_mean(oil: DataFrame) -> DataFrame:
    """Seven-row mean over the price table (one row per day, one task)."""
    return oil.withColumn("oil_7d_avg", F.avg("dcoilwtico").over(
        Window.partitionBy().orderBy("date").rowsBetween(-6, 0)))


def oil_change(oil: DataFrame) -> DataFrame:
    previous = F.lag("dcoilwtico").over(Window.partitionBy().orderBy("date"))
    return oil.withColumn("oil_change", F.coalesce(F.col("dcoilwtico") - previous, F.lit(0.0)))


def load_dim_economic(oil: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Filled price, its mean and change; days outside the day dimension are left out."""
    filled = fill_forward_backward(oil, "dcoilwtico").where(F.col("dcoilwtico").isNotNull())
    rows = oil_change(oil_rolling_mean(filled)).select(
        date_key(F.col("date")).alias("date_key"), F.col("date").alias("full_date"),
        to_decimal(F.col("dcoilwtico"), "decimal(8,2)").alias("oil_price"),
        to_decimal(F.col("oil_7d_avg"), "decimal(8,2)").alias("oil_price_7d_avg"),
        to_decimal(F.col("oil_change"), "decimal(8,2)").alias("oil_price_change"))
    return rows.join(broadcast_bounded(dim_date.select("date_key")), "date_key", "left_semi")


def scd_defaults_truncate(cpi: DataFrame) -> DataFrame:
    """Typed defaults for nulls, text cut to the column widths, prices to two decimals."""
    def money(column: str, kind: str) -> Column:
        return F.coalesce(to_decimal(F.col(column), kind), F.lit(0).cast(kind)).alias(column)

    return cpi.select(
        F.coalesce("date", F.lit("2019-01-01").cast("date")).alias("date"),
        F.coalesce("year", F.lit(2019)).alias("year"), F.coalesce("month", F.lit(1)).alias("month"),
        F.coalesce("item_id", F.lit(0)).alias("item_id"),
        F.substring(F.coalesce("item_name", F.lit("Unknown")), 1, 200).alias("item_name"),
        money("national_avg_price", "decimal(10,2)"), money("pct_change", "decimal(6,2)"),
        F.substring(F.coalesce("city", F.lit("Unknown")), 1, 100).alias("city"),
        money("city_price", "decimal(10,2)"))


def load_dim_cpi(cpi: DataFrame, stage: Stage | None = None) -> DataFrame:
    """CPI rows with a surrogate key in (month, item, city) order."""
    numbered = with_row_number(scd_defaults_truncate(cpi), ["year", "month", "item_id", "city"], "cpi_key", stage=stage)
    return numbered.select(schemas.DIM_CPI.fieldNames())


def to_warehouse_decimals(df: DataFrame) -> DataFrame:
    """Fourteen measures to their decimal type, five to integers."""
    return df.withColumns({
        **{c: to_decimal(F.col(c), schemas.fact_decimal_type(c)) for c in schemas.FACT_DECIMALS},
        **{c: F.col(c).cast("int") for c in schemas.FACT_INTEGERS}})


def product_key_lookup(panel: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Panel with the surrogate product key; null where the family is not in the dimension."""
    keys = dim_product.select("family", "product_key")
    return join_dim(panel, keys, "family", "left", bound=dim_product)


def _out_of_range() -> Column:
    def too_large(column: str) -> Column:
        limit = 1e6 if schemas.fact_decimal_type(column) == "decimal(8,2)" else 1e10
        return F.coalesce(F.abs(F.col(column)) >= limit - 0.005, F.lit(False))

    return reduce(lambda a, b: a | b, [too_large(c) for c in schemas.FACT_DECIMALS])


def classify_fact_rows(panel: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_product: DataFrame,
                       stores: DataFrame | None = None) -> DataFrame:
    """Keys and a reject reason (null = keep) for every panel row; one pass, dimensions broadcast."""
    df = product_key_lookup(panel, dim_product).withColumn("date_key", date_key(F.col("date")))
    days = broadcast_bounded(dim_date.select("date_key", F.lit(1).alias("_day")))
    known = dim_store.select(F.col("store_id"), "store_key")
    df = join_dim(df.join(days, "date_key", "left"), known, "store_id", "left", bound=stores)
    reason = (F.when(F.col("product_key").isNull(), "unknown_family")
              .when(F.col("_day").isNull(), "unknown_date")
              .when(F.col("date") < F.lit("1970-01-01").cast("date"), "date_out_of_range")
              .when(F.col("store_key").isNull(), "unknown_store")
              .when(_out_of_range(), "value_out_of_range"))
    return df.withColumn("reject_reason", reason).drop("_day")


def _fact_columns() -> list[Column]:
    """The columns of a fact row. The key packs day, store and product in ten digits each, which hold any INT, so it needs no
    sort and two rows never share it. Negative parts would not fit and are refused."""
    parts = [F.unix_date("date"), F.col("store_key"), F.col("product_key")]
    ten = F.lit(10 ** 10).cast("decimal(11,0)")
    checked = [F.when(p >= 0, p.cast("decimal(10,0)")).otherwise(F.raise_error(F.lit("negative key")).cast("decimal(10,0)")) for p in parts]
    packed = ((checked[0] * ten + checked[1]).cast("decimal(20,0)") * ten + checked[2]).cast("decimal(30,0)")

    def decimals(*names: str) -> list[Column]:
        return [to_decimal(F.col(c), schemas.fact_decimal_type(c)).alias(c) for c in names]

    def integers(*names: str) -> list[Column]:
        return [(F.col(c).cast("int") if c in schemas.FACT_INTEGERS else F.col(c)).alias(c) for c in names]

    return [packed.alias("sale_key"), *integers("date_key", "store_key", "product_key"), *decimals("sales"),
            *integers("onpromotion", "onpromotion_count"), *decimals(*schemas.FACT_DECIMALS[1:10]),
            *integers("is_zero_sale", "zero_sales_last_7d", "consecutive_zeros"), *decimals(*schemas.FACT_DECIMALS[10:])]


def fact_rows(classified: DataFrame) -> DataFrame:
    """The accepted rows in fact form."""
    return classified.where(F.col("reject_reason").isNull()).select(_fact_columns())


REJECT_COLUMNS = ["date", "store_id", "family", "sales", "reject_reason"]
#: how a load is split into folders, and its rows ordered inside each file, so that readers of a day or a year can skip
FACT_FOLDERS, FACT_ORDER = ("outcome", "fact_year"), ("date_key", "store_key", "product_key")


def fact_rejects(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull()).select(REJECT_COLUMNS)


def loaded_rows(classified: DataFrame) -> DataFrame:
    """Every row of a load, in fact form if accepted and as a reject with its reason if not, so that one write takes both.

    ``outcome`` tells them apart; with ``fact_year``, the year of the day, it is the folder a row goes to.
    """
    kept = F.col("reject_reason").isNull()
    facts = _fact_columns()
    names = fact_rows(classified).columns
    return classified.select(
        *[F.when(kept, column).alias(name) for column, name in zip(facts, names, strict=True)],
        *[F.when(~kept, F.col(c)).alias(f"reject_{c}".replace("reject_reject", "reject")) for c in REJECT_COLUMNS],
        F.when(kept, "accepted").otherwise("rejected").alias("outcome"), F.year("date").alias("fact_year"))


def accepted_rows(loaded: DataFrame) -> DataFrame:
    """The fact: the accepted rows of a load, with their year."""
    return loaded.where(F.col("outcome") == "accepted").drop("outcome", *[c for c in loaded.columns if c.startswith("reject_")])


def rejected_rows(loaded: DataFrame) -> DataFrame:
    return loaded.where(F.col("outcome") == "rejected").select(
        *[F.col(f"reject_{c}").alias(c) for c in REJECT_COLUMNS[:-1]], "reject_reason")


def load_fact(panel: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_product: DataFrame,
              stores: DataFrame | None = None) -> DataFrame:
    return fact_rows(classify_fact_rows(panel, dim_date, dim_store, dim_product, stores))


def fk_conformance(df: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in the dimension, rows whose key is not)."""
    keys = dim.select(key)
    return join_dim(df, keys, key, "left_semi", bound=dim), join_dim(df, keys, key, "left_anti", bound=dim)


def star_join(fact: DataFrame, dim_date: DataFrame, dim_store: DataFrame, dim_product: DataFrame,
              stores: DataFrame | None = None) -> DataFrame:
    """Fact with its three dimensions; ``stores`` is the table that bounds the store dimension's rows."""
    measures = ["date_key", "store_key", "product_key", *STAR_COLUMNS["f"]]
    days = dim_date.select("date_key", F.col("full_date").alias("date"), *STAR_COLUMNS["d"])
    places = dim_store.select("store_key", *STAR_COLUMNS["s"])
    goods = dim_product.select("product_key", *STAR_COLUMNS["p"])
    joined = fact.select(measures).join(broadcast_bounded(days), "date_key")
    joined = join_dim(joined, places, "store_key", bound=stores)
    joined = join_dim(joined, goods, "product_key", bound=dim_product)
    return joined.select("date", *[c for group in STAR_COLUMNS.values() for c in group])


def fact_sums(fact: DataFrame, dim_store: DataFrame, dim_product: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """Sales and rows per store and family of the fact, nulls as 0 and nothing below 0; one row per series is joined."""
    sales = F.greatest(F.coalesce(F.col("sales").cast("double"), F.lit(0.0)), F.lit(0.0))
    sums = fact.groupBy("store_key", "product_key").agg(F.sum(sales).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    named = join_dim(sums, dim_store.select("store_key", "store_id"), "store_key", bound=stores)
    return join_dim(named, dim_product.select("product_key", "family"), "product_key", bound=dim_product).select("store_id", "family", "_sum", "_n")


def _update(dim: DataFrame, metrics: DataFrame, key: str, columns: dict[str, str], bound: DataFrame | None):
    new = metrics.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = join_dim(dim, new, key, "left", bound=bound)
    updated = {c: F.coalesce(to_decimal(F.col(f"_new_{c}"), t) if t.startswith("decimal") else F.col(f"_new_{c}"),
                             F.col(c)) for c, t in columns.items()}
    return joined.withColumns(updated).select(dim.columns)


def update_store_metrics(dim_store: DataFrame, panel: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    return _update(dim_store, store_metrics(panel), "store_id", {
        "avg_daily_sales": "decimal(12,2)", "total_revenue": "decimal(25,2)", "stockout_rate": "decimal(5,2)"},
        bound=stores)


def update_product_metrics(dim_product: DataFrame, panel: DataFrame) -> DataFrame:
    return _update(dim_product, product_metrics(panel), "family", {
        "avg_daily_sales": "decimal(12,2)", "total_revenue": "decimal(25,2)", "stockout_rate": "decimal(5,2)",
        "popularity_rank": "int"}, bound=dim_product)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def fact_quality_check(fact: DataFrame) -> DataFrame:
    return fact.agg(F.min("sales").alias("min_sales"), F.max("sales").alias("max_sales"),
                    F.avg(F.col("sales").cast("double")).alias("avg_sales"),
                    F.sum("is_zero_sale").alias("zero_sale_count"))
