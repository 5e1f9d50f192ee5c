"""Retail tables derived from the test tables; FIXTURES.md holds the rules."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelfline.operators import flows, forecasting, rollup
from shelfline.operators.stockout import attach_predictions, risk_scores
from shelfline.operators.panel import densify_panel
from shelfline.plans.sizing import join_dim
from shelfline.plans.staging import Stage, WrittenTables, lazy
from shelfline.sources.products import product_seed
from shelfline.sources.sinks import write_bucketed

TEST_FROM = 2001
STAPLE = "ECONOMY"
# Stand-in product list by part type; PROMO is left out on purpose, so that its rows are rejected.
PRODUCTS = [
    ("ECONOMY", "FMCG", "Staples", 1, 0),
    ("SMALL", "FMCG", "Beverages", 1, 0),
    ("MEDIUM", "Fresh", "Dairy", 1, 1),
    ("LARGE", "Fresh", "Frozen", 1, 0),
    ("STANDARD", "Non-Food", "Hardware", 0, 0),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sales_lines(spark: SparkSession, d: str) -> DataFrame:
    """One row per shipped line: store (nation of the supplier), family (type of the part), day."""
    lines = table(spark, d, "lineitem").select(
        "l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("sales"),
        (F.col("l_discount") >= 0.05).cast("int").alias("onpromotion"))
    supplier, part = table(spark, d, "supplier"), table(spark, d, "part")
    places = supplier.select("s_suppkey", F.col("s_nationkey").alias("store_nbr"))
    goods = part.select("p_partkey", F.col("p_type").alias("family"))
    joined = join_dim(lines, places, lines.l_suppkey == places.s_suppkey, bound=supplier)
    return (join_dim(joined, goods, lines.l_partkey == goods.p_partkey, bound=part)
            .select("date", "store_nbr", "family", "sales", "onpromotion"))


def raw_sales(spark: SparkSession, d: str, stage: Stage = lazy) -> DataFrame:
    return densify_panel(sales_lines(spark, d), ["store_nbr", "family"], stage=stage).select(
        "date", "store_nbr", "family", "sales", "onpromotion")


def raw_stores(spark: SparkSession, d: str) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    letter = F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), F.col("n_nationkey") % 5 + 1)
    return join_dim(nation, region, nation.n_regionkey == region.r_regionkey, bound=region).select(
        F.col("n_nationkey").alias("store_nbr"), F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("city"),
        F.col("r_name").alias("state"), F.lower(letter).alias("type"), F.col("n_regionkey").alias("cluster"))


def raw_holidays(spark: SparkSession, d: str) -> DataFrame:
    """The first order day of each month and of each quarter; dates are text and those of May are unreadable."""
    days = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    month = F.month("day")
    monthly = (days.groupBy(F.year("day").alias("y"), month.alias("m")).agg(F.min("day").alias("day"))
               .select("day", F.col("m"), F.element_at(F.array(*[F.lit(x) for x in (" Holiday ", "EVENT", "Additional",
                                                                                    "Bridge")]), F.col("m") % 4 + 1)
                       .alias("type"),
                       F.element_at(F.array(F.lit("National"), F.lit("Regional "), F.lit(None)), F.col("m") % 3 + 1)
                       .alias("locale"),
                       F.concat(F.lit(" First orders of month "), F.col("m").cast("string"), F.lit(" "))
                       .alias("description"), (F.col("m") % 6 == 0).alias("transferred")))
    quarterly = (days.groupBy(F.year("day").alias("y"), F.quarter("day").alias("q")).agg(F.min("day").alias("day"))
                 .select("day", F.month("day").alias("m"), F.lit("Holiday").alias("type"),
                         F.lit("NATIONAL").alias("locale"),
                         F.concat(F.lit("Quarter "), F.col("q").cast("string")).alias("description"),
                         F.lit(False).alias("transferred")))
    text = F.when(F.col("m") == 5, "not-a-date").otherwise(F.col("day").cast("string"))
    return monthly.unionByName(quarterly).select(text.alias("date"), "type", "locale", "description", "transferred")


def raw_oil(spark: SparkSession, d: str) -> DataFrame:
    """Highest order of each order day as its price; no trading on weekends."""
    per_day = (table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date"))
               .agg((F.max("o_totalprice") / 1000).alias("p")))
    return per_day.select("date", F.when(F.weekday("date") < 5, F.col("p")).alias("dcoilwtico"))


def raw_cpi(spark: SparkSession, d: str) -> DataFrame:
    """Highest price per brand, nation and month; the national price is the highest over nations."""
    lines = table(spark, d, "lineitem").select(
        "l_suppkey", "l_partkey", F.to_date("l_shipdate").alias("day"), "l_extendedprice", "l_discount")
    supplier, part, nation = (table(spark, d, n) for n in ("supplier", "part", "nation"))
    places = join_dim(supplier, nation, supplier.s_nationkey == nation.n_nationkey, bound=nation).select(
        "s_suppkey", F.col("n_name").alias("city"))
    goods = part.select("p_partkey", F.col("p_brand").alias("item_name"))
    joined = join_dim(lines, places, lines.l_suppkey == places.s_suppkey, bound=supplier)
    joined = join_dim(joined, goods, lines.l_partkey == goods.p_partkey, bound=part)
    per_city = joined.groupBy(F.year("day").alias("year"), F.month("day").alias("month"), "item_name", "city").agg(
        F.max("l_extendedprice").alias("city_price"), F.max("l_discount").alias("disc"))
    month = Window.partitionBy("year", "month", "item_name")
    return per_city.select(
        F.make_date("year", "month", F.lit(1)).alias("date"), "year", "month",
        F.substring_index("item_name", "#", -1).cast("int").alias("item_id"), "item_name",
        F.max("city_price").over(month).alias("national_avg_price"),
        F.when(F.col("disc") < 0.1, F.col("disc") * 100).alias("pct_change"), "city", "city_price")


class StandIns:
    """The raw inputs; a writing stage turns them into files, as a user of the library would have them."""

    def __init__(self, spark: SparkSession, sf_dir: str, stage: Stage = lazy):
        self.spark, self.dir, self.stage = spark, sf_dir, stage

    @cached_property
    def sales(self) -> DataFrame:
        return self.stage(raw_sales(self.spark, self.dir, self.stage), "raw_sales")

    @cached_property
    def stores(self) -> DataFrame:
        return self.stage(raw_stores(self.spark, self.dir), "raw_stores")

    @cached_property
    def holidays(self) -> DataFrame:
        return self.stage(raw_holidays(self.spark, self.dir), "raw_holidays")

    @cached_property
    def oil(self) -> DataFrame:
        return self.stage(raw_oil(self.spark, self.dir), "raw_oil")

    @cached_property
    def products(self) -> DataFrame:
        return product_seed(self.spark, PRODUCTS)

    @cached_property
    def cpi(self) -> DataFrame:
        return self.stage(raw_cpi(self.spark, self.dir), "raw_cpi")


class Bed:
    """The chain of tables for one session and folder.

    Each step is written as a table when a query first needs it, and later queries read that table, just
    as the queries of a warehouse read tables that a load has written.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stage: Stage | None = None):
        self.spark, self.dir = spark, sf_dir
        self.stage = stage or WrittenTables(spark)
        self._made: dict[str, object] = {}

    def _once(self, name: str, make):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def raw(self) -> StandIns:
        return self._once("raw", lambda: StandIns(self.spark, self.dir, self.stage))

    @property
    def panel(self) -> DataFrame:
        """Raw sales under the panel's key names."""
        return self.raw.sales.withColumnRenamed("store_nbr", "store_id")

    @property
    def bucketed(self) -> DataFrame:
        """The raw panel as a table in buckets by series."""
        return self._once("bucketed", lambda: write_bucketed(
            self.panel, f"panel_{uuid.uuid4().hex}", f"{self.stage.root}/panel_bucketed"))

    @property
    def merged(self) -> DataFrame:
        return self._once("merged", lambda: flows.clean_flow(self.raw, self.stage))

    @property
    def featured(self) -> DataFrame:
        return self._once("featured", lambda: flows.features_flow(self.raw, self.merged, self.stage))

    @property
    def house(self) -> flows.Warehouse:
        return self._once("house", lambda: flows.warehouse_flow(self.raw, self.featured, stage=self.stage))

    @property
    def ml_ready(self) -> DataFrame:
        return self._once("ml_ready", lambda: flows.ml_ready_flow(self.raw, self.house, STAPLE, self.stage))

    @property
    def analysed(self) -> DataFrame:
        """Model-ready rows with sales as double, the form the analyses read."""
        return self._once("analysed", lambda: self.ml_ready.withColumns({
            c: F.col(c).cast("double") for c, t in self.ml_ready.dtypes if t.startswith("decimal")}))

    @property
    def rollup(self) -> DataFrame:
        """Sums of the panel that the reports share."""
        return self._once("rollup", lambda: self.stage(rollup.panel_rollup(self.analysed), "rollup", ("part",)))

    @property
    def monthly(self) -> DataFrame:
        return rollup.by_month(self.rollup)

    @property
    def weekdays(self) -> DataFrame:
        return rollup.by_weekday(self.rollup)

    @property
    def predictions(self) -> DataFrame:
        """Stand-in forecast for the test year: sales seven rows back."""
        return self._once("predictions", lambda: self.analysed.where(F.col("year") >= TEST_FROM).select(
            "store_id", "family", "date", F.col("sales").alias("actual"),
            F.col("sales_lag_7d").alias("predicted")))

    @property
    def predicted(self) -> DataFrame:
        """The test year's rows with the stand-in forecast attached."""
        return attach_predictions(self.analysed, self.predictions)

    @property
    def risk(self) -> DataFrame:
        return self._once("risk", lambda: risk_scores(self.analysed, self.stage))

    def trees(self):
        """A small boosted-tree model and its training seconds, fitted once."""
        def fit():
            train, _ = forecasting.split_by_year(self.analysed, TEST_FROM)
            return forecasting.train_gbt(train, maxIter=10, maxDepth=5, stepSize=0.1, subsamplingRate=0.8,
                                         featureSubsetStrategy="0.8", seed=42)
        return self._once("trees", fit)


_BEDS: dict[tuple[str, str], Bed] = {}


def bed(spark: SparkSession, sf_dir: str) -> Bed:
    """The bed of a running session; a new session starts a new one."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BEDS:
        _BEDS[key] = Bed(spark, sf_dir)
    return _BEDS[key]
