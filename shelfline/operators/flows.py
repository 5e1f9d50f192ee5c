"""End-to-end flows: raw tables to panel, features, warehouse, model-ready rows and alerts."""

from __future__ import annotations

import time
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from shelfline.functions.lookups import STAPLE_FAMILY
from shelfline.operators import cleaning, encoding, features, merging, stockout, warehouse
from shelfline.plans.staging import Stage, lazy
from shelfline.plans.versions import VersionedTable
from shelfline.sources.calendar import calendar_of, dim_date
from shelfline.sources.sinks import PANEL_ORDER, sort_panel


@dataclass
class RawTables:
    sales: DataFrame
    stores: DataFrame
    holidays: DataFrame
    oil: DataFrame
    products: DataFrame
    cpi: DataFrame | None = None


class Warehouse:
    """The star schema of one load. Each table is built when it is first asked for, and staged."""

    def __init__(self, raw: RawTables, featured: DataFrame, calendar: DataFrame, stage: Stage = lazy):
        self.raw, self.featured, self.calendar, self.stage = raw, featured, calendar, stage

    @cached_property
    def dim_date(self) -> DataFrame:
        return self.stage(dim_date(self.calendar, cleaning.clean_holidays(self.raw.holidays)), "dim_date")

    @cached_property
    def dim_store(self) -> DataFrame:
        stores = cleaning.clean_stores(self.raw.stores)
        return self.stage(warehouse.load_dim_store(stores, self.featured), "dim_store")

    @cached_property
    def dim_product(self) -> DataFrame:
        return self.stage(warehouse.load_dim_product(self.raw.products), "dim_product")

    @cached_property
    def dim_economic(self) -> DataFrame:
        prices = cleaning.clean_oil(self.raw.oil)
        return self.stage(warehouse.load_dim_economic(prices, self.dim_date), "dim_economic")

    @cached_property
    def dim_cpi(self) -> DataFrame | None:
        if self.raw.cpi is None:
            return None
        rows = warehouse.load_dim_cpi(self.raw.cpi, None if self.stage is lazy else self.stage)
        return self.stage(rows, "dim_cpi")

    @cached_property
    def loaded(self) -> DataFrame:
        """Accepted and rejected rows from one pass over the panel, in folders by outcome and year."""
        rows = warehouse.classify_fact_rows(self.featured, self.dim_date, self.dim_store, self.dim_product, self.raw.stores)
        return self.stage(warehouse.loaded_rows(rows), "fact_daily_sales", warehouse.FACT_FOLDERS, warehouse.FACT_ORDER)

    @property
    def fact(self) -> DataFrame:
        return warehouse.accepted_rows(self.loaded)

    @property
    def rejects(self) -> DataFrame:
        return warehouse.rejected_rows(self.loaded)


def clean_flow(raw: RawTables, stage: Stage = lazy) -> DataFrame:
    """Raw tables to the merged panel."""
    merged = merging.merge_all(cleaning.clean_sales(raw.sales, stage), cleaning.clean_stores(raw.stores),
                               cleaning.clean_holidays(raw.holidays), cleaning.clean_oil(raw.oil))
    return stage(merged, "merged")


def features_flow(raw: RawTables, merged: DataFrame | None = None, stage: Stage = lazy) -> DataFrame:
    """Merged panel to the featured panel."""
    merged = clean_flow(raw, stage) if merged is None else merged
    return stage(features.build_features(merged, stage=stage), "featured")


def warehouse_flow(raw: RawTables, featured: DataFrame | None = None, calendar: DataFrame | None = None,
                   stage: Stage = lazy) -> Warehouse:
    """Featured panel to star schema. ``calendar`` defaults to the calendar years of the sales."""
    featured = features_flow(raw, stage=stage) if featured is None else featured
    return Warehouse(raw, featured, calendar_of(raw.sales) if calendar is None else calendar, stage)


def ml_ready_flow(raw: RawTables, house: Warehouse, staple: str = STAPLE_FAMILY, stage: Stage = lazy) -> DataFrame:
    """Star join, quality repairs, encodings and interactions; a folder per year, and files in order of series and day.

    The family ranks come from sums of the fact itself, so the star is joined once.
    """
    star = warehouse.star_join(house.fact, house.dim_date, house.dim_store, house.dim_product, raw.stores)
    sums = stage(warehouse.fact_sums(house.fact, house.dim_store, house.dim_product, raw.stores), "family_sums")
    return stage(encoding.build_ml_ready(star, staple, stage, sums), "ml_ready", ("year",), PANEL_ORDER)


def publish_dimensions(house: Warehouse, panel: DataFrame, path: str, stores: DataFrame | None = None) -> tuple[VersionedTable, VersionedTable]:
    """Publish the store and product dimensions with the metrics of a panel, as new versions of the tables under ``path``.

    The first run publishes the dimensions as loaded before, so that what the update started from stays readable.
    """
    spark = panel.sparkSession
    tables = VersionedTable(spark, f"{path}/dim_store"), VersionedTable(spark, f"{path}/dim_product")
    for table, loaded in zip(tables, (house.dim_store, house.dim_product), strict=True):
        if not table.versions():
            table.publish(loaded)
    tables[0].publish(warehouse.update_store_metrics(tables[0].read(), panel, stores))
    tables[1].publish(warehouse.update_product_metrics(tables[1].read(), panel))
    return tables


def run_etl(raw: RawTables, house: Warehouse, path: str, staple: str = STAPLE_FAMILY) -> DataFrame:
    """Publish the model-ready panel by year and the dimensions with its metrics; returns a one-row run log.

    Under ``path``, each table is a ``VersionedTable``: a run that fails leaves the versions before it as they are. Panel rows replace
    the years they touch. The counts ride on the write itself: ``errors`` counts the rows the fact rejected; ``rows_repaired`` those
    with a null or negative value to mend; ``stores_updated`` and ``products_updated`` the dimension rows whose metrics changed.
    """
    spark: SparkSession = raw.sales.sparkSession
    star = warehouse.star_join(house.fact, house.dim_date, house.dim_store, house.dim_product, raw.stores)
    extracted, transformed = Observation("extracted"), Observation("transformed")
    broken = F.col("sales").isNull() | (F.col("sales") < 0)
    ready = encoding.build_ml_ready(star.observe(extracted, F.count(F.lit(1)).alias("n"), F.count_if(broken).alias("broken")), staple)
    started = time.time()
    panel = VersionedTable(spark, f"{path}/ml_ready", "year")
    panel.publish_parts(sort_panel(ready.observe(transformed, F.count(F.lit(1)).alias("n"))))
    stores, products = publish_dimensions(house, panel.read(), path, raw.stores)
    ended = time.time()

    def changed(table: VersionedTable, key: str) -> Column:
        """Rows that differ from the version before; dimension rows only."""
        before = table.read(table.versions()[-2])
        return before.join(table.read().exceptAll(before).select(key), key, "left_semi").agg(F.count(F.lit(1))).scalar()

    one = panel.read().agg(F.count(F.lit(1)).alias("rows_loaded"))
    return one.select(
        F.timestamp_seconds(F.lit(started)).alias("start_time"), F.timestamp_seconds(F.lit(ended)).alias("end_time"),
        F.lit(ended - started).alias("seconds"),
        F.lit(extracted.get["n"]).alias("rows_extracted"), F.lit(transformed.get["n"]).alias("rows_transformed"),
        "rows_loaded", F.lit(extracted.get["broken"]).alias("rows_repaired"),
        house.rejects.agg(F.count(F.lit(1))).scalar().alias("errors"),
        changed(stores, "store_key").alias("stores_updated"), changed(products, "product_key").alias("products_updated"))


def alerts_flow(ml_ready: DataFrame, predictions: DataFrame | None = None, as_of=None) -> DataFrame:
    """Newest day with predictions, through the ladder, most severe first."""
    newest = stockout.latest_snapshot(ml_ready, as_of)
    return stockout.sort_alerts_by_severity(stockout.alert_ladder(stockout.attach_predictions(newest, predictions)))
