"""Versioned tables, the load in folders, and what the readers of one day skip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline import schemas
from shelfline.operators import features as ft, flows, questions as qs, stockout as so, warehouse as wh
from shelfline.plans.staging import WrittenTables
from shelfline.plans.versions import VersionedTable
from shelfline.sources.calendar import dim_date, generate_calendar
from shelfline.sources.products import product_seed
from shelfline.sources.sinks import sort_panel, write_panel


def rows(spark, values):
    return spark.createDataFrame(values, "year int, k int, v string")


def test_a_version_is_read_until_the_next_is_published(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    with pytest.raises(LookupError):
        table.read()
    table.publish(rows(spark, [(1, 1, "a")]))
    old = table.read()
    broken = rows(spark, [(1, 2, "b")]).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.publish(broken)
    assert [tuple(r) for r in table.read().collect()] == [(1, 1, "a")] and table.versions() == [1]
    table.publish(rows(spark, [(2, 2, "b")]))
    assert [tuple(r) for r in old.collect()] == [(1, 1, "a")] == [tuple(r) for r in table.read(1).collect()]
    assert [tuple(r) for r in table.read().collect()] == [(2, 2, "b")]


def test_only_touched_parts_are_replaced(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", "year")
    table.publish_parts(rows(spark, [(2001, 1, "a"), (2001, 2, "b"), (2002, 3, "c")]))
    table.publish_parts(rows(spark, [(2002, 4, "d"), (2003, 5, "e")]))
    assert sorted(map(tuple, table.read().collect())) == [(2001, 1, "a"), (2001, 2, "b"), (2002, 4, "d"), (2003, 5, "e")]
    assert sorted(map(tuple, table.read(1).collect())) == [(2001, 1, "a"), (2001, 2, "b"), (2002, 3, "c")]
    assert table.read().dtypes == rows(spark, []).dtypes
    table.publish_parts(rows(spark, []))
    assert table.read().count() == 4
    with pytest.raises(ValueError):
        VersionedTable(spark, f"{tmp_path}/u").publish_parts(rows(spark, []))


def test_the_second_of_two_runs_fails(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"{tmp_path}/t")
    table.publish(rows(spark, [(1, 1, "a")]))
    monkeypatch.setattr(table, "versions", lambda: [])  # as it was before the other run
    with pytest.raises(Exception, match="(?i)exists"):
        table.publish(rows(spark, [(1, 2, "b")]))
    assert [tuple(r) for r in VersionedTable(spark, f"{tmp_path}/t").read().collect()] == [(1, 1, "a")]


@pytest.fixture(scope="module")
def house(spark, series, tmp_path_factory):
    """A load over two years, one family unknown."""
    panel = series({(1, "A"): [3, 0, 0, 0, 20, 30, 0, 0, 0, 0], (2, "B"): range(10), (1, "C"): [1] * 10}, dt.date(2019, 12, 27))
    featured = ft.build_features(panel.withColumns({"onpromotion": F.lit(1), "onpromotion_count": F.lit(3)})).withColumn("oil_price", F.lit(50.0))
    stores = spark.createDataFrame([(1, "x", "s", "A", 1), (2, "y", "s", "B", 1)], schemas.STORES)
    stage = WrittenTables(spark, str(tmp_path_factory.mktemp("house")))
    events = spark.createDataFrame([], schemas.HOLIDAYS)
    raw = flows.RawTables(panel, stores, events, None, product_seed(spark, [("A", "FMCG", "x", 1, 0), ("B", "Fresh", "y", 1, 1)]))
    return flows.Warehouse(raw, stage(featured, "featured"), generate_calendar(spark, dt.date(2019, 1, 1), dt.date(2020, 12, 31)), stage)


def scans(df, column):
    """Lines of the plan that tell of partition filters on a column."""
    return [line for line in df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).split("\n")
            if line.startswith("PartitionFilters") and column in line]


def test_one_write_holds_both_outcomes(spark, house):
    assert house.fact.count() == 20 and house.rejects.count() == 10
    assert {r.reject_reason for r in house.rejects.collect()} == {"unknown_family"}
    assert house.rejects.columns == wh.REJECT_COLUMNS and house.rejects.where("sales is null").count() == 0
    assert house.fact.where("fact_year <> date_key div 10000").count() == 0
    names = [path for path in house.fact.inputFiles() if "fact_daily_sales" in path]
    assert {p.split("/")[-3] for p in names} <= {"outcome=accepted", "outcome=rejected"}
    written = [c for c in wh.fact_rows(wh.classify_fact_rows(house.featured, house.dim_date, house.dim_store, house.dim_product)).columns]
    assert house.fact.drop("fact_year").columns == written


def test_the_load_reads_the_panel_once(spark, house):
    rows_ = wh.loaded_rows(wh.classify_fact_rows(house.featured, house.dim_date, house.dim_store, house.dim_product, house.raw.stores))
    plan = rows_._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zero_sales_last_7d#") and sum("Relation" in line and "zero_sales_last_7d" in line for line in plan.split("\n")) == 1


def test_readers_of_the_newest_day_skip_the_other_years(spark, house):
    for df in (qs.latest_fact_date_filter(house.fact, house.dim_date),
               qs.q10_reorder_alerts(house.fact, house.dim_date, house.dim_store, house.dim_product, min_demand=1)):
        found = scans(df, "fact_year")
        assert found and all("accepted" in line for line in found)
        assert sum("Subquery" in line for line in found) >= 2  # the day is looked for, and read, in the newest year
    got = qs.latest_fact_date_filter(house.fact, house.dim_date).collect()
    assert {r.full_date for r in got} == {dt.date(2020, 1, 5)} and len(got) == 2
    alerts = qs.q10_reorder_alerts(house.fact, house.dim_date, house.dim_store, house.dim_product, min_demand=1).collect()
    assert [(r.store_id, r.family, r.days_without_sale) for r in alerts] == [(1, "A", 4)]


def test_snapshots_and_alerts_read_one_year(spark, house):
    ready = flows.ml_ready_flow(house.raw, house, "A", house.stage)
    for df in (so.latest_snapshot(ready), so.latest_snapshot(ready, "2020-01-02"), flows.alerts_flow(ready)):
        assert scans(df, "year")
    assert so.latest_snapshot(ready).count() == 2 and so.latest_snapshot(ready, "2019-12-30").count() == 2
    alerts = flows.alerts_flow(ready.withColumn("sales_rolling_mean_7d", F.lit(20.0)))
    assert [(r.store_id, r.family, r.alert_level) for r in alerts.collect()] == [(1, "A", "CRITICAL")]


def test_files_are_in_order(spark, house, series, tmp_path):
    ready = flows.ml_ready_flow(house.raw, house, "A", house.stage)
    assert dict(ready.dtypes)["year"] == "int"
    panel = series({(2, "B"): range(5), (1, "A"): range(5)}, dt.date(2019, 12, 30))
    write_panel(panel, f"{tmp_path}/panel")
    for path in spark.read.parquet(f"{tmp_path}/panel").inputFiles():
        keys = [(r.store_id, r.family, r.date) for r in spark.read.parquet(path).coalesce(1).collect()]
        assert keys == sorted(keys)
    assert "year" in sort_panel(panel).columns


def test_rows_before_1970_are_rejects(spark, series):
    panel = series({(1, "A"): [1, 2]}, dt.date(1969, 12, 31))
    full = ft.build_features(panel.withColumns({"onpromotion": F.lit(1), "onpromotion_count": F.lit(3)})).withColumn("oil_price", F.lit(50.0))
    stores = spark.createDataFrame([(1, "x", "s", "A", 1)], schemas.STORES)
    days = dim_date(generate_calendar(spark, dt.date(1969, 1, 1), dt.date(1970, 12, 31)))
    loaded = wh.loaded_rows(wh.classify_fact_rows(full, days, wh.load_dim_store(stores, full), wh.load_dim_product(product_seed(spark, [("A", "FMCG", "x", 1, 0)]))))
    assert [r.date_key for r in wh.accepted_rows(loaded).collect()] == [19700101]
    assert [tuple(r)[:1] + (r.reject_reason,) for r in wh.rejected_rows(loaded).collect()] == [(dt.date(1969, 12, 31), "date_out_of_range")]


def test_totals_beyond_ten_trillion(spark, series):
    panel = series({(1, "A"): [9e12, 9e12]})
    full = ft.is_zero_sale(panel)
    stores = spark.createDataFrame([(1, "x", "s", "A", 1)], schemas.STORES)
    with pytest.raises(Exception):
        wh.load_dim_store(stores, full).select(F.col("avg_daily_sales")).collect()  # the mean of a day is still bounded
    assert float(wh.load_dim_store(stores, full).select("total_revenue").first()[0]) == 18e12


def test_a_run_publishes_and_counts(spark, house, tmp_path):
    first = flows.run_etl(house.raw, house, str(tmp_path), "A").first()
    assert (first.rows_extracted, first.rows_transformed, first.rows_loaded, first.errors) == (20, 20, 20, 10)
    assert first.end_time > first.start_time and first.seconds > 0 and first.products_updated == 2 and first.stores_updated == 1
    again = flows.run_etl(house.raw, house, str(tmp_path), "A").first()
    assert (again.rows_loaded, again.stores_updated, again.products_updated) == (20, 0, 0)
    products = VersionedTable(spark, f"{tmp_path}/dim_product")
    assert products.versions() == [1, 2, 3] and products.read(1).where("total_revenue > 0").count() == 0
    assert VersionedTable(spark, f"{tmp_path}/ml_ready", "year").read().select("year").distinct().count() == 2
