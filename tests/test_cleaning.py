import datetime as dt

import pytest

from shelfline.operators import cleaning as cl, merging as mg
from shelfline.plans.staging import WrittenTables
from shelfline.schemas import HOLIDAYS, OIL, SALES, STORES

D = dt.date


def sales(spark, rows):
    return spark.createDataFrame(rows, SALES)


def test_clean_sales_steps(spark):
    rows = [(D(2020, 1, 1 + k), 1, " dairy ", float(10 * k), k % 3) for k in range(10)]
    out = cl.clean_sales(sales(spark, rows + rows[:4])).orderBy("date").collect()
    assert len(out) == 10
    assert {r.family for r in out} == {"DAIRY"}
    assert [r.onpromotion for r in out] == [int(k % 3 > 0) for k in range(10)]
    assert [r.onpromotion_count for r in out] == [k % 3 for k in range(10)]
    assert out[-1].sales == pytest.approx(90 - 0.045 * 10)  # linear 99.5 % quantile of 0..90
    assert [r.is_anomaly_day for r in out] == [1] + [0] * 9


def test_sales_report_reads_the_table_once(spark, tmp_path):
    rows = [(D(2020, 1, 1 + k), 1, "A", float(10 * k), k % 3) for k in range(10)]
    extra = [rows[3], rows[3], rows[0], (None, 1, "A", 7.0, 0), (None, 1, "A", 7.0, 0), (D(2020, 1, 11), 1, "A", -4.0, 1)]
    sales(spark, rows + extra).write.parquet(str(tmp_path / "raw_table"))
    raw, asked = spark.read.schema(SALES).parquet(str(tmp_path / "raw_table")), []
    written = WrittenTables(spark, str(tmp_path / "steps"))

    def stage(df, name):
        asked.append((name, any("raw_table" in path for path in df.inputFiles())))
        return written(df, name)

    report = cl.sales_report(raw, stage)
    assert asked == [("sales_counted", True), ("sales_cap", False), ("anomaly_count", False)]
    assert report.inputFiles() and not any("raw_table" in path for path in report.inputFiles())
    got = {r.metric: r.value for r in report.collect()}
    assert got == {r.metric: r.value for r in cl.sales_report(raw).collect()}
    assert got == {"initial_rows": 16, "duplicates_removed": 4, "final_rows": 11, "outliers_capped": 1,
                   "outlier_threshold": pytest.approx(round(80 + 0.95 * 10, 2)), "zero_sales_kept": 2,
                   "actual_promo_rate": round(100 * 7 / 11, 1), "anomaly_days_flagged": 0}


def test_sales_report_of_nothing(spark):
    got = {r.metric: r.value for r in cl.sales_report(sales(spark, [])).collect()}
    assert got["initial_rows"] == got["duplicates_removed"] == got["final_rows"] == got["outliers_capped"] == 0
    assert got["outlier_threshold"] is None and got["anomaly_days_flagged"] == 0


def test_clip_keeps_null(spark):
    frame = spark.createDataFrame([(-1.0,), (2.0,), (None,)], "sales double")
    assert [r.sales for r in cl.clip_negative(frame).collect()] == [0.0, 2.0, None]


def test_no_anomaly_column_is_zero(spark):
    out = cl.flag_anomaly_days(sales(spark, [(D(2020, 1, 1), 1, "A", 5.0, 0), (D(2020, 1, 2), 1, "A", 5.0, 0)]))
    assert [r.is_anomaly_day for r in out.collect()] == [0, 0]


def test_bad_dates_are_dropped(spark):
    frame = spark.createDataFrame([("2020-01-31",), ("2020-02-31",), ("x",), (None,)], "date string")
    assert [r.date for r in cl.coerce_dates(frame).collect()] == [D(2020, 1, 31)]


def test_clean_stores(spark):
    rows = [(1, " quito ", "PICHINCHA", " a", 3), (1, " quito ", "PICHINCHA", " a", 9), (2, "el-carmen", "x", "Z", 1)]
    out = {r.store_nbr: r for r in cl.clean_stores(spark.createDataFrame(rows, STORES)).collect()}
    assert (out[1].city, out[1].state, out[1].type, out[1].store_size, out[1].cluster) == ("Quito", "Pichincha", "A", "Large", 3)
    assert out[2].city == "El-Carmen" and out[2].store_size is None


def test_holiday_flags_two_events_one_day(spark):
    rows = [("2020-01-01", " Holiday", "National", " new year ", False), ("2020-01-01", "Event", None, "e", False),
            ("2020-01-02", "Event", "Local", "e", False), ("2020-01-03", "Event", "National", "moved", True)]
    clean = cl.clean_holidays(spark.createDataFrame(rows, HOLIDAYS))
    panel = sales(spark, [(D(2020, 1, k), 1, "A", 1.0, 0) for k in range(1, 5)])
    out = mg.join_holiday_flags(panel, clean).orderBy("date").collect()
    assert [(r.is_holiday, r.is_national_holiday) for r in out] == [(1, 1), (1, 0), (0, 0), (0, 0)]


def test_price_fills_and_asof(spark):
    rows = [(D(2020, 1, 3), None), (D(2020, 1, 4), 10.0), (D(2020, 1, 5), None), (D(2020, 1, 9), 20.0), (D(2020, 1, 10), None)]
    oil = spark.createDataFrame(rows, OIL)
    filled = [r.dcoilwtico for r in cl.clean_oil(oil).orderBy("date").collect()]
    assert filled == [10.0, 10.0, 10.0, 20.0, 20.0]
    days = spark.createDataFrame([(D(2020, 1, k),) for k in (1, 3, 4, 7, 9, 10, 15)], "date date")
    out = [r.dcoilwtico for r in mg.join_oil_asof(days, oil).orderBy("date").collect()]
    assert out == [10.0, 10.0, 10.0, 10.0, 20.0, 20.0, 20.0]


def test_critical_nulls(spark):
    frame = spark.createDataFrame([(None, None, None, None)], "date date, store_id int, family string, sales double")
    row = cl.fill_critical_nulls(frame).first()
    assert (row.date, row.store_id, row.family, row.sales) == (None, 0, "Unknown", 0.0)
    assert cl.critical_null_counts(frame).first().sales == 1


def test_empty_inputs_keep_their_schema(spark):
    empty = [spark.createDataFrame([], s) for s in (SALES, STORES, HOLIDAYS, OIL)]
    merged = mg.merge_all(cl.clean_sales(empty[0]), cl.clean_stores(empty[1]), cl.clean_holidays(empty[2]),
                          cl.clean_oil(empty[3]))
    assert merged.count() == 0
    assert {"store_id", "oil_price", "store_type", "is_national_holiday"} <= set(merged.columns)


def test_row_order_does_not_matter(spark):
    rows = [(D(2020, 1, 1 + k % 20), 1 + k // 20, "A", float(k * 7 % 13), k % 2) for k in range(60)]
    one = cl.clean_sales(sales(spark, rows)).toPandas().sort_values(["store_nbr", "date"], ignore_index=True)
    two = cl.clean_sales(sales(spark, rows[::-1]).repartition(7)).toPandas().sort_values(["store_nbr", "date"], ignore_index=True)
    assert one.equals(two)
