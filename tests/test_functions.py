import random

import pandas as pd
from pyspark.sql import functions as F

from shelfline.functions import calendar, lookups, rounding, text


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_round_exact_is_python_round(spark):
    random.seed(1)
    values = [2.675, 2.665, 0.125, 0.375, 1.005, 162.865, -2.675, 0.5, 1.5, 2.5, 0.0, 1e9 + 0.005]
    values += [random.randint(0, 10 ** 6) / 1000 for _ in range(2000)] + [random.uniform(-1e6, 1e6) for _ in range(500)]
    for digits in (0, 1, 2):
        got = [r[0] for r in column(spark, values).select(rounding.round_exact(F.col("v"), digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_round_scaled_is_pandas_round(spark):
    values = [0.25, 0.35, 2.5, 3.5, 2.665, 1.005, 99.95, 0.05] + [k / 1000 for k in range(3000)]
    for digits in (0, 1, 2):
        got = [r[0] for r in column(spark, values).select(rounding.round_scaled(F.col("v"), digits)).collect()]
        assert got == pd.Series(values).round(digits).tolist()


def test_whole_text_is_half_even(spark):
    got = [r[0] for r in column(spark, [0.5, 1.5, 2.5, 3.49]).select(rounding.whole_text(F.col("v"))).collect()]
    assert got == [f"{v:.0f}" for v in (0.5, 1.5, 2.5, 3.49)]


def test_title_case_matches_python(spark):
    words = ["santo domingo", "  el-carmen", "O'NEIL st", "nation_7", "", "ñandú azul", None]
    got = [r[0] for r in column(spark, words, "string").select(text.title_case(F.col("v"))).collect()]
    assert got == [w if w is None else w.title() for w in words]


def test_contains_text_null_is_zero(spark):
    got = [r[0] for r in column(spark, ["National", "REGIONAL", "international", None], "string")
           .select(text.contains_text(F.col("v"), "national")).collect()]
    assert got == [1, 0, 1, 0]


def test_lookup_defaults(spark):
    frame = column(spark, ["A", "E", "Z", None], "string")
    assert [r[0] for r in frame.select(lookups.lookup(F.col("v"), lookups.SIZE_BY_STORE_TYPE)).collect()] == [
        "Large", "Medium-Small", None, None]
    assert [r[0] for r in frame.select(lookups.lookup(F.col("v"), lookups.CODE_BY_STORE_TYPE, 0)).collect()] == [5, 2, 0, 0]


def test_date_parts_match_pandas(spark):
    days = pd.date_range("2014-12-20", "2017-01-10")
    frame = spark.createDataFrame([(d.date(),) for d in days], "d date")
    got = frame.select("d", *[c.alias(n) for n, c in calendar.date_parts(F.col("d")).items()]).toPandas().sort_values("d")
    want = {"year": days.year, "month": days.month, "day_of_week": days.dayofweek, "day_of_month": days.day,
            "week_of_year": days.isocalendar().week, "quarter": days.quarter, "day_of_year": days.dayofyear,
            "is_weekend": (days.dayofweek >= 5).astype(int), "is_month_start": days.is_month_start.astype(int),
            "is_month_end": days.is_month_end.astype(int)}
    for name, values in want.items():
        assert got[name].tolist() == list(values), name


def test_season_flags_at_borders(spark):
    frame = spark.createDataFrame([("2016-04-14",), ("2016-04-15",), ("2016-06-30",), ("2016-03-01",), ("2016-12-25",)],
                                  "d string").withColumn("d", F.to_date("d"))
    rows = [r.asDict() for r in frame.select(*[c.alias(n) for n, c in calendar.season_parts(F.col("d")).items()]).collect()]
    assert [r["is_eid_preparation"] for r in rows] == [0, 1, 1, 0, 0]
    assert [r["is_ramadan_period"] for r in rows] == [1, 1, 0, 1, 0]
    assert [r["is_wedding_season"] for r in rows] == [0, 0, 0, 0, 1]
    assert [r["is_end_of_month"] for r in rows] == [0, 0, 1, 0, 1]
    assert [r["is_payday_week"] for r in rows] == [0, 0, 0, 1, 0]
