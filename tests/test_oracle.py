"""Every registered query with a SQL twin, side by side on the smallest tables."""

import pytest

from testbed.check import compare, connect
from testbed.oracle import ORACLES
from testbed.registry import QUERIES

SF = "/root/testdata/sf0.001"
#: filters that the smallest tables may not meet
MAY_BE_EMPTY = {"q10_reorder_alerts", "cpi_item_monthly", "filter_fmcg_having", "filter_alert_levels", "q04_stockout_hotspots"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_sql(spark, duck, key):
    note = compare(QUERIES[key](spark, SF).toPandas(), duck.execute(ORACLES[key]).df())
    assert note == "" or (note == "both empty" and key in MAY_BE_EMPTY)


#: keys without SQL, the columns that identify a row, and the least number of rows
WITHOUT_SQL = {
    "train_gbt": ([], 1), "predict_gbt": (["store_id", "family", "date"], 1000), "evaluate_gbt": ([], 1),
    "feature_importance": (["feature"], 10), "top_features": (["feature"], 5), "seasonal_forecast": ([], 1000),
    "seasonal_metrics": ([], 1), "model_comparison": ([], 2)}


def test_keys_without_sql_are_listed():
    assert set(QUERIES) - set(ORACLES) == set(WITHOUT_SQL)


@pytest.mark.parametrize("key", sorted(WITHOUT_SQL))
def test_rows_and_keys(spark, key):
    identity, least = WITHOUT_SQL[key]
    got = QUERIES[key](spark, SF).toPandas()
    assert len(got) >= least
    if identity:
        assert not got.duplicated(identity).any() and not got[identity].isna().any().any()
    numbers = got.select_dtypes("number")
    assert numbers.notna().any().all()
    if key == "feature_importance":
        assert got["importance"].between(0, 1).all() and abs(got["importance"].sum() - 1) < 1e-3
