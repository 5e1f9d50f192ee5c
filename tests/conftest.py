import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from shelfline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("shelfline-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Frame of one or more series from {(store, family): [sales, ...]}, one row per day from 2020-01-01."""
    import datetime as dt

    def make(values, start=dt.date(2020, 1, 1)):
        rows = [(s, f, start + dt.timedelta(days=k), float(v)) for (s, f), vs in values.items() for k, v in enumerate(vs)]
        return spark.createDataFrame(rows, "store_id int, family string, date date, sales double")

    return make
