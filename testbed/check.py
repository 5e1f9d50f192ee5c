"""Run registered queries against their SQL twins: python -m testbed.check SF_DIR [key ...]."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from shelfline.session import build_session
from testbed.oracle import ORACLES
from testbed.registry import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, numbers as float, the rest as text, rows sorted."""
    out = {}
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_numeric_dtype(column) or pd.api.types.is_bool_dtype(column):
            out[name] = column.astype("float64")
        else:
            out[name] = column.where(column.notna(), None).map(lambda v: "(null)" if v is None else str(v))
    table = pd.DataFrame(out)
    return table.sort_values(list(table.columns), ignore_index=True) if len(table.columns) else table


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    a, b = plain(spark_frame), plain(sql_frame)
    if list(a.columns) != list(b.columns):
        return f"columns differ: spark only {set(a) - set(b)}, sql only {set(b) - set(a)}"
    if len(a) != len(b):
        return f"row counts differ: {len(a)} and {len(b)}"
    for name in a.columns:
        same = (a[name] == b[name]) | (a[name].isna() & b[name].isna())
        if not same.all():
            at = int((~same).to_numpy().argmax())
            return f"values differ in {name} ({int((~same).sum())} rows): {a[name][at]!r} and {b[name][at]!r}"
    return "" if len(a) else "both empty"


def main(sf_dir: str, keys: list[str]) -> int:
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key in keys or QUERIES:
        started = time.time()
        try:
            got = QUERIES[key](spark, sf_dir).toPandas()
            mid = time.time()
            note = compare(got, con.execute(ORACLES[key]).df()) if key in ORACLES else f"rows only: {len(got)}"
        except Exception as error:
            mid, note = time.time(), f"{type(error).__name__}: {str(error)[:600]}"
        failed = bool(note) and not note.startswith("rows only")
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {key:30s} spark {mid - started:6.2f}s total {time.time() - started:6.2f}s {note}",
              flush=True)
    print(f"{bad} failed of {len(keys or QUERIES)}; keys without SQL: {sorted(set(QUERIES) - set(ORACLES))}")
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1], sys.argv[2:]), 1))
