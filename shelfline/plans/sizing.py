"""Broadcast only what is known to be small.

A side may be broadcast for one of two reasons: its rows are bounded by the calendar or by a fixed
table in code (``broadcast_bounded``), or the optimizer's size of the table that bounds its rows is
under a limit (``join_dim``). Beyond the limit no hint is given: Spark then shuffles both sides, and
adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024
_GROWTH = 8  # decoded rows against the file size the optimizer reports


def plan_bytes(df: DataFrame) -> int:
    """Size in bytes by the optimizer's statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(bound: DataFrame | None) -> bool:
    return bound is not None and plan_bytes(bound) * _GROWTH <= BROADCAST_LIMIT_BYTES


def join_dim(big: DataFrame, dim: DataFrame, on: str | list[str] | Column, how: str = "inner",
             bound: DataFrame | None = None) -> DataFrame:
    """Join a table to a dimension whose rows are bounded by those of ``bound``."""
    return big.join(F.broadcast(dim) if is_small(bound) else dim, on, how)


def broadcast_bounded(df: DataFrame) -> DataFrame:
    """For sides with at most one row per calendar day, bucket or row of a table fixed in code."""
    return F.broadcast(df)
