"""Half-even rounding that gives the same digits as pandas and as Python's round()."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = 134217729.0  # 2**27 + 1 halves a double's mantissa


def round_scaled(value: Column, digits: int = 0) -> Column:
    """Scale, round half to even, unscale: the digits a pandas Series.round gives."""
    power = float(10 ** digits)
    return F.rint(value * power) / power


def round_exact(value: Column, digits: int = 0) -> Column:
    """Round the exact binary value half to even, as Python's round(float, n) does.

    A scaled product that lands on .5 is a true tie only if the multiplication lost nothing;
    the sign of the lost part decides otherwise.
    """
    power = float(10 ** digits)
    product = value * power
    big = value * _SPLIT
    high = big - (big - value)
    lost = (high * power - product) + (value - high) * power
    below = F.floor(product).cast("double")
    half = (product - below) == 0.5
    return (F.when(half & (lost > 0), below + 1.0).when(half & (lost < 0), below)
            .otherwise(F.rint(product))) / power


def to_decimal(value: Column, kind: str, digits: int = 2) -> Column:
    return round_exact(value.cast("double"), digits).cast(kind)


def whole_text(value: Column) -> Column:
    """Number as text without decimals, half-even."""
    return F.rint(value).cast("bigint").cast("string")
