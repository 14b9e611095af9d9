"""Rounding and means that do not depend on the engine or the order of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(38,12)"


def half_up(value: Column, digits: int) -> Column:
    """A double rounded half up in double arithmetic."""
    scale = 10.0**digits
    return F.floor(value * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def half_up_sql(expression: str, digits: int) -> str:
    """The same as SQL text."""
    return f"(floor(CAST({expression} AS DOUBLE) * 1e{digits} + 0.5) / 1e{digits})"


def money(value: Column) -> Column:
    """Decimals of twelve digits behind the point, so that a sum does not depend on the order of its rows."""
    return value.cast(MONEY)


def mean(value: Column) -> Column:
    """Average by way of a decimal sum: exact for values with up to twelve digits behind the point."""
    return F.sum(money(value)).cast("double") / F.count(value)


def mean_sql(expression: str) -> str:
    return f"CAST(sum(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,12))) AS DOUBLE) / count({expression})"
