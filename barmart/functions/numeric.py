"""Division that yields null instead of an ANSI error when the divisor is zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole)


def percent_move(now: Column, base: Column) -> Column:
    """Change from ``base`` to ``now`` in percent of ``base``."""
    return ratio(now - base, base) * 100


def percent_spread(high: Column, low: Column, close: Column) -> Column:
    return ratio(high - low, close) * 100
