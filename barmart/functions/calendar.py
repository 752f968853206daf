"""Time derivations: epoch milliseconds, calendar columns, ISO weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999 (fixed values).
FIRST_MS = -62135596800000
LAST_MS = 253402300799999


def from_epoch_ms(ms: Column) -> Column:
    """Timestamp of an epoch-millisecond column; null where it lies outside years 1 to 9999."""
    return F.timestamp_millis(F.when(ms.between(FIRST_MS, LAST_MS), ms))


def with_calendar(df: DataFrame, ms: str = "timestamp_ms") -> DataFrame:
    """Add event_ts, event_date, event_year and event_month (session time zone)."""
    ts = from_epoch_ms(F.col(ms))
    return df.withColumns(
        {
            "event_ts": ts,
            "event_date": F.to_date(ts),
            "event_year": F.year(ts),
            "event_month": F.month(ts),
        }
    )


def iso_year(day: Column) -> Column:
    """Year the ISO week belongs to (2024-12-30 is in week 1 of 2025)."""
    return F.extract(F.lit("YEAROFWEEK"), day)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)
