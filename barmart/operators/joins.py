"""Equi joins of bar tables with each other and with a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmart.operators.cleaning import daily_bars, latest_of
from barmart.schemas import Bars

BROADCAST_BYTES = 8 * 1024 * 1024


def join_bars(
    prices: DataFrame,
    measures: DataFrame,
    bars: Bars = Bars(),
    days: str = "merged",
    order: str = "timestamp_ms",
    total_volume: bool = False,
) -> DataFrame:
    """Inner join on (key, time); the right side contributes size and volume only.

    ``merged`` makes one true bar of all rows of a (key, time) on both sides first: earliest
    open, extremes, latest close; latest size and volume (``total_volume``: the day's sum).
    Every row counts, nothing fans out and no join key is hot. Rows are in the order of
    ``order``; its exchange by (key, time) is the one the join needs.

    ``all`` is the plain join: every price row meets every measure row of its (key, time), so
    the rows of a day are multiplied.
    """
    on = [bars.key, bars.time]
    wanted = [*on, bars.size, bars.volume]
    if days not in ("merged", "all"):
        raise ValueError(f"unknown days {days!r}")
    if days == "merged":
        prices = daily_bars(prices, bars, order)
        volume = F.sum(bars.volume) if total_volume else latest_of(bars.volume, order)
        measures = measures.groupBy(*on).agg(latest_of(bars.size, order).alias(bars.size), volume.alias(bars.volume))
    return prices.join(measures.select(*wanted), on, "inner")


def fits_broadcast(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the lookup (one aggregate over it): is its text form within ``limit`` bytes?"""
    size = F.sum(F.octet_length(F.to_json(F.struct(*lookup.columns))))
    return (lookup.agg(size.alias("bytes")).first()["bytes"] or 0) <= limit


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "left",
    strategy: str = "measured",
) -> DataFrame:
    """Join a lookup on its key.

    ``measured`` broadcasts the lookup if it is small enough and otherwise sort-merges;
    ``merge`` always sort-merges. A hot key on the bar side of a sort-merge join is split
    by Spark's adaptive skew join, as the lookup side is the one repeated.
    """
    if strategy == "measured":
        strategy = "broadcast" if fits_broadcast(lookup) else "merge"
    if strategy not in ("broadcast", "merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.join(lookup.hint(strategy), on, how)
