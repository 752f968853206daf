"""Per-series features: rolling means and deviation, volume-weighted price, momentum, ranking.

Every frame counts rows, not days, and yields a value from the first row on. The
``*_columns`` builders return name -> Column for given partition columns, so that any
mix of them can share one window node, one sort and one exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmart.functions.numeric import percent_move, percent_spread, ratio
from barmart.functions.regime import regime_label
from barmart.operators.ranking import rank_values
from barmart.operators.rsi import index_parts, seed_columns, with_index
from barmart.operators.series import along, calendar_bounded, over_series, tied, total_order, trailing
from barmart.schemas import Bars

MEAN_ROWS = (7, 14, 30)
DEVIATION_ROWS = 30
VWAP_ROWS = 7
MOVE_ROWS = (1, 7)
BAND_ROWS = 20
BAND_WIDTH = 2.0
VOLATILITY_ROWS = 30
PERIODS_PER_YEAR = 365
LONGEST_FRAME = 30
RANK_NAMES = {"rank": "rank_by_mcap", "dense_rank": "dense_rank_by_mcap", "percent_rank": "pct_rank_by_mcap"}

Columns = dict[str, Column]


def rolling_columns(part: list[str], bars: Bars) -> Columns:
    return {f"avg_close_{n}d": F.avg(bars.close).over(trailing(part, bars, n)) for n in MEAN_ROWS}


def deviation_columns(part: list[str], bars: Bars) -> Columns:
    frame = trailing(part, bars, DEVIATION_ROWS)
    return {f"stddev_close_{DEVIATION_ROWS}d": F.stddev_samp(bars.close).over(frame)}


def vwap_columns(part: list[str], bars: Bars) -> Columns:
    frame = trailing(part, bars, VWAP_ROWS)
    turnover = F.sum(F.col(bars.close) * F.col(bars.volume)).over(frame)
    return {f"vwap_{VWAP_ROWS}d": ratio(turnover, F.sum(bars.volume).over(frame))}


def momentum_columns(part: list[str], bars: Bars) -> Columns:
    close = F.col(bars.close)
    moves = {f"pct_change_{n}d": percent_move(close, F.lag(close, n).over(along(part, bars))) for n in MOVE_ROWS}
    return moves | {"high_low_spread_pct": percent_spread(F.col(bars.high), F.col(bars.low), close)}


def band_columns(part: list[str], bars: Bars) -> Columns:
    """Annualised volatility of the daily move, and the 20-row mean and deviation of the close."""
    year = math.sqrt(PERIODS_PER_YEAR)
    frame = trailing(part, bars, BAND_ROWS)
    return {
        "annualized_vol_pct": F.stddev_samp("pct_change_1d").over(trailing(part, bars, VOLATILITY_ROWS)) * year,
        "bb_sma_20": F.avg(bars.close).over(frame),
        "bb_stddev_20": F.stddev_samp(bars.close).over(frame),
    }


def _adder(*builders):
    def add(
        df: DataFrame,
        bars: Bars = Bars(),
        block_rows: int | None = None,
        unique: bool | None = None,
        places_from: DataFrame | None = None,
    ) -> DataFrame:
        bars = total_order(df, bars, unique)

        def step(rows: DataFrame, part: list[str]) -> DataFrame:
            return rows.withColumns({k: c for build in builders for k, c in build(part, bars).items()})

        return over_series(df, bars, LONGEST_FRAME, step, block_rows, places_from)

    return add


add_rolling_means = _adder(rolling_columns)
add_rolling_deviation = _adder(deviation_columns)
add_rolling = _adder(rolling_columns, deviation_columns)
add_vwap = _adder(vwap_columns)
add_momentum = _adder(momentum_columns)


def add_bands(df: DataFrame, bars: Bars = Bars(), unique: bool | None = None) -> DataFrame:
    """Volatility and Bollinger columns; expects ``pct_change_1d``. A flat series has null %B."""
    shift = BAND_WIDTH * F.col("bb_stddev_20")
    upper, lower = F.col("bb_upper"), F.col("bb_lower")
    return (
        _adder(band_columns)(df, bars, unique=unique)
        .withColumns({"bb_upper": F.col("bb_sma_20") + shift, "bb_lower": F.col("bb_sma_20") - shift})
        .withColumns(
            {
                "bb_pct_b": ratio(F.col(bars.close) - lower, upper - lower),
                "bb_bandwidth": ratio(upper - lower, F.col("bb_sma_20")),
            }
        )
    )


def add_daily_ranking(
    df: DataFrame, bars: Bars = Bars(), dates_fit: bool = False, values_from: DataFrame | None = None, date: str | None = None
) -> DataFrame:
    """Rank, dense rank and percent rank by size, largest first, among the bars of one date (``date``, or the time)."""
    return rank_values(df, [date or bars.time], bars.size, RANK_NAMES, dates_fit, values_from)


def add_regime(df: DataFrame, name: str = "market_regime") -> DataFrame:
    return df.withColumn(name, regime_label(F.col("pct_change_7d"), F.col("high_low_spread_pct"), F.col("rsi_14")))


def enrich_days(
    df: DataFrame, bars: Bars = Bars(), stamp: str = "event_ts", dates_fit: bool = False, ranged: bool = False
) -> DataFrame:
    """All features where a key and day may have several rows: series run along the time stamp, ranks are those of the day.

    Rows of one time stamp, which the plain join makes of several measures a day, are put in order by all their columns.
    ``dates_fit``, ``ranged``: as in ``enrich``.
    """
    return enrich(df, tied(df, bars, stamp), dates_fit, date=bars.time, unique=True, ranged=ranged)


def enrich(
    df: DataFrame,
    bars: Bars = Bars(),
    dates_fit: bool = False,
    block_rows: int | None = None,
    date: str | None = None,
    unique: bool | None = None,
    ranged: bool = False,
) -> DataFrame:
    """All features of a bar table: one exchange by key for the series, and the ranking by date.

    ``dates_fit``: every date is known to hold few enough bars for one task (``groups_fit``). ``block_rows``: rows of
    a block where series are cut. ``date``: the column that rankings go by, if not the time. ``unique``: no two rows share a
    place of a series; by default that is measured, and if some do, all columns of the rows put them in order.
    ``ranged``: deal uncut series out by ranges of the key, so that a sort by key and time needs no exchange of its own.
    """
    bars = total_order(df, bars, unique)
    builders = (rolling_columns, deviation_columns, vwap_columns, momentum_columns, seed_columns)

    def parts(rows: DataFrame, part: list[str]) -> DataFrame:
        framed = rows.withColumns({k: c for build in builders for k, c in build(part, bars).items()})
        return index_parts(framed, part, bars)

    def ranked(rows: DataFrame) -> DataFrame:
        return add_daily_ranking(rows, bars, dates_fit, df, date)

    # Rank while rows are narrow; but a cut series is evaluated twice, so there rank it afterwards.
    if calendar_bounded(df, bars):
        rows = ranked(df)
        enriched = with_index(rows.repartitionByRange(bars.key) if ranged else rows, bars, parts, "rsi_14")
    else:
        enriched = ranked(with_index(df, bars, parts, "rsi_14", block_rows))
    computed = [c for c in enriched.columns if c not in df.columns and c not in RANK_NAMES.values() and c != "rsi_14"]
    return add_regime(enriched.select(*df.columns, *computed, *RANK_NAMES.values(), "rsi_14"))
