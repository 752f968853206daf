"""Column roles and the fixed schemas of the raw, report and lookup tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Bars:
    """Which column of a bar table plays which role.

    ``time`` may be a DATE (one bar per key and day) or a timestamp (any number
    of bars per key); see ``operators/series.py`` for what that changes. ``ties`` order the
    rows of one key and time, where there may be several. ``short``: no key has more rows
    than a task may hold at once, as ``short_series`` measures.
    """

    key: str = "coin_id"
    time: str = "event_date"
    open: str = "open"
    high: str = "high"
    low: str = "low"
    close: str = "close"
    volume: str = "total_volume_usd"
    size: str = "market_cap_usd"
    ties: tuple[str, ...] = ()
    short: bool = False

    @property
    def order(self) -> tuple[str, ...]:
        return self.time, *self.ties

    @property
    def prices(self) -> tuple[str, str, str, str]:
        return self.open, self.high, self.low, self.close


MALFORMED = "_corrupt_record"


def _raw(*measures: str) -> T.StructType:
    schema = T.StructType().add("coin_id", T.StringType()).add("timestamp_ms", T.LongType())
    for name in measures:
        schema = schema.add(name, T.DoubleType())
    return schema.add(MALFORMED, T.StringType())


RAW_OHLC = _raw("open", "high", "low", "close")
RAW_MARKET = _raw("price_usd", "market_cap_usd", "total_volume_usd")

OHLC_PAYLOAD = T.ArrayType(T.ArrayType(T.StringType()))
MARKET_PAYLOAD = T.StructType(
    [T.StructField(name, OHLC_PAYLOAD) for name in ("prices", "market_caps", "total_volumes")]
)

QUALITY_REPORT = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("details", T.StringType()),
        T.StructField("run_ts", T.StringType()),
    ]
)

LOOKUP = T.StructType(
    [
        T.StructField("coin_id", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("launch_year", T.IntegerType()),
    ]
)
