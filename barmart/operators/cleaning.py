"""Bronze steps: set rejected rows aside, keep the newest copy of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.schemas import Bars

NULL_KEY = "null_key_field"
REQUIRED = ("coin_id", "timestamp_ms", "event_ts")


def lacks_key(required: tuple[str, ...] = REQUIRED) -> Column:
    rejected = F.lit(False)
    for name in required:
        rejected = rejected | F.col(name).isNull()
    return rejected


def rejected_rows(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    return df.filter(lacks_key(required)).withColumn("_quarantine_reason", F.lit(NULL_KEY))


def accepted_rows(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    return df.filter(~lacks_key(required))


def newest_per(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per key: the one largest in ``newest``, ties broken by all other columns.

    The total order makes the survivor independent of the partition layout. Spark limits
    each group to one row before the exchange (WindowGroupLimit), so a key with very many
    copies sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest and not c.startswith("_")]
    order = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in [*newest, *rest]])
    return df.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") == 1).drop("_nth")


def latest_of(name: str, order: str) -> Column:
    """The known value latest in ``order``; equal places are told apart by the value."""
    return F.max_by(name, F.when(F.col(name).isNotNull(), F.struct(order, name)))


def daily_bars(df: DataFrame, bars: Bars, order: str) -> DataFrame:
    """One bar of all rows of a (key, time): earliest known open, extremes, latest known close.

    All other columns, lineage included, are those of the latest row. Aggregated before the
    exchange, so a day with very many rows sends one row per task.
    """
    on = [bars.key, bars.time]
    rest = [c for c in df.columns if c not in (*on, *bars.prices)]
    opened = F.min_by(bars.open, F.when(F.col(bars.open).isNotNull(), F.struct(order, bars.open)))
    latest = F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order]))
    merged = df.groupBy(*on).agg(
        opened.alias(bars.open),
        F.max(bars.high).alias(bars.high),
        F.min(bars.low).alias(bars.low),
        latest_of(bars.close, order).alias(bars.close),
        latest.alias("_latest"),
    )
    return merged.select(*[F.col(f"_latest.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])
