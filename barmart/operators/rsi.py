"""Relative strength index from exponentially weighted gains and losses, in windows only.

The weights are those of an exponential mean with centre of mass 13: a change that lies
``a`` rows back weighs (13/14)^a. The normalising sum is the same for gains and losses
and cancels, so ``rsi = 100 * G / (G + L)`` with G and L the weighted sums.

A running sum of ``gain * (14/13)^position`` yields G up to a factor that cancels as
well, but it overflows near row 9,500. Positions therefore restart every ``SPAN`` rows;
the end value of the span before, scaled by (13/14)^SPAN, is added. Anything older
weighs less than 1e-130 of the current change.

That holds at rows whose close did change. Everywhere else (unchanged or missing close)
G and L shrink by the same factor and the index keeps its last value, which is carried
forward without a limit on the gap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.functions.numeric import ratio
from barmart.operators.series import BLOCK, CORE, along, calendar_bounded, cut_series, refuse_names, total_order
from barmart.schemas import Bars

SPAN_BITS = 12
SPAN = 1 << SPAN_BITS
DECAY = 13.0 / 14.0
MIN_CHANGES = 14
NEUTRAL = 50.0

_SEEN, _HELD = "_changes_seen", "_held_index"
_WORK = ["_row", "_change", "_span", "_up", "_down", "_span_end"]


def seed_columns(part: list[str], bars: Bars) -> dict[str, Column]:
    """Row number and change of the close: what ``index_parts`` starts from."""
    close = F.nanvl(F.col(bars.close).cast("double"), F.lit(None).cast("double"))
    series = along(part, bars)
    return {"_row": F.row_number().over(series) - 1, "_change": close - F.lag(close).over(series)}


def add_rsi(
    df: DataFrame, bars: Bars = Bars(), name: str = "rsi_14", block_rows: int | None = None, unique: bool | None = None
) -> DataFrame:
    """``unique``: see ``total_order``; by default it is measured whether rows share a place of their series."""
    bars = total_order(df, bars, unique)

    def parts(rows: DataFrame, part: list[str]) -> DataFrame:
        return index_parts(rows.withColumns(seed_columns(part, bars)), part, bars)

    return with_index(df, bars, parts, name, block_rows)


def with_index(
    df: DataFrame, bars: Bars, parts: Callable[[DataFrame, list[str]], DataFrame], name: str, block_rows: int | None = None
) -> DataFrame:
    """Run ``parts`` (which must end in ``index_parts``) per series, cut into blocks where needed.

    What a block holds for the next ones is computed from key, order and close alone, and only for
    series of several blocks, so the features of the rows are evaluated once.
    """
    refuse_names(df, [*_WORK, _SEEN, _HELD])
    if calendar_bounded(df, bars):
        return settle_rsi(parts(df, [bars.key]), name)
    part = [bars.key, BLOCK]
    blocks = parts(cut_series(df, bars, SPAN, block_rows), part)
    narrow = df.select(bars.key, *bars.order, *({bars.close} - {*bars.order}))
    slim = cut_series(narrow, bars, SPAN, block_rows, only_long=True)
    ends = block_ends(slim.withColumns(seed_columns(part, bars)), part)
    return settle_rsi(join_earlier_blocks(blocks, ends, bars), name).filter(CORE).drop(BLOCK, CORE)


def index_parts(df: DataFrame, part: list[str], bars: Bars) -> DataFrame:
    """Add the number of changes seen so far and the index held at the last real change.

    Expects the seed columns. In a cut series both count core rows only: history rows
    lack their own history.
    """
    core = F.col(CORE) if CORE in df.columns else F.lit(True)
    stepped = df.withColumn("_span", F.shiftright("_row", SPAN_BITS))

    # From here every window sorts by (part, span, time), so one sort serves them all.
    place = F.col("_row").bitwiseAND(SPAN - 1)
    growth = F.pow(F.lit(1 / DECAY), place)
    so_far = Window.partitionBy(*part, "_span").orderBy(*bars.order).rowsBetween(Window.unboundedPreceding, 0)
    change = F.col("_change")
    summed = stepped.withColumns(
        {
            "_up": F.coalesce(F.sum(F.greatest(change, F.lit(0.0)) * growth).over(so_far), F.lit(0.0)),
            "_down": F.coalesce(F.sum(F.greatest(-change, F.lit(0.0)) * growth).over(so_far), F.lit(0.0)),
        }
    )
    rows = Window.partitionBy(*part).orderBy("_span", *bars.order)
    earlier = rows.rowsBetween(Window.unboundedPreceding, -1)
    until_now = rows.rowsBetween(Window.unboundedPreceding, 0)
    end_of_span = F.when(place == SPAN - 1, F.struct("_up", "_down"))
    carried = summed.withColumn("_span_end", F.last(end_of_span, ignorenulls=True).over(earlier))

    fade = DECAY**SPAN
    up = F.col("_up") + F.coalesce(F.col("_span_end._up") * fade, F.lit(0.0))
    down = F.col("_down") + F.coalesce(F.col("_span_end._down") * fade, F.lit(0.0))
    index = F.when(core & (change != 0), 100 * ratio(up, up + down))
    return carried.withColumns(
        {
            _SEEN: F.count(F.when(core, change)).over(until_now),
            _HELD: F.last(index, ignorenulls=True).over(until_now),
        }
    ).drop(*_WORK)


def block_ends(df: DataFrame, part: list[str]) -> DataFrame:
    """What each block has seen and holds after its last row: ``index_parts`` there, from sums by span.

    After the last change of a block nothing is added to the sums, so those of its span give the index held.
    Expects the seed columns.
    """
    core, change = F.col(CORE), F.col("_change")
    growth = F.pow(F.lit(1 / DECAY), F.col("_row").bitwiseAND(SPAN - 1))
    by_span = df.groupBy(*part, F.shiftright("_row", SPAN_BITS).alias("_span")).agg(
        F.coalesce(F.sum(F.greatest(change, F.lit(0.0)) * growth), F.lit(0.0)).alias("_up"),
        F.coalesce(F.sum(F.greatest(-change, F.lit(0.0)) * growth), F.lit(0.0)).alias("_down"),
        F.count(F.when(core, change)).alias("_changes"),
        F.count(F.when(core & (change != 0), change)).alias("_moves"),
    )
    spans = Window.partitionBy(*part).orderBy("_span")
    up, down = (F.col(c) + F.lag(c, 1, 0.0).over(spans) * DECAY**SPAN for c in ("_up", "_down"))
    index = by_span.withColumn("_index", F.when(F.col("_moves") > 0, 100 * ratio(up, up + down)))
    return index.groupBy(*part).agg(
        F.sum("_changes").alias("_block_seen"),
        F.max_by("_index", F.when(F.col("_index").isNotNull(), F.col("_span"))).alias("_block_held"),
    )


def join_earlier_blocks(parts: DataFrame, per_block: DataFrame, bars: Bars) -> DataFrame:
    """Add to each block what the blocks before it have seen, by the ends of the blocks (one small row each)."""
    before = Window.partitionBy(bars.key).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_block.select(
        bars.key,
        BLOCK,
        F.sum("_block_seen").over(before).alias("_seen_before"),
        F.last("_block_held", ignorenulls=True).over(before).alias("_held_before"),
    )
    return (
        parts.join(earlier, [bars.key, BLOCK], "left")
        .withColumns(
            {
                _SEEN: F.col(_SEEN) + F.coalesce("_seen_before", F.lit(0)),
                _HELD: F.coalesce(_HELD, "_held_before"),
            }
        )
        .drop("_seen_before", "_held_before")
    )


def settle_rsi(df: DataFrame, name: str) -> DataFrame:
    """Neutral until 14 changes are known, and as long as the close never moved."""
    value = F.when(F.col(_SEEN) >= MIN_CHANGES, F.coalesce(_HELD, F.lit(NEUTRAL))).otherwise(F.lit(NEUTRAL))
    return df.withColumn(name, value).drop(_SEEN, _HELD)
