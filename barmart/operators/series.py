"""Window computations along the time axis of a key, safe for hot keys.

A frame over ``partitionBy(key).orderBy(time)`` puts a whole series into one task.
Whether that is sound depends on the type of the time column:

* DATE with one bar per key and day (what ``newest_per`` leaves): a series cannot be
  longer than the calendar, some 10^4 rows, however large the table is. The plain
  window is bounded and costs one exchange.
* DATE with several rows for some (key, day): ``total_order`` finds that out and adds tie
  columns, without which the windows would follow the layout; then as a timestamp.
* timestamp: nothing bounds a series, one key may hold a third of the table. The
  series is cut into blocks of ``BLOCK_ROWS`` consecutive rows; each block also
  receives the last ``history`` rows before it, so every ROWS frame that looks back no
  further gives the value it would give on the uncut series. Blocks of one key are
  separate window groups and spread over the cluster. Series known to fit a block
  (``short_series`` measures it) take the plain window.

Blocks begin and end between seconds, so rows needn't be numbered: the places come from counts by (key, hour) and,
within the hour, by second, summed up over these small tables, and only for series longer than a block. Rows of one
(key, second) stay together. Of the whole key only the hourly counts meet in one task, and of an hour its 3,600 counts.
Rows find their block in a broadcast table (``block_pieces``) of some ``PIECES`` rows for every block of a long series.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmart.schemas import Bars

BLOCK = "_block"
CORE = "_core"
BLOCK_ROWS = 65_536
PIECES = 16

Step = Callable[[DataFrame, list[str]], DataFrame]


def along(part: list[str], bars: Bars) -> WindowSpec:
    return Window.partitionBy(*part).orderBy(*bars.order)


def trailing(part: list[str], bars: Bars, rows: int) -> WindowSpec:
    """The current row and the ``rows - 1`` before it."""
    return along(part, bars).rowsBetween(1 - rows, Window.currentRow)


def calendar_bounded(df: DataFrame, bars: Bars) -> bool:
    """Does every series fit a task: by the calendar, or as measured (``short_series``)?"""
    return bars.short or (not bars.ties and isinstance(df.schema[bars.time].dataType, T.DateType))


def short_series(df: DataFrame, bars: Bars = Bars(), block_rows: int | None = None) -> Bars:
    """The roles, marked ``short`` if no series has more rows than a block; one pre-aggregated count."""
    sizes = df.groupBy(bars.key).agg(F.count("*").alias("rows"))
    longest = sizes.agg(F.max("rows")).first()[0] or 0
    return replace(bars, short=longest <= (block_rows or BLOCK_ROWS))


def refuse_names(df: DataFrame, names: list[str]) -> None:
    """Working columns must not overwrite columns of the input."""
    taken = sorted({c.lower() for c in df.columns} & {n.lower() for n in names})
    if taken:
        raise ValueError(f"columns named like working columns: {taken}")


def repeated_places(df: DataFrame, bars: Bars) -> int:
    """How many (key, order) places hold several rows, so that windows have no total order; one aggregate."""
    return _repeated(df, bars).count()


def _repeated(df: DataFrame, bars: Bars) -> DataFrame:
    return df.groupBy(bars.key, *bars.order).agg(F.count("*").alias("_rows")).filter("_rows > 1")


def tied(df: DataFrame, bars: Bars, stamp: str | None = None) -> Bars:
    """Roles under which every row of a series has its place: along ``stamp`` if the table has it (else the time), then by
    size, volume and prices, then by all other columns that can be ordered. Rows that still tie are equal."""
    time = stamp if stamp in df.columns else bars.time
    first = [c for c in (bars.size, bars.volume, *bars.prices) if c in df.columns]
    rest = [c for c, kind in df.dtypes if c not in first and not ("map<" in kind or "variant" in kind)]
    wanted = [c for c in (*bars.ties, *first, *rest) if c not in (bars.key, time)]
    return replace(bars, time=time, ties=tuple(dict.fromkeys(wanted)))


def total_order(df: DataFrame, bars: Bars, unique: bool | None = None, stamp: str | None = None) -> Bars:
    """The roles to run windows by: ``bars`` if every (key, order) place holds one row, otherwise ``tied`` ones.

    That is measured (one aggregate over key and order columns) unless ``unique`` says it is known.
    """
    if unique is None:
        unique = _repeated(df, bars).isEmpty()
    return bars if unique else tied(df, bars, stamp)


def over_series(
    df: DataFrame, bars: Bars, history: int, step: Step, block_rows: int | None = None, places_from: DataFrame | None = None
) -> DataFrame:
    """Apply ``step(df, partition_columns)``, which may look back ``history`` rows; ``places_from``: see ``cut_series``."""
    if calendar_bounded(df, bars):
        return step(df, [bars.key])
    cut = cut_series(df, bars, history, block_rows, places_from)
    return step(cut, [bars.key, BLOCK]).filter(CORE).drop(BLOCK, CORE)


def cut_series(
    df: DataFrame,
    bars: Bars,
    history: int,
    block_rows: int | None = None,
    places_from: DataFrame | None = None,
    only_long: bool = False,
) -> DataFrame:
    """Rows with their block number, plus copies of the rows that serve the next block as history.

    ``_core`` is false on the copies. ``places_from`` may name a cheaper table with the same keys and times to count.
    ``only_long`` leaves out the series that fit one block.
    """
    block_rows = block_rows or BLOCK_ROWS
    if not 0 < history <= block_rows:
        raise ValueError(f"history must lie in 1..{block_rows}")
    refuse_names(df, [BLOCK, CORE, "_hour", "_second", "_rows", "_start", "_low", "_width", "_bucket", "_series", "_of", "_since", "_until"])
    counted = (df if places_from is None else places_from).select(bars.key, _second(bars).alias("_second"))
    longs = long_series(counted, bars, block_rows)
    pieces = block_pieces(counted, longs, bars, history, block_rows)
    how = "inner" if only_long else "left"
    second = F.col("_second")
    spread = df.withColumn("_second", _second(bars)).join(F.broadcast(longs), bars.key, how)
    spread = spread.withColumn("_bucket", F.floor((second - F.col("_low")) / F.col("_width")))
    found = (F.col(bars.key) == F.col("_series")) & (F.col("_bucket") == F.col("_of")) & second.between(F.col("_since"), F.col("_until"))
    return spread.join(F.broadcast(pieces), found, how).select(
        *df.columns, F.coalesce(BLOCK, F.lit(0)).alias(BLOCK), F.coalesce(CORE, F.lit(True)).alias(CORE)
    )


def _second(bars: Bars) -> Column:
    """Second of the time; before all others where it is null, as in the order of a window."""
    return F.coalesce(F.unix_seconds(F.col(bars.time).cast("timestamp")), F.lit(-(1 << 40)))


def long_series(counted: DataFrame, bars: Bars, block_rows: int) -> DataFrame:
    """(key, _low, _width): first second and width of a time bucket of each series longer than a block."""
    sizes = counted.groupBy(bars.key).agg(
        F.count("*").alias("_rows"), F.min("_second").alias("_low"), F.max("_second").alias("_high")
    )
    buckets = F.ceil(F.col("_rows") / block_rows) * PIECES
    width = F.ceil((F.col("_high") - F.col("_low") + 1) / buckets)
    return sizes.filter((F.col("_rows") > block_rows) & F.col(bars.key).isNotNull()).select(bars.key, "_low", width.alias("_width"))


def block_pieces(counted: DataFrame, longs: DataFrame, bars: Bars, history: int, block_rows: int) -> DataFrame:
    """(_series, _of, _since, _until, block, core): which blocks the seconds of a long series go to, by time bucket.

    A second belongs to the block in which its first row falls. It also serves the block that the row after it falls into, and
    the one ``history`` rows further: no block begins between these two, nor between the second and the row after it.
    """
    key = bars.key
    per_second = counted.join(F.broadcast(longs), key).groupBy(key, "_low", "_width", "_second").agg(F.count("*").alias("_rows"))
    per_second = per_second.withColumn("_hour", F.floor(F.col("_second") / 3600))
    per_hour = per_second.groupBy(key, "_hour").agg(F.sum("_rows").alias("_rows"))
    before = Window.partitionBy(key).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = per_hour.select(key, "_hour", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_hour").orderBy("_second").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_start") + F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    starts = per_second.join(hours, [key, "_hour"]).withColumn("_start", start).withColumn("_end", F.col("_start") + F.col("_rows"))
    home, after, last = (F.floor(place / block_rows) for place in (F.col("_start"), F.col("_end"), F.col("_end") + history - 1))
    targets = F.array_distinct(F.array(home, after, last))
    bucket = F.floor((F.col("_second") - F.col("_low")) / F.col("_width"))
    served = starts.select(key, bucket.alias("_of"), "_second", home.alias("_home"), F.explode(targets).alias(BLOCK))
    return (
        served.groupBy(F.col(key).alias("_series"), "_of", BLOCK, (F.col(BLOCK) == F.col("_home")).alias(CORE))
        .agg(F.min("_second").alias("_since"), F.max("_second").alias("_until"))
    )
