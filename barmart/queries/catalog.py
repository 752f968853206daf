"""One query per operator, over whole tables; doubles are rounded for comparison."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barmart.functions.calendar import iso_week, iso_year, with_calendar
from barmart.functions.regime import regime_label
from barmart.operators import cleaning, features, joins, layout, quality
from barmart.operators.ranking import groups_fit, rank_values
from barmart.operators.rsi import add_rsi
from barmart.operators.series import short_series
from barmart.plans import gold
from barmart.plans.layers import Outcome, clean, run
from barmart.queries import inputs
from barmart.schemas import Bars
from barmart.sources.payloads import flatten_ohlc, zip_market
from barmart.sources.tables import read_table, write_table
from barmart.sources.workspace import shared_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Digits kept: fewer where the two engines sum in different orders.
DIGITS = {
    "avg_close_7d": 6, "avg_close_14d": 6, "avg_close_30d": 6, "stddev_close_30d": 3, "vwap_7d": 6,
    "pct_change_1d": 6, "pct_change_7d": 6, "high_low_spread_pct": 6, "pct_rank_by_mcap": 6, "rsi_14": 4,
    "annualized_vol_pct": 3, "bb_sma_20": 6, "bb_upper": 3, "bb_lower": 3, "bb_pct_b": 6, "bb_bandwidth": 6,
    "week_avg_mcap": 6, "weekly_return_pct": 6, "avg_daily_return_pct": 4, "avg_rsi": 4, "avg_spread_pct": 4,
    "regime_pct_of_history": 6, "avg_close": 6, "abs_change": 6, "regime_rate": 6,
}
_SILVER_COLUMNS = [
    "coin_id", "event_date", "open", "high", "low", "close", "market_cap_usd", "total_volume_usd", "avg_close_7d", "avg_close_14d",
    "avg_close_30d", "stddev_close_30d", "vwap_7d", "pct_change_1d", "pct_change_7d", "high_low_spread_pct", "rank_by_mcap",
    "dense_rank_by_mcap", "pct_rank_by_mcap", "rsi_14", "market_regime",
]
BAR_ID = ["coin_id", "event_date"]
# ``unique=True`` below: the input was grouped by (coin_id, event_date), so places of a series needn't be counted.


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _round(name: str) -> Column:
    """To ``DIGITS`` as SQL engines round a double: the nearest whole multiple, halves away from zero.

    ``F.round`` writes every value out in decimal digits, which took about half the time of the last stage of silver. Values with no
    digits to lose, infinite ones and NaN stay as they are. Whole halves less whole ones are the nearest whole number, halves up. That
    is written as short as this because the JVM never compiles a generated method of more than 8,000 bytes: a dozen such columns
    share one with the join or window below them.
    """
    value, scale = F.col(name), 10.0 ** DIGITS[name]
    wide = F.abs(value * scale)
    near = F.floor(wide * 2) - F.floor(wide)
    return F.when(wide < float(1 << 52), F.signum(value) * near / scale).otherwise(value).alias(name)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    kinds = dict(df.dtypes)
    wanted = columns or df.columns
    return df.select(*[c if c not in DIGITS else _round(c) if kinds[c] == "double" else F.round(c, DIGITS[c]).alias(c) for c in wanted])


def _days_fit(spark: SparkSession, sf_dir: str) -> bool:
    """A day has no more supplier bars than line items shipped."""
    return groups_fit(inputs.table(spark, sf_dir, "lineitem"), [F.to_date("l_shipdate")])


def _by_day(lines: DataFrame) -> DataFrame:
    return lines.repartition("event_date")


def _by_bar(lines: DataFrame) -> DataFrame:
    return lines.repartition(*BAR_ID)


def _silver(spark: SparkSession, sf_dir: str, ranged: bool = False) -> DataFrame:
    """Where every day fits a task, its lines make their bars where the bars are ranked."""
    fit = _days_fit(spark, sf_dir)
    bars = inputs.supplier_bars(spark, sf_dir, _by_day if fit else inputs.as_it_lies)
    return features.enrich(bars, dates_fit=fit, unique=True, ranged=ranged)


# Lines that one task sorts and keeps.
TASK_LINES = 500_000


def _series_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver for reports by series that leave out the ranks: ranges of suppliers, of about ``TASK_LINES`` lines whatever the
    table's size, serve the bars, the windows and the order of the report. With a hot supplier, bars come first."""
    lines = inputs.table(spark, sf_dir, "lineitem")
    if not groups_fit(lines, ["l_suppkey"]):
        return _silver(spark, sf_dir, ranged=True)
    parts = max(math.ceil(lines.count() / TASK_LINES), spark.sparkContext.defaultParallelism)
    bars = inputs.supplier_bars(spark, sf_dir, lambda rows: rows.repartitionByRange(parts, "coin_id"))
    # The ranks aren't computed, as nothing reads them.
    return features.enrich(bars, dates_fit=True, unique=True).drop(*features.RANK_NAMES.values())


# --- features ---------------------------------------------------------------------------


@_query
def rolling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_rolling_means(inputs.supplier_bars(spark, sf_dir), unique=True)
    return _rounded(df, *BAR_ID, "close", "avg_close_7d", "avg_close_14d", "avg_close_30d")


@_query
def rolling_stddev(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_rolling_deviation(inputs.supplier_bars(spark, sf_dir), unique=True)
    return _rounded(df, *BAR_ID, "close", "stddev_close_30d")


@_query
def vwap(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_vwap(inputs.gap_bars(spark, sf_dir), unique=True)
    return _rounded(df, *BAR_ID, "close", "total_volume_usd", "vwap_7d")


@_query
def momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_momentum(inputs.gap_bars(spark, sf_dir), unique=True)
    return _rounded(df, *BAR_ID, "close", "pct_change_1d", "pct_change_7d", "high_low_spread_pct")


_RANKED = [*BAR_ID, "market_cap_usd", "rank_by_mcap", "dense_rank_by_mcap", "pct_rank_by_mcap"]


@_query
def daily_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.add_daily_ranking(inputs.supplier_bars(spark, sf_dir)), *_RANKED)


@_query
def daily_rankings_fitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = inputs.supplier_bars(spark, sf_dir)
    return _rounded(features.add_daily_ranking(bars, dates_fit=_days_fit(spark, sf_dir)), *_RANKED)


@_query
def daily_rankings_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.add_daily_ranking(inputs.event_bars(spark, sf_dir)), *_RANKED)


@_query
def rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(add_rsi(inputs.supplier_bars(spark, sf_dir), unique=True), *BAR_ID, "close", "rsi_14")


@_query
def rsi_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(add_rsi(inputs.gap_bars(spark, sf_dir), unique=True), *BAR_ID, "close", "rsi_14")


@_query
def series_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series, cut into small blocks: means, deviation and RSI."""
    series, bars = inputs.flag_series(spark, sf_dir), Bars(time="event_ts", ties=("close",))
    indexed = add_rsi(series, bars, block_rows=5000, unique=True)
    df = features.add_rolling(indexed, bars, block_rows=1000, unique=True, places_from=series)
    stamp = F.col("event_ts").cast("timestamp_ntz").alias("event_ts")
    return _rounded(df, "coin_id", "event_ts", "close", "avg_close_7d", "avg_close_30d", "stddev_close_30d", "rsi_14").withColumn(
        "event_ts", stamp
    )


@_query
def ranks_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks among many distinct values in a narrow range, for which slots are divided."""
    orders = inputs.table(spark, sf_dir, "orders")
    valued = orders.select("o_orderpriority", "o_orderkey", (F.lit(1000.0) + F.col("o_orderkey") / 1_000_000).alias("value"))
    return rank_values(valued, ["o_orderpriority"], "value", {"rank": "value_rank", "dense_rank": "value_dense_rank"})


@_query
def regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_partkey") % 41 - 20).cast("double").alias("p7"),
        F.when(F.col("l_suppkey") % 13 != 0, F.col("l_tax") * 100).alias("spread"),
        (F.col("l_quantity") * 2).alias("rsi"),
    )
    return measured.withColumn("market_regime", regime_label(F.col("p7"), F.col("spread"), F.col("rsi")))


@_query
def abs_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.add_momentum(inputs.supplier_bars(spark, sf_dir), unique=True)
    return _rounded(df.select(*BAR_ID, F.abs("pct_change_1d").alias("abs_change")))


# --- joins ------------------------------------------------------------------------------


@_query
def join_inner_equi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.join_bars(inputs.order_prices(spark, sf_dir), inputs.order_measures(spark, sf_dir), days="all")


@_query
def join_several_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain join, with several rows per key and day on both sides."""
    return joins.join_bars(inputs.line_prices(spark, sf_dir), inputs.line_measures(spark, sf_dir), days="all")


@_query
def join_broadcast_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.attach_lookup(inputs.event_bars(spark, sf_dir), inputs.event_lookup(spark), "coin_id")


@_query
def join_merge_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, lookup = inputs.supplier_bars(spark, sf_dir), inputs.supplier_lookup(spark, sf_dir, in_credit=True)
    return joins.attach_lookup(bars, lookup, "coin_id", strategy="merge").select(*BAR_ID, "close", "ticker", "category")


@_query
def join_lookup_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars, lookup = inputs.supplier_bars(spark, sf_dir), inputs.supplier_lookup(spark, sf_dir)
    return joins.attach_lookup(bars, lookup, "coin_id", "inner").select(*BAR_ID, "close", "ticker", "category")


# --- bronze -----------------------------------------------------------------------------

_RAW = ["coin_id", "timestamp_ms", "close", "_run_id", "event_date", "event_year", "event_month"]


@_query
def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    raw = events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_ms"))
    return with_calendar(raw).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@_query
def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_calendar(inputs.raw_orders(spark, sf_dir))
    return cleaning.rejected_rows(rows).select(*_RAW, "_quarantine_reason")


@_query
def quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.accepted_rows(with_calendar(inputs.raw_orders(spark, sf_dir))).select(*_RAW)


@_query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem")
    return cleaning.newest_per(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@_query
def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(with_calendar(inputs.raw_orders(spark, sf_dir))).select(*_RAW)


def _payload_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"),
        F.col("o_orderkey").cast("string").alias("coin_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"),
        inputs.whole(F.col("o_totalprice")).alias("price"),
        F.col("o_custkey").alias("customer"),
    )


# Bodies that hold no rows: every 17th and every 19th.
_BUSY = '{"status":{"error_code":429}}'
_PAGE = "<html>busy</html>"


def _with_damage(body, damaged=None):
    number = F.col("number")
    out = F.when(number % 17 == 0, F.lit(_BUSY)).when(number % 19 == 0, F.lit(_PAGE))
    return (out if damaged is None else out.when(number % 13 == 0, damaged)).otherwise(body)


@_query
def payload_ohlc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, price = F.col("number"), F.col("price")

    def bar(day: int):
        when = (F.col("ms") + day * 86_400_000).cast("double")
        full = F.array(when, price + day, price + day + 2, price + day - 2, price + day + 1)
        return full if day < 3 else F.when(number % 5 != 0, full).otherwise(F.slice(full, 1, 4))

    length = (number % 4).cast("int")
    body = F.to_json(F.slice(F.array(bar(1), bar(2), bar(3)), F.lit(1), length))
    text = price.cast("long").cast("string")
    damaged = F.concat(F.lit('[["'), F.col("ms").cast("string"), F.lit('",'), text, F.lit(',null,"x",'), text, F.lit('],["soon",1,2,3,4]]'))
    bodies = _payload_orders(spark, sf_dir).select("coin_id", _with_damage(body, damaged).alias("payload"))
    return flatten_ohlc(bodies, ["coin_id"])


@_query
def payload_market_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, price = F.col("number"), F.col("price")

    def points(value, length):
        all_points = [F.array((F.col("ms") + i * 86_400_000).cast("double"), value(i)) for i in (1, 2, 3)]
        return F.slice(F.array(*all_points), F.lit(1), length.cast("int"))

    volumes = points(lambda i: (F.col("customer") + i).cast("double"), F.lit(2))
    body = F.to_json(
        F.struct(
            points(lambda i: price + i, number % 4).alias("prices"),
            points(lambda i: price * i, number % 3 + 1).alias("market_caps"),
            F.when(number % 11 != 0, volumes).alias("total_volumes"),
        )
    )
    bodies = _payload_orders(spark, sf_dir).select("coin_id", _with_damage(body).alias("payload"))
    return zip_market(bodies, ["coin_id"]).withColumn("_body", F.col("_body").isNotNull())


# --- aggregates -------------------------------------------------------------------------


@_query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: inputs.table(spark, sf_dir, name) for name in ("lineitem", "orders", "events")}
    tables["bars"] = inputs.supplier_bars(spark, sf_dir)
    counts = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n, df in tables.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2]).unionAll(counts[3])


@_query
def rows_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.rows_per_key(inputs.supplier_bars(spark, sf_dir), "coin_id")


@_query
def skew_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.rows_per_key(inputs.table(spark, sf_dir, "events"), "event_type")


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in sixteen partitions by customer, three of which stay empty."""
    return inputs.table(spark, sf_dir, "orders").repartitionById(16, (F.col("o_custkey") % 13).cast("int"))


@_query
def rows_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.partition_rows(_dealt(spark, sf_dir))


@_query
def skew_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.partition_skew(_dealt(spark, sf_dir))


@_query
def avg_close_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(inputs.supplier_bars(spark, sf_dir).groupBy("coin_id").agg(F.avg("close").alias("avg_close")))


@_query
def distinct_regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select("market_regime").distinct()


@_query
def filter_partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = inputs.event_bars(spark, sf_dir).filter(F.col("coin_id") == "click")
    return bars.select(*BAR_ID, "open", "high", "low", "close")


@_query
def limit_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).select(*BAR_ID, "close", "market_regime").orderBy(*BAR_ID).limit(10)


# --- silver and gold --------------------------------------------------------------------


@_query
def silver_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = _days_fit(spark, sf_dir)
    lay = _by_bar if fit else inputs.as_it_lies
    joined = joins.join_bars(inputs.supplier_prices(spark, sf_dir, lay), inputs.supplier_measures(spark, sf_dir, lay), days="all")
    return _rounded(features.enrich(joined, dates_fit=fit, unique=True))


@_query
def silver_several_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as the layer run makes it: several rows per key and day on both sides, merged to true daily bars."""
    fit = _days_fit(spark, sf_dir)
    lay = _by_bar if fit else inputs.as_it_lies
    joined = joins.join_bars(inputs.line_prices(spark, sf_dir, lay), inputs.line_measures(spark, sf_dir, lay))
    return _rounded(features.enrich(joined, dates_fit=fit, unique=True).drop("timestamp_ms"))


@_query
def silver_repeated_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with several rows of a key, which nobody told the library of: it finds out and orders them by their columns."""
    bars = inputs.line_bars(spark, sf_dir).drop("event_ts")
    return _rounded(features.enrich(bars, short_series(bars), dates_fit=_days_fit(spark, sf_dir)))


@_query
def silver_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver where the calendar bounds no series and nothing a date: time stamps, and split rankings.

    One count of the keys tells whether a series must be cut; ``series_cut`` cuts long ones.
    """
    bars = inputs.supplier_bars(spark, sf_dir).withColumn("event_date", F.col("event_date").cast("timestamp"))
    return _rounded(features.enrich(bars, short_series(bars), unique=True)).withColumn("event_date", F.to_date("event_date"))


@_query
def silver_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = _days_fit(spark, sf_dir)
    bars = inputs.gap_bars(spark, sf_dir, _by_day if fit else inputs.as_it_lies)
    return _rounded(features.enrich(bars, dates_fit=fit, unique=True))


@_query
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broadcast lookup leaves the ranges that the series lie in, so the order of the report needs no exchange."""
    lookup = inputs.supplier_lookup(spark, sf_dir)
    strategy = "broadcast" if joins.fits_broadcast(lookup.select("coin_id", "ticker", "category")) else "merge"
    silver = _silver(spark, sf_dir, ranged=strategy == "broadcast")
    return _rounded(gold.daily_summary(silver, lookup, strategy=strategy))


@_query
def daily_summary_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = features.enrich(inputs.event_bars(spark, sf_dir), unique=True)
    return _rounded(gold.daily_summary(silver, inputs.event_lookup(spark)))


@_query
def weekly_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate")
    fits = groups_fit(inputs.table(spark, sf_dir, "lineitem"), [iso_year(day), iso_week(day)])
    return _rounded(gold.weekly_rankings(inputs.supplier_bars(spark, sf_dir), fits=fits))


@_query
def weekly_rankings_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.weekly_rankings(inputs.gap_bars(spark, sf_dir)))


@_query
def volatility_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.volatility_report(_series_silver(spark, sf_dir), ranged=True))


def _several_per_day(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Bars]:
    """Silver with several rows per key and day, by ranges of the key if no series is cut, and the roles its series turn out to run by."""
    bars = inputs.line_bars(spark, sf_dir)
    roles = short_series(bars)
    silver = features.enrich_days(bars, roles, dates_fit=_days_fit(spark, sf_dir), ranged=roles.short)
    return silver, gold.series_of(bars, roles)


@_query
def volatility_several_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver, series = _several_per_day(spark, sf_dir)
    report = gold.volatility_report(silver, series=series, ranged=series.short)
    return _rounded(report).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@_query
def weekly_several_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = inputs.line_bars(spark, sf_dir)
    return _rounded(gold.weekly_rankings(bars, fits=gold.weeks_fit(bars), series=gold.series_of(bars)))


@_query
def topk_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = gold.most_volatile(gold.volatility(_series_silver(spark, sf_dir)))
    return _rounded(top, *BAR_ID, "close", "annualized_vol_pct", "rsi_14", "market_regime")


@_query
def regime_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(gold.regime_summary(_silver(spark, sf_dir)))


@_query
def regime_summary_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    basic = ["coin_id", "market_regime", "days_in_regime", "avg_daily_return_pct", "avg_rsi"]
    return _rounded(gold.regime_summary(_silver(spark, sf_dir)), *basic)


@_query
def regime_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(quality.dominant_regimes(_silver(spark, sf_dir), limit=0.2))


# --- stored tables ----------------------------------------------------------------------


def _stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a table partitioned by priority, written and read back."""
    path = shared_path(spark, "orders")
    write_table(inputs.table(spark, sf_dir, "orders"), path, ("o_orderpriority",))
    return read_table(spark, path)


@_query
def filter_stored_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_orders(spark, sf_dir).filter(F.col("o_orderpriority") == "1-URGENT")


@_query
def pruned_by_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only partitions of the priorities that the lookup names are read: which they are is found while the query runs."""
    stored = _stored_orders(spark, sf_dir)
    lookup = stored.groupBy("o_orderpriority").agg(F.sum(F.floor("o_totalprice")).alias("turnover"))
    lookup = lookup.filter("turnover % 2 = 0")
    return joins.attach_lookup(stored, lookup, "o_orderpriority", "inner")


@_query
def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw runs to bronze in two incremental steps, then silver, all through stored tables."""
    raw, out = shared_path(spark, "raw"), shared_path(spark, "tables")
    for step in (1, 2):
        inputs.raw_order_runs(spark, sf_dir, raw, step)
        layers = ("bronze",) if step == 1 else ("bronze", "silver")
        _done(run(spark, raw, out, layers, incremental=True, partition_by=("event_year",)))
    return _rounded(read_table(spark, f"{out}/silver_enriched").select(*_SILVER_COLUMNS))


@_query
def stored_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers in one full run, read from the gold table."""
    raw, out = shared_path(spark, "raw"), shared_path(spark, "tables")
    for step in (1, 2):
        inputs.raw_order_runs(spark, sf_dir, raw, step)
    _done(run(spark, raw, out, ("bronze", "silver", "gold")))
    return _rounded(read_table(spark, f"{out}/gold_weekly_rankings"))


def _done(outcomes: dict[str, Outcome]) -> None:
    for step, outcome in outcomes.items():
        if not outcome.ok:
            raise RuntimeError(f"{step}: {outcome.error}")


# --- quality ----------------------------------------------------------------------------


def _without_stamp(report: DataFrame) -> DataFrame:
    return report.drop("run_ts")


@_query
def dq_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_stamp(quality.check_null_rates(inputs.gap_bars(spark, sf_dir)))


@_query
def dq_rsi_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = inputs.table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * 3).alias("rsi_14"))
    return _without_stamp(quality.check_rsi_range(marked))


@_query
def dq_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.dayofmonth("event_date")
    shifted = inputs.supplier_bars(spark, sf_dir).withColumns(
        {
            "high": F.when(day == 13, F.col("high") - 5000).otherwise(F.col("high")),
            "low": F.when(day != 14, F.col("low")),
        }
    )
    return _without_stamp(quality.check_price_order(shifted))


@_query
def dq_price_anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    close = F.col("close")
    spiked = inputs.supplier_bars(spark, sf_dir).withColumn(
        "close", F.when(F.dayofyear("event_date") == 200, close * 100).otherwise(close)
    )
    return _without_stamp(quality.check_price_spikes(features.add_rolling_means(spiked, unique=True)))


@_query
def dq_zero_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = F.when(F.dayofyear("event_date") % 5 == 0, F.lit(0.0)).otherwise(F.col("total_volume_usd"))
    return _without_stamp(quality.check_zero_volume(inputs.gap_bars(spark, sf_dir).withColumn("total_volume_usd", volume)))


@_query
def dq_regime_dominance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_stamp(quality.check_regime_shares(_silver(spark, sf_dir)))


@_query
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = features.enrich(inputs.gap_bars(spark, sf_dir), dates_fit=_days_fit(spark, sf_dir), unique=True)
    return quality.summarise(quality.quality_report(silver))
