"""Data-quality checks: every check is one or more rows of the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barmart.functions.numeric import ratio
from barmart.schemas import QUALITY_REPORT, Bars

# Thresholds, and columns exempt from the null check.
MAX_NULL_RATE = 0.05
PRICE_MULTIPLE = 10.0
MAX_ZERO_VOLUME = 0.02
MAX_REGIME_SHARE = 0.80
NULLS_ALLOWED = ("event_year", "event_month")
REGIME = "market_regime"

# The texts of the report.
NULLS = "%d/%d nulls in '"
NO_RSI = "{} column not present — skipped"
RSI_OUTSIDE = "%d rows with RSI outside [0, 100]"
NO_PRICES = "OHLC columns not present — skipped"
PRICES_BROKEN = "%d rows violating low <= OHLC <= high"
NO_MEAN = "{} not present — skipped"
SPIKES = "%d rows where close > {}× 30d avg"
NO_VOLUME = "volume column not present — skipped"
VOLUME_EMPTY = "%d/%d rows with zero/null volume"
RULED = "Regime '%s' dominates %.1f%% of days for %s — consider retuning classifier thresholds"


def _result(name: Column, passed: Column, metric: Column, threshold: float, details: Column) -> Column:
    return F.struct(
        name.alias("check_name"),
        passed.alias("passed"),
        metric.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold"),
        details.alias("details"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("run_ts"),
    )


def _skipped(name: str, details: str) -> Column:
    return _result(F.lit(name), F.lit(True), F.lit(0.0), 0.0, F.lit(details))


class _Pass:
    """Collects what one aggregate over the table must compute, and the result rows made of it."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.counts: dict[str, Column] = {"total": F.count("*")}
        self.results: list[Column] = []

    def count(self, condition: Column) -> Column:
        name = f"n{len(self.counts)}"
        self.counts[name] = F.count_if(condition)
        return F.col(name)

    def limit_share(self, name: str, bad: Column, limit: float, text: str) -> None:
        bad_rows, total = self.count(bad), F.col("total")
        share = F.coalesce(ratio(bad_rows, total), F.lit(0.0))
        details = F.format_string(text, bad_rows, total)
        self.results.append(_result(F.lit(name), share <= limit, F.bround(share, 4), limit, details))

    def forbid(self, name: str, bad: Column, text: str) -> None:
        bad_rows = self.count(bad)
        self.results.append(_result(F.lit(name), bad_rows == 0, bad_rows, 0.0, F.format_string(text, bad_rows)))

    def skip(self, name: str, details: str) -> None:
        self.results.append(_skipped(name, details))

    def report(self) -> DataFrame:
        totals = self.df.agg(*[c.alias(n) for n, c in self.counts.items()])
        return totals.select(F.inline(F.array(*self.results))).to(QUALITY_REPORT)


def _null_rates(run: _Pass, limit: float) -> None:
    for name in run.df.columns:
        if name.startswith("_") or name in NULLS_ALLOWED:
            continue
        text = NULLS + name.replace("%", "%%") + "'"
        run.limit_share(f"null_rate_{name}", F.col(f"`{name}`").isNull(), limit, text)


def _rsi_range(run: _Pass, rsi: str = "rsi_14") -> None:
    if rsi not in run.df.columns:
        return run.skip("rsi_range", NO_RSI.format(rsi))
    outside = (F.col(rsi) < 0) | (F.col(rsi) > 100)
    run.forbid("rsi_range_validity", outside, RSI_OUTSIDE)


def _price_order(run: _Pass, bars: Bars) -> None:
    if not set(bars.prices) <= set(run.df.columns):
        return run.skip("ohlc_consistency", NO_PRICES)
    first, high, low, last = map(F.col, bars.prices)
    # A comparison with null is unknown and does not count, but must not hide another one.
    broken = (low > first) | (low > last) | (high < first) | (high < last)
    run.forbid("ohlc_consistency", broken, PRICES_BROKEN)


def _price_spikes(run: _Pass, bars: Bars, multiple: float, mean: str = "avg_close_30d") -> None:
    if mean not in run.df.columns:
        return run.skip("price_anomaly", NO_MEAN.format(mean))
    spike = F.col(bars.close) > multiple * F.col(mean)
    run.forbid("price_anomaly_detection", spike, SPIKES.format(multiple))


def _zero_volume(run: _Pass, bars: Bars, limit: float) -> None:
    if bars.volume not in run.df.columns:
        return run.skip("zero_volume", NO_VOLUME)
    empty = F.col(bars.volume).isNull() | (F.col(bars.volume) == 0)
    run.limit_share("zero_volume_rate", empty, limit, VOLUME_EMPTY)


def check_null_rates(df: DataFrame, limit: float = MAX_NULL_RATE) -> DataFrame:
    run = _Pass(df)
    _null_rates(run, limit)
    return run.report()


def check_rsi_range(df: DataFrame) -> DataFrame:
    run = _Pass(df)
    _rsi_range(run)
    return run.report()


def check_price_order(df: DataFrame, bars: Bars = Bars()) -> DataFrame:
    run = _Pass(df)
    _price_order(run, bars)
    return run.report()


def check_price_spikes(df: DataFrame, bars: Bars = Bars(), multiple: float = PRICE_MULTIPLE) -> DataFrame:
    run = _Pass(df)
    _price_spikes(run, bars, multiple)
    return run.report()


def check_zero_volume(df: DataFrame, bars: Bars = Bars(), limit: float = MAX_ZERO_VOLUME) -> DataFrame:
    run = _Pass(df)
    _zero_volume(run, bars, limit)
    return run.report()


def regime_shares(df: DataFrame, key: str = "coin_id", regime: str = REGIME) -> DataFrame:
    """Rows per (key, regime) and their share of the key's rows; a null key has no share."""
    per_label = df.filter(F.col(key).isNotNull()).groupBy(key, regime).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy(key))
    return per_label.withColumn("total", total).withColumn("regime_rate", ratio(F.col("count"), F.col("total")))


def dominant_regimes(
    df: DataFrame, key: str = "coin_id", regime: str = REGIME, limit: float = MAX_REGIME_SHARE
) -> DataFrame:
    return regime_shares(df, key, regime).filter(F.col("regime_rate") > limit)


def _regime_result(owner: Column, regime: Column, rate: Column, limit: float) -> Column:
    details = F.format_string(RULED, F.coalesce(regime, F.lit("None")), F.bround(rate * 100, 1), owner)
    return _result(F.concat(F.lit("regime_distribution_"), owner), F.lit(False), F.bround(rate, 4), limit, details)


def check_regime_shares(
    df: DataFrame, key: str = "coin_id", regime: str = REGIME, limit: float = MAX_REGIME_SHARE
) -> DataFrame:
    """One failed row per key ruled by a single regime; nothing otherwise."""
    if not {key, regime} <= set(df.columns):
        return df.sparkSession.createDataFrame([], QUALITY_REPORT)
    row = _regime_result(F.col(key).cast("string"), F.col(regime), F.col("regime_rate"), limit)
    return dominant_regimes(df, key, regime, limit).select(F.inline(F.array(row))).to(QUALITY_REPORT)


def quality_report(
    df: DataFrame,
    bars: Bars = Bars(),
    max_null_rate: float = MAX_NULL_RATE,
    price_multiple: float = PRICE_MULTIPLE,
    max_zero_volume: float = MAX_ZERO_VOLUME,
    max_regime_share: float = MAX_REGIME_SHARE,
) -> DataFrame:
    """All checks in one pass: counters by (key, regime), from which the totals and the shares of regimes are made."""
    run = _Pass(df)
    _null_rates(run, max_null_rate)
    _rsi_range(run)
    _price_order(run, bars)
    _price_spikes(run, bars, price_multiple)
    _zero_volume(run, bars, max_zero_volume)
    if not {bars.key, REGIME} <= set(df.columns):
        return run.report()
    return _one_pass(run, bars.key, max_regime_share)


def _one_pass(run: _Pass, key: str, limit: float) -> DataFrame:
    """Each (key, regime) row of counters goes into the totals (part 0) and into its key's shares (part 1).

    A row of zeros makes sure of a total where there are no rows. A key has a few regimes, so its list is short.
    """
    counters = list(run.counts)
    grouped = run.df.groupBy(F.col(key).alias("_owner"), F.col(REGIME).alias("_regime")).agg(
        *[c.alias(n) for n, c in run.counts.items()]
    )
    zeros = run.df.sparkSession.range(1).select(
        F.lit(None).alias("_owner"), F.lit(None).alias("_regime"), *[F.lit(0).cast("long").alias(n) for n in counters]
    )
    parts = grouped.unionByName(zeros).withColumn("_part", F.explode(F.array(F.lit(0), F.lit(1))))
    own = F.col("_part") == 1
    summed = (
        parts.filter(~own | F.col("_owner").isNotNull())
        .withColumn("_owner", F.when(own, F.col("_owner")))
        .groupBy("_part", "_owner")
        .agg(
            *[F.sum(n).alias(n) for n in counters],
            F.collect_list(F.when(own, F.struct("_regime", F.col("total").alias("count")))).alias("_labels"),
        )
    )
    owner, total = F.col("_owner").cast("string"), F.col("total")
    ruling = F.filter("_labels", lambda x: x["count"] / total > limit)
    shares = F.transform(ruling, lambda x: _regime_result(owner, x["_regime"], x["count"] / total, limit))
    return summed.select(F.inline(F.when(own, shares).otherwise(F.array(*run.results)))).to(QUALITY_REPORT)


def summarise(report: DataFrame) -> DataFrame:
    """One row: how many checks passed, failed, and ran."""
    return report.agg(
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count("*").alias("total"),
    )
