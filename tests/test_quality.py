from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from barmart.operators import features, quality
from barmart.schemas import QUALITY_REPORT
from tests.conftest import BAR_SCHEMA


def only(report):
    rows = report.collect()
    assert report.schema.simpleString() == QUALITY_REPORT.simpleString()
    assert len(rows) == 1
    return rows[0]


def test_price_order(spark, steady_bars):
    assert only(quality.check_price_order(steady_bars)).passed
    bad = spark.createDataFrame(
        [("bitcoin", 100.0, 90.0, 110.0, 95.0), ("x", None, 1.0, None, 2.0), ("y", 1.0, None, None, 1.0)],
        "coin_id string, open double, high double, low double, close double",
    )
    row = only(quality.check_price_order(bad))
    assert (row.passed, row.metric_value, row.details) == (False, 2.0, "2 rows violating low <= OHLC <= high")


@pytest.mark.parametrize("values, passed", [([45.0, 72.0, 30.0, None], True), ([150.0], False), ([-0.1], False)])
def test_rsi_range(spark, values, passed):
    df = spark.createDataFrame([("c", v) for v in values], "coin_id string, rsi_14 double")
    assert only(quality.check_rsi_range(df)).passed is passed


def test_null_rates(spark):
    rows = [(None if i < 6 else i, i, None, None) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b int, _c int, event_year int")
    got = {r.check_name: (r.passed, r.metric_value, r.threshold, r.details) for r in quality.check_null_rates(df).collect()}
    assert got == {
        "null_rate_a": (False, 0.06, 0.05, "6/100 nulls in 'a'"),
        "null_rate_b": (True, 0.0, 0.05, "0/100 nulls in 'b'"),
    }


def test_price_spike(spark):
    closes = [10.0] * 20 + [1000.0]
    rows = [("a", date(2024, 1, i + 1), 1.0, 1.0, 1.0, c, 1.0, 1.0) for i, c in enumerate(closes)]
    df = features.add_rolling(spark.createDataFrame(rows, BAR_SCHEMA))
    row = only(quality.check_price_spikes(df))
    assert (row.check_name, row.passed, row.details) == ("price_anomaly_detection", False, "1 rows where close > 10.0× 30d avg")
    assert only(quality.check_price_spikes(df.filter("close < 100"))).passed


def test_zero_volume(spark):
    df = spark.createDataFrame([(0.0 if i == 0 else None if i == 1 else 5.0,) for i in range(60)], "total_volume_usd double")
    row = only(quality.check_zero_volume(df))
    assert (row.passed, row.metric_value, row.details) == (False, 0.0333, "2/60 rows with zero/null volume")
    assert only(quality.check_zero_volume(df, limit=0.04)).passed


def test_dominant_regime(spark):
    rows = [("a", "neutral")] * 9 + [("a", "unknown")] + [("b", "neutral")] * 4 + [("b", "x")] + [(None, "neutral")] * 5 + [("c", None)]
    df = spark.createDataFrame(rows, "coin_id string, market_regime string")
    got = {r.check_name: r for r in quality.check_regime_shares(df).collect()}
    assert set(got) == {"regime_distribution_a", "regime_distribution_c"}
    assert got["regime_distribution_a"].metric_value == 0.9 and not got["regime_distribution_a"].passed
    assert got["regime_distribution_a"].details.startswith("Regime 'neutral' dominates 90.0% of days for a")


def test_absent_columns_and_empty_tables_pass(spark, steady_bars):
    bare = spark.createDataFrame([(1,)], "x int")
    rows = {r.check_name: r for r in quality.quality_report(bare).collect()}
    assert set(rows) == {"null_rate_x", "rsi_range", "ohlc_consistency", "price_anomaly", "zero_volume"}
    assert all(r.passed for r in rows.values()) and rows["rsi_range"].details.endswith("skipped")
    empty = quality.quality_report(features.enrich(steady_bars.limit(0)))
    assert empty.filter(~F.col("passed")).isEmpty()


def test_totals(spark, steady_bars):
    report = quality.quality_report(features.enrich(steady_bars))
    totals = quality.summarise(report).first()
    assert totals.passed + totals.failed == totals.total == report.count()
    assert {r.check_name for r in report.filter(~F.col("passed")).collect()} == {"null_rate_pct_change_7d"}
