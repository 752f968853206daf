from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from barmart.operators.features import enrich
from barmart.plans import gold
from barmart.sources.lookup import coin_lookup
from tests.conftest import BAR_SCHEMA


@pytest.fixture(scope="module")
def silver(spark):
    rows = []
    for k, base in enumerate((100, 50, 20)):
        for i in range(60):
            close = float(base + (i * (7 + k)) % 13 - (i % 5))
            day = date.fromordinal(date(2024, 11, 15).toordinal() + i)
            rows.append((f"c{k}", day, close - 1, close + 3, close - 2, close, 100.0 + i, close * 10))
    return enrich(spark.createDataFrame(rows, BAR_SCHEMA))


def test_weeks_follow_the_iso_year(spark):
    rows = [("a", d, o, 9.0, 1.0, c, 1.0, 2.0) for d, o, c in [
        (date(2025, 1, 2), 5.0, 6.0), (date(2024, 12, 30), None, 4.0), (date(2024, 12, 31), 4.0, 5.0),
        (date(2025, 1, 3), 7.0, None), (date(2024, 1, 3), 2.0, 3.0), (date(2021, 1, 1), 0.0, 3.0),
    ]]
    got = {(r.iso_year, r.iso_week): (r.week_open, r.week_close, r.weekly_return_pct, r.week_total_volume)
           for r in gold.weekly_rankings(spark.createDataFrame(rows, BAR_SCHEMA)).collect()}
    assert got == {(2025, 1): (4.0, 6.0, 50.0, 4.0), (2024, 1): (2.0, 3.0, 50.0, 1.0), (2020, 53): (0.0, 3.0, None, 1.0)}


def test_both_weekly_plans_agree(silver):
    assert gold.weekly_rankings(silver).collect() == gold.weekly_rankings(silver, fits=gold.weeks_fit(silver)).collect()


def test_daily_summary_shape(spark, silver):
    df = gold.daily_summary(silver, coin_lookup(spark))
    assert len(df.columns) == 21 and df.count() == 180
    days = [(r.coin_id, r.event_date) for r in df.collect()]
    assert days == sorted(days)


def test_volatility_and_top_rows(silver):
    report = gold.volatility_report(silver)
    assert len(report.columns) == 11
    first = report.filter(F.col("event_date") == date(2024, 11, 15)).first()
    assert first.annualized_vol_pct is None and first.bb_upper is None
    everything = report.filter(F.col("annualized_vol_pct").isNotNull()).toPandas()
    for coin, rows in gold.most_volatile(report).toPandas().groupby("coin_id"):
        best = everything[everything.coin_id == coin].annualized_vol_pct.nlargest(5)
        assert list(rows.annualized_vol_pct) == list(best)


def test_regime_shares_add_up(silver):
    rows = gold.regime_summary(silver).collect()
    assert all(r.market_regime != "unknown" for r in rows)
    for coin in {r.coin_id for r in rows}:
        mine = [r for r in rows if r.coin_id == coin]
        assert sum(r.regime_pct_of_history for r in mine) == pytest.approx(100)
        assert [r.days_in_regime for r in mine] == sorted((r.days_in_regime for r in mine), reverse=True)
        assert sum(r.days_in_regime for r in mine) == 53
