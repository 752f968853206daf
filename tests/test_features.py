from __future__ import annotations

import math
import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barmart import Bars
from barmart.operators import features, series as series_module
from tests.conftest import plan_of


def test_means_exist_from_the_first_row(steady_bars):
    df = features.add_rolling(steady_bars)
    assert df.filter(F.col("avg_close_7d").isNull()).isEmpty()
    assert df.filter(F.col("avg_close_30d") > 2 * F.col("close")).isEmpty()


def test_short_mean_leads_long_mean_in_a_rise(steady_bars):
    last = features.add_rolling(steady_bars).filter(F.col("event_date") == date(2024, 1, 30)).collect()
    assert len(last) == 3 and all(r.avg_close_7d > r.avg_close_14d for r in last)


def test_vwap_lies_near_the_price(steady_bars):
    df = features.add_vwap(steady_bars)
    outside = ~F.col("vwap_7d").between(F.col("low") * 0.9, F.col("high") * 1.1)
    assert df.filter(F.col("vwap_7d").isNull() | outside).isEmpty()


def test_momentum_of_a_rise(steady_bars):
    df = features.add_momentum(steady_bars)
    first = df.filter(F.col("event_date") == date(2024, 1, 1)).collect()
    assert [r.pct_change_1d for r in first] == [None] * 3
    assert df.filter(F.col("pct_change_1d") <= 0).isEmpty()
    assert df.filter(F.col("high_low_spread_pct") < 0).isEmpty()


def test_ranking_covers_the_day(steady_bars):
    rows = features.add_daily_ranking(steady_bars).filter(F.col("event_date") == date(2024, 1, 15)).collect()
    assert {r.rank_by_mcap for r in rows} == {1, 2, 3}
    assert next(r.rank_by_mcap for r in rows if r.coin_id == "bitcoin") == 1


def test_zero_and_missing_values_give_null_instead_of_an_error(spark, series):
    bars = series({"a": [5.0, 0.0, 3.0, None, 4.0]}).withColumn("total_volume_usd", F.lit(0.0))
    rows = features.enrich(bars).orderBy("event_date").collect()
    assert [r.vwap_7d for r in rows] == [None] * 5
    assert [r.pct_change_1d for r in rows] == [None, -100.0, None, None, None]
    assert rows[1].high_low_spread_pct is None and rows[1].market_regime == "unknown"


def test_bands_of_a_flat_series(series):
    bars = features.add_momentum(series({"flat": [7.0] * 25}))
    last = features.add_bands(bars).orderBy(F.desc("event_date")).first()
    assert (last.bb_upper, last.bb_lower, last.bb_pct_b, last.bb_bandwidth) == (7.0, 7.0, None, 0.0)


def _random_closes(seed: int, n: int) -> list[float | None]:
    pick = random.Random(seed)
    return [None if pick.random() < 0.1 else float(pick.randint(1, 500)) for _ in range(n)]


def test_frames_equal_pandas(series):
    closes = {f"s{i}": _random_closes(i, 90) for i in range(4)}
    got = features.add_rolling(series(closes)).toPandas().sort_values(["coin_id", "event_date"])
    for coin, values in closes.items():
        mine, column = got[got.coin_id == coin], pd.Series(values, dtype=float)
        for rows in (7, 14, 30):
            expected = column.rolling(rows, min_periods=1).mean()
            np.testing.assert_allclose(mine[f"avg_close_{rows}d"], expected, rtol=1e-12)
        np.testing.assert_allclose(mine["stddev_close_30d"], column.rolling(30, min_periods=2).std(), rtol=1e-9)


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_result_does_not_depend_on_layout(spark, series, partitions):
    closes = {f"s{i}": _random_closes(i, 60) for i in range(3)}
    want = features.enrich(series(closes)).orderBy("coin_id", "event_date").collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = series(closes).orderBy(F.rand(seed=int(partitions)))
        assert features.enrich(shuffled).orderBy("coin_id", "event_date").collect() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return a == b


def test_cut_series_give_the_same_features(monkeypatch, series):
    """One hot series of 20,000 rows, cut into blocks of 8,192, against the uncut plan."""
    closes = {"hot": _random_closes(1, 20_000), "small": _random_closes(2, 50)}
    whole = features.enrich(series(closes, date(1960, 1, 1)))
    monkeypatch.setattr(series_module, "BLOCK_ROWS", 8192)
    timed = series(closes, date(1960, 1, 1)).withColumn("event_date", F.col("event_date").cast("timestamp"))
    cut = features.enrich(timed).withColumn("event_date", F.to_date("event_date"))
    assert "explode" in plan_of(cut)
    want = whole.orderBy("coin_id", "event_date").collect()
    got = cut.select(*whole.columns).orderBy("coin_id", "event_date").collect()
    assert len(got) == len(want)
    bad = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    assert not bad, bad[0]


def test_cut_intraday_series(monkeypatch, spark):
    """20,000 bars seven seconds apart: many rows per hour, frames reaching over hours and blocks."""
    monkeypatch.setattr(series_module, "BLOCK_ROWS", 5000)
    closes = _random_closes(3, 20_000)
    df = spark.createDataFrame(list(enumerate(closes)), "i int, close double").select(
        F.lit("hot").alias("coin_id"), F.timestamp_seconds(1_700_000_000 + F.col("i") * 7).alias("event_date"), "i", "close"
    )
    got = features.add_rolling(df.repartition(7)).orderBy("i").toPandas()
    column = pd.Series(closes, dtype=float)
    assert list(got.i) == list(range(20_000))
    for rows in (7, 14, 30):
        np.testing.assert_allclose(got[f"avg_close_{rows}d"], column.rolling(rows, min_periods=1).mean(), rtol=1e-12)


def test_other_column_names(steady_bars):
    renamed = steady_bars.withColumnsRenamed({"coin_id": "sensor", "event_date": "day", "close": "reading"})
    bars = Bars(key="sensor", time="day", close="reading")
    got = features.enrich(renamed, bars).select("rsi_14", "vwap_7d").orderBy("sensor", "day").collect()
    want = features.enrich(steady_bars).select("rsi_14", "vwap_7d").orderBy("coin_id", "event_date").collect()
    assert got == want
