from __future__ import annotations

import random
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barmart.operators import series as series_module
from barmart.operators.rsi import add_rsi


def exponential_mean_index(closes: list[float | None]) -> np.ndarray:
    """The index as defined: shares of the exponentially weighted mean gain and loss."""
    change = pd.Series(closes, dtype=float).diff()
    up, down = (c.where(c > 0, 0.0).where(change.notna()).ewm(alpha=1 / 14, min_periods=14).mean() for c in (change, -change))
    return (100 * up / (up + down)).fillna(50.0).to_numpy()


def walk(seed: int, n: int, missing: float = 0.0) -> list[float | None]:
    pick, close, out = random.Random(seed), 100.0, []
    for _ in range(n):
        close = max(1.0, close + pick.choice([-3, -2, -1, 0, 1, 2, 3]))
        out.append(None if pick.random() < missing else close)
    return out


CASES = {
    "rising": [100.0 * i for i in range(1, 31)],
    "falling": [100.0 * i for i in range(30, 0, -1)],
    "constant": [5.0] * 40,
    "thirteen": walk(3, 13),
    "scattered": walk(4, 3000, missing=0.1),
    "leading": [None] * 40 + walk(5, 500),
    "gap": walk(6, 600) + [None] * 6000 + walk(7, 600),
    "long": walk(8, 20_000),
    "nothing": [None] * 20,
}


def compare(df, closes):
    got = df.select("coin_id", "event_date", "rsi_14").toPandas().sort_values(["coin_id", "event_date"])
    for coin, values in closes.items():
        mine = got[got.coin_id == coin].rsi_14.to_numpy()
        np.testing.assert_allclose(mine, exponential_mean_index(values), rtol=0, atol=1e-9, err_msg=coin)


def test_native_index_equals_the_definition(series):
    compare(add_rsi(series(CASES, date(1960, 1, 1))), CASES)


def test_cut_series_equal_the_definition(monkeypatch, series):
    monkeypatch.setattr(series_module, "BLOCK_ROWS", 4200)
    bars = series(CASES, date(1960, 1, 1)).withColumn("event_date", F.col("event_date").cast("timestamp"))
    compare(add_rsi(bars), CASES)


def test_known_values(series):
    last = {r.coin_id: r.rsi for r in add_rsi(series(CASES)).groupBy("coin_id").agg(F.max_by("rsi_14", "event_date").alias("rsi")).collect()}
    assert last["rising"] == 100 and last["falling"] == 0
    assert last["constant"] == last["thirteen"] == last["nothing"] == 50


def test_range_and_trend(steady_bars):
    df = add_rsi(steady_bars)
    assert df.filter(~F.col("rsi_14").between(0, 100)).isEmpty()
    assert df.filter((F.col("event_date") == date(2024, 1, 30)) & (F.col("rsi_14") <= 50)).isEmpty()


def test_index_holds_through_a_flat_stretch_longer_than_two_spans(series):
    """Without any change the shares stay, however far the last change lies back."""
    closes = walk(9, 200) + [77.0] * 9000
    got = add_rsi(series({"a": closes}, date(1960, 1, 1))).orderBy("event_date").select("rsi_14").collect()
    assert got[-1].rsi_14 == pytest.approx(exponential_mean_index(closes)[250], abs=1e-9)


def test_nan_counts_as_missing(series):
    closes = walk(10, 60)
    holes = [float("nan") if i % 9 == 4 else c for i, c in enumerate(closes)]
    compare(add_rsi(series({"a": holes})), {"a": holes})
