from __future__ import annotations

from datetime import date

import pytest

from barmart.operators.joins import attach_lookup, fits_broadcast, join_bars
from barmart.sources.lookup import coin_lookup
from tests.conftest import plan_of

DAY = date(2024, 1, 1)
PRICES = "coin_id string, event_date date, timestamp_ms long, open double, high double, low double, close double"
MEASURES = "coin_id string, event_date date, timestamp_ms long, market_cap_usd double, total_volume_usd double"


@pytest.fixture
def doubled(spark):
    """Two bars of one (key, day) on both sides; the later ones are 2.0 and 20.0."""
    prices = spark.createDataFrame(
        [("a", DAY, 1, 0.5, 9.0, 0.4, 1.0), ("a", DAY, 2, 0.7, 8.0, 0.1, 2.0), ("b", DAY, 1, 3.0, 3.0, 3.0, 3.0)], PRICES
    )
    measures = spark.createDataFrame([("a", DAY, 5, 10.0, 7.0), ("a", DAY, 6, 20.0, 8.0), ("c", DAY, 1, 1.0, 1.0)], MEASURES)
    return prices, measures


def test_rows_of_a_day_are_merged(doubled):
    rows = join_bars(*doubled).collect()
    measured = [(r.coin_id, r.open, r.high, r.low, r.close, r.timestamp_ms, r.market_cap_usd, r.total_volume_usd) for r in rows]
    assert measured == [("a", 0.5, 9.0, 0.1, 2.0, 2, 20.0, 8.0)]
    assert join_bars(*doubled, total_volume=True).first().total_volume_usd == 15.0


def test_unknown_prices_do_not_hide_known_ones(spark):
    prices = spark.createDataFrame([("a", DAY, 1, None, 3.0, 1.0, 2.0), ("a", DAY, 2, 5.0, None, None, None)], PRICES)
    measures = spark.createDataFrame([("a", DAY, 1, 4.0, None), ("a", DAY, 2, None, 6.0)], MEASURES)
    row = join_bars(prices, measures).first()
    assert (row.open, row.high, row.low, row.close, row.market_cap_usd, row.total_volume_usd) == (5.0, 3.0, 1.0, 2.0, 4.0, 6.0)


def test_plain_join_fans_out(doubled):
    assert join_bars(*doubled, days="all").count() == 4
    with pytest.raises(ValueError):
        join_bars(*doubled, days="some")


def test_unknown_keys_stay_in_a_left_join(spark):
    df = spark.createDataFrame([("bitcoin", 1), ("dogecoin", 2)], "coin_id string, n int")
    for strategy in ("measured", "broadcast", "merge"):
        rows = {r.coin_id: (r.ticker, r.category) for r in attach_lookup(df, coin_lookup(spark), "coin_id", strategy=strategy).collect()}
        assert rows == {"bitcoin": ("BTC", "Layer 1"), "dogecoin": (None, None)}
    inner = attach_lookup(df, coin_lookup(spark), "coin_id", "inner").collect()
    assert [r.coin_id for r in inner] == ["bitcoin"]


def test_only_a_measured_lookup_is_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([("bitcoin", 1)], "coin_id string, n int")
    lookup = coin_lookup(spark)
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, 100)
    assert "BroadcastHashJoin" in plan_of(attach_lookup(df, lookup, "coin_id"))
    monkeypatch.setattr("barmart.operators.joins.fits_broadcast", lambda lookup: False)
    assert "SortMergeJoin" in plan_of(attach_lookup(df, lookup, "coin_id"))
    assert "SortMergeJoin" in plan_of(attach_lookup(df, lookup, "coin_id", strategy="merge"))
