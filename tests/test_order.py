"""Series in which rows share a place: results must not follow the layout."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from barmart.operators import features
from barmart.operators.rsi import add_rsi
from barmart.operators.series import repeated_places, total_order
from barmart.plans import gold
from barmart.plans.layers import build_gold, Places, run
from barmart.schemas import Bars
from barmart.sources.tables import read_table, write_table
from tests.conftest import BAR_SCHEMA
from tests.test_layers import bar_rows, measure_rows
from tests.test_sources import DAY_MS, FIRST, START_MS, put


def repeated_days(seed=3, keys=2, days=30, most=5):
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        for d in range(days):
            for _ in range(rng.randrange(1, most)):
                close = float(rng.randrange(50, 150))
                rows.append((f"k{k}", date(2024, 1, 1) + timedelta(d), close - 1, close + 2, close - 3, close, float(rng.randrange(3)), float(rng.randrange(4))))
    return rows + rows[:3]


def values(df):
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in row)) for row in df.collect())


@pytest.fixture(scope="module")
def rows():
    return repeated_days()


def laid_out(spark, rows, parts):
    shuffled = list(rows)
    random.Random(parts).shuffle(shuffled)
    return spark.createDataFrame(shuffled, BAR_SCHEMA).repartition(parts)


@pytest.mark.parametrize("apply", [features.enrich, add_rsi, features.add_rolling, features.add_momentum])
def test_repeated_days_do_not_follow_the_layout(spark, rows, apply):
    found = [values(apply(laid_out(spark, rows, parts))) for parts in (1, 4, 16)]
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)


def test_the_order_is_only_extended_where_places_repeat(spark, rows, steady_bars):
    assert total_order(steady_bars, Bars()) == Bars() and repeated_places(steady_bars, Bars()) == 0
    df = laid_out(spark, rows, 2)
    series = total_order(df, Bars())
    assert repeated_places(df, Bars()) > 10 and series.order[:3] == ("event_date", "market_cap_usd", "total_volume_usd")
    assert set(series.order) | {"coin_id"} == set(df.columns)
    assert total_order(df, Bars(), unique=True) == Bars()


def test_values_along_the_extended_order(spark, rows):
    """Momentum and index against plain lists in the order of (date, size, volume, prices)."""
    got = {}
    for r in features.enrich(laid_out(spark, rows, 3)).collect():
        got.setdefault(r.coin_id, []).append(r)
    for key, found in got.items():
        order = lambda r: (r.event_date, r.market_cap_usd, r.total_volume_usd, r.open, r.high, r.low, r.close)
        closes = [r.close for r in sorted(found, key=order)]
        moves = [None] + [(b - a) / a * 100 for a, b in zip(closes, closes[1:])]
        want = sorted((c, m is None, m or 0.0) for c, m in zip(closes, moves))
        have = sorted((r.close, r.pct_change_1d is None, r.pct_change_1d or 0.0) for r in found)
        assert [w[:2] for w in want] == [h[:2] for h in have] and [w[2] for w in want] == pytest.approx([h[2] for h in have])


def test_stored_gold_does_not_follow_the_layout(spark, rows, tmp_path):
    """Gold of one silver table with several bars a day, two at one time stamp, stored from 1, 4 and 16 partitions."""
    stamped = [(*r, datetime(r[1].year, r[1].month, r[1].day, k % 3)) for k, r in enumerate(rows)]
    results = []
    for parts in (1, 4, 16):
        shuffled = list(stamped)
        random.Random(parts).shuffle(shuffled)
        silver = features.enrich_days(spark.createDataFrame(shuffled, BAR_SCHEMA + ", event_ts timestamp").repartition(parts))
        out = str(tmp_path / str(parts))
        write_table(silver, f"{out}/silver_enriched")
        lookup = spark.createDataFrame([("k0", "A", "x")], "coin_id string, ticker string, category string")
        counts = build_gold(spark, Places("", out), Bars(), lookup, keep_silver=False)
        assert counts["gold_daily_summary"] == counts["gold_volatility_report"] == len(rows)
        results.append({name: values(read_table(spark, f"{out}/{name}")) for name in counts})
    assert results[0] == results[1] == results[2]


def test_first_and_last_bar_of_a_week_go_by_the_time_stamp(spark):
    day = date(2024, 1, 1)
    rows = [("a", day + timedelta(d), 10.0 * d + h, 99.0, 1.0, 10.0 * d + h + 0.5, 1.0, float(9 - h), datetime(2024, 1, 1 + d, h)) for d in range(3) for h in range(4)]
    df = spark.createDataFrame(rows[::-1], BAR_SCHEMA + ", event_ts timestamp")
    (week,) = gold.weekly_bars(df, series=gold.series_of(df)).collect()
    assert (week.week_open, week.week_close) == (0.0, 23.5)


def test_gold_after_a_run_that_kept_all_rows(spark, tmp_path):
    stamps = [START_MS + i * DAY_MS // 6 for i in range(30)]
    put(tmp_path / f"raw/ohlc/a/{FIRST}.json", bar_rows("a", stamps))
    put(tmp_path / f"raw/market/a/{FIRST}.json", measure_rows("a", [START_MS + d * DAY_MS for d in range(5)]))
    out = str(tmp_path / "out")
    assert all(o.ok for o in run(spark, str(tmp_path / "raw"), out, ("bronze", "silver"), days="all").values())
    assert run(spark, str(tmp_path / "raw"), out, ("gold",))["gold"].ok  # the stored table tells, not the argument
    report = read_table(spark, f"{out}/gold_volatility_report").orderBy("event_ts").collect()
    closes = [11.0 + i for i in range(30)]
    assert [r.close for r in report] == closes
    assert report[-1].bb_sma_20 == pytest.approx(sum(closes[10:]) / 20)
