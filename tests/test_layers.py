from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barmart.plans.layers import run
from barmart.sources.tables import read_table
from tests.test_sources import DAY_MS, FIRST, SECOND, START_MS, put, raw_zone  # noqa: F401


@pytest.fixture
def finished(spark, raw_zone, tmp_path):  # noqa: F811
    out = str(tmp_path / "out")
    return out, run(spark, str(raw_zone), out, ("bronze", "quality", "silver", "gold", "layout"), keep_silver=True)


def test_full_run(spark, finished):
    out, outcomes = finished
    assert list(outcomes) == ["bronze", "quality_bronze", "silver", "quality_silver", "gold", "layout"]
    assert all(o.ok for o in outcomes.values()), outcomes
    assert outcomes["bronze"].rows == {"bronze_ohlc": 90, "bronze_market": 84}
    assert outcomes["silver"].rows == {"silver_enriched": 84, "price_rows_merged": 0}
    assert outcomes["gold"].rows["gold_daily_summary"] == 84
    assert outcomes["layout"].rows == {"bitcoin": 42, "ethereum": 42}

    silver = spark.read.parquet(f"{out}/silver_enriched")
    expected = {"avg_close_7d", "avg_close_14d", "avg_close_30d", "stddev_close_30d", "vwap_7d", "pct_change_1d",
                "pct_change_7d", "high_low_spread_pct", "rank_by_mcap", "dense_rank_by_mcap", "pct_rank_by_mcap",
                "rsi_14", "market_regime", "event_ts", "_source_file", "market_cap_usd", "total_volume_usd"}
    assert expected <= set(silver.columns)
    assert silver.filter(F.col("event_date") == "2024-01-20").select("close", "rsi_14").first() == (30.5, 100.0)

    for coin in ("bitcoin", "ethereum"):
        assert len(list(Path(out, "silver_enriched", f"coin_id={coin}").glob("*.parquet"))) == 1

    for source in ("ohlc", "market"):
        rejected = spark.read.parquet(f"{out}/quarantine/{source}")
        assert rejected.count() == 3
        assert [r[0] for r in rejected.select("_quarantine_reason").distinct().collect()] == ["null_key_field"]

    report = spark.read.parquet(f"{out}/quality_report")
    totals = outcomes["quality_bronze"].rows, outcomes["quality_silver"].rows
    assert report.count() == sum(t["passed"] + t["failed"] for t in totals)


def test_a_second_run_replaces_tables_and_adds_no_known_reject(spark, finished, raw_zone):  # noqa: F811
    out, _ = finished
    put(raw_zone / "ohlc/bitcoin/20240103T000000.json", "[]")
    again = run(spark, str(raw_zone), out, ("bronze", "silver"))
    assert again["bronze"].rows == {"bronze_ohlc": 90, "bronze_market": 84} and again["silver"].ok
    assert spark.read.parquet(f"{out}/quarantine/ohlc").count() == 3  # known rejects aren't stored again


def test_layers_after_a_failure_are_left_out(spark, tmp_path):
    outcomes = run(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))
    assert list(outcomes) == ["bronze"] and not outcomes["bronze"].ok and outcomes["bronze"].error


def test_only_requested_layers_run(spark, finished, raw_zone):  # noqa: F811
    out, _ = finished
    assert list(run(spark, str(raw_zone), out, ("gold",))) == ["gold"]
    with pytest.raises(ValueError):
        run(spark, str(raw_zone), out, ("golden",))


def test_unpartitioned_tables(spark, raw_zone, tmp_path):  # noqa: F811
    out = tmp_path / "flat"
    outcomes = run(spark, str(raw_zone), str(out), partition_by=())
    assert all(o.ok for o in outcomes.values()) and not list(out.glob("*/coin_id=*"))
    assert outcomes["silver"].rows == {"silver_enriched": 84, "price_rows_merged": 0}


def test_raw_response_bodies(spark, tmp_path):
    """Bodies as a price service returns them give the same tables as the raw rows would."""
    days = range(40)
    for coin, base in (("bitcoin", 100.0), ("solana", 10.0)):
        bars = [[START_MS + i * DAY_MS, base + i, base + i + 2, base + i - 1, base + i + 1] for i in days]
        points = [[START_MS + i * DAY_MS, base * 10 + i] for i in days]
        put(tmp_path / f"ohlc/{coin}/{FIRST}.json", json.dumps(bars))
        put(tmp_path / f"market/{coin}/{FIRST}.json", json.dumps({"prices": points, "market_caps": points, "total_volumes": points[:35]}))
    put(tmp_path / f"market/bad/{FIRST}.json", "<html>busy</html>")
    out = str(tmp_path / "out")
    outcomes = run(spark, str(tmp_path), out, ("bronze", "silver"), payloads=True)
    assert outcomes["bronze"].rows == {"bronze_ohlc": 80, "bronze_market": 70, "market_bodies_uneven": 2}
    assert outcomes["silver"].rows == {"silver_enriched": 70, "price_rows_merged": 0}
    assert spark.read.parquet(f"{out}/quarantine/market").count() == 1


def test_a_clean_source_leaves_no_quarantine(spark, raw_zone, tmp_path):  # noqa: F811
    for kind in ("ohlc", "market"):
        for folder, runs in (("bad", (FIRST, SECOND)), ("worse", (SECOND,))):
            for name in runs:
                put(raw_zone / f"{kind}/{folder}/{name}.json", "[]")
    out = tmp_path / "clean"
    assert run(spark, str(raw_zone), str(out), ("bronze",))["bronze"].ok
    assert not (out / "quarantine").exists()


def bar_rows(coin: str, stamps: list[int]) -> str:
    rows = [{"coin_id": coin, "timestamp_ms": t, "open": 10.0 + i, "high": 12.0 + i, "low": 9.0 + i, "close": 11.0 + i} for i, t in enumerate(stamps)]
    return json.dumps(rows)


def measure_rows(coin: str, stamps: list[int]) -> str:
    rows = [{"coin_id": coin, "timestamp_ms": t, "price_usd": 1.0, "market_cap_usd": 100.0 + i, "total_volume_usd": 5.0} for i, t in enumerate(stamps)]
    return json.dumps(rows)


def test_no_price_row_vanishes(spark, tmp_path):
    """Thirty four-hourly bars over five days: merged into true daily bars, or all kept."""
    stamps = [START_MS + i * DAY_MS // 6 for i in range(30)]
    put(tmp_path / f"raw/ohlc/a/{FIRST}.json", bar_rows("a", stamps))
    put(tmp_path / f"raw/market/a/{FIRST}.json", measure_rows("a", [START_MS + d * DAY_MS for d in range(5)]))
    merged = run(spark, str(tmp_path / "raw"), str(tmp_path / "merged"), ("bronze", "silver"))
    assert merged["silver"].rows == {"silver_enriched": 5, "price_rows_merged": 25}
    first = spark.read.parquet(str(tmp_path / "merged/silver_enriched")).orderBy("event_date").first()
    assert (first.open, first.high, first.low, first.close) == (10.0, 17.0, 9.0, 16.0)
    kept = run(spark, str(tmp_path / "raw"), str(tmp_path / "all"), ("bronze", "silver"), days="all")
    assert kept["silver"].rows == {"silver_enriched": 30}
    rows = spark.read.parquet(str(tmp_path / "all/silver_enriched")).orderBy("event_ts").collect()
    assert [r.close for r in rows] == [11.0 + i for i in range(30)]
    assert rows[7].pct_change_7d == pytest.approx((18.0 / 11.0 - 1) * 100) and rows[-1].rsi_14 == 100.0


def test_keys_keep_their_text(spark, tmp_path):
    keys = ["007", "7", "1e5", "2024-01-01", "a b", "__", "__x", "é+%/"]
    for i, key in enumerate([*keys, ""]):
        stamps = [START_MS + d * DAY_MS for d in range(4)]
        put(tmp_path / f"raw/ohlc/k{i}/{FIRST}.json", bar_rows(key, stamps))
        put(tmp_path / f"raw/market/k{i}/{FIRST}.json", measure_rows(key, stamps))
    out = str(tmp_path / "out")
    outcomes = run(spark, str(tmp_path / "raw"), out)
    assert all(o.ok for o in outcomes.values()), outcomes
    assert outcomes["bronze"].rows == {"bronze_ohlc": 36, "bronze_market": 36}
    for name in ("bronze_ohlc", "silver_enriched", "gold_daily_summary"):
        table = read_table(spark, f"{out}/{name}")
        assert dict(table.dtypes)["coin_id"] == "string"
        assert {r.coin_id: r["count"] for r in table.groupBy("coin_id").count().collect()} == {k: 4 for k in [*keys, ""]}


@pytest.mark.parametrize("partition_by", [("coin_id",), ()])
def test_sources_without_accepted_rows(spark, tmp_path, partition_by):
    put(tmp_path / f"raw/ohlc/a/{FIRST}.json", "{damaged")
    put(tmp_path / f"raw/market/a/{FIRST}.json", "[]")
    out = str(tmp_path / "out")
    outcomes = run(spark, str(tmp_path / "raw"), out, partition_by=partition_by)
    assert all(o.ok for o in outcomes.values()), outcomes
    assert outcomes["bronze"].rows == {"bronze_ohlc": 0, "bronze_market": 0}
    assert spark.read.parquet(f"{out}/quarantine/ohlc").count() == 1
    put(tmp_path / f"raw/market/b/{FIRST}.json", measure_rows("b", [START_MS]))
    again = run(spark, str(tmp_path / "raw"), out, partition_by=partition_by)
    assert again["bronze"].rows["bronze_market"] == 1 and again["silver"].rows["silver_enriched"] == 0 and again["gold"].ok


def test_damaged_bodies_leave_a_trace(spark, tmp_path):
    good = [[START_MS + i * DAY_MS, 1.0, 2.0, 0.5, 1.5] for i in range(3)]
    good[1][1] = "x"
    put(tmp_path / f"raw/ohlc/my coin+é%41/{FIRST}.json", json.dumps(good))
    put(tmp_path / f"raw/ohlc/b/{FIRST}.json", "<html>")
    points = [[START_MS + i * DAY_MS, 5.0] for i in range(3)]
    put(tmp_path / f"raw/market/a/{FIRST}.json", json.dumps({"status": {"error_code": 429}}))
    put(tmp_path / f"raw/market/b/{FIRST}.json", json.dumps({"prices": points, "market_caps": points, "total_volumes": points[:2]}))
    out = str(tmp_path / "out")
    outcomes = run(spark, str(tmp_path / "raw"), out, ("bronze",), payloads=True)
    assert outcomes["bronze"].rows == {"bronze_ohlc": 3, "bronze_market": 2, "market_bodies_uneven": 1}
    bars = read_table(spark, f"{out}/bronze_ohlc").orderBy("timestamp_ms").collect()
    assert [r.open for r in bars] == [1.0, None, 1.0] and {r.coin_id for r in bars} == {"my coin+é%41"}
    rejected = {s: [(r._quarantine_reason, r._body) for r in spark.read.parquet(f"{out}/quarantine/{s}").collect()] for s in ("ohlc", "market")}
    assert rejected == {"ohlc": [("unreadable_body", "<html>")], "market": [("body_without_arrays", '{"status": {"error_code": 429}}')]}
