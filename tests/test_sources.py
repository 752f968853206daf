from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from barmart.functions.calendar import with_calendar
from barmart.operators.cleaning import rejected_rows
from barmart.plans.layers import clean
from barmart.sources import payloads
from barmart.sources.payloads import flatten_ohlc, zip_market
from barmart.sources.raw import read_market, read_ohlc, read_payloads
from barmart.sources.tables import append_table, held, read_table, write_table
from tests.conftest import plan_of

FIRST, SECOND = "20240101T000000", "20240102T000000"
DAY_MS = 86_400_000
START_MS = 1_704_067_200_000


def put(path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def ohlc_rows(coin: str, days: int, shift: float = 0.0) -> list[dict]:
    return [
        {"coin_id": coin, "timestamp_ms": START_MS + i * DAY_MS, "open": 10.0 + i, "high": 12.0 + i, "low": 9.0 + i, "close": 11.0 + i + shift}
        for i in range(days)
    ]


def market_rows(coin: str, days: int) -> list[dict]:
    return [
        {"coin_id": coin, "timestamp_ms": START_MS + i * DAY_MS, "price_usd": 11.0 + i, "market_cap_usd": 1000.0 + i, "total_volume_usd": 5.0 + i}
        for i in range(days)
    ]


@pytest.fixture
def raw_zone(tmp_path):
    """Two runs of two series, and three damaged rows in each source."""
    for coin in ("bitcoin", "ethereum"):
        put(tmp_path / f"ohlc/{coin}/{FIRST}.json", json.dumps(ohlc_rows(coin, 40)))
        put(tmp_path / f"ohlc/{coin}/{SECOND}.json", json.dumps(ohlc_rows(coin, 45, shift=0.5)))
        put(tmp_path / f"market/{coin}/{FIRST}.json", json.dumps(market_rows(coin, 42)))
    for kind in ("ohlc", "market"):
        put(tmp_path / f"{kind}/bad/{FIRST}.json", "{not json")
        put(tmp_path / f"{kind}/bad/{SECOND}.json", json.dumps([{"coin_id": None, "timestamp_ms": 1}]))
        put(tmp_path / f"{kind}/worse/{SECOND}.json", json.dumps([{"coin_id": "worse", "timestamp_ms": "soon"}]))
    return tmp_path


def test_all_runs_are_read_with_their_origin(spark, raw_zone):
    df = read_ohlc(spark, str(raw_zone))
    good = df.filter(F.col("coin_id") == "bitcoin")
    assert good.count() == 85
    assert {r._run_id for r in good.select("_run_id").distinct().collect()} == {FIRST, SECOND}
    origin = good.filter(F.col("_run_id") == SECOND).first()._source_file
    assert origin.endswith(f"/ohlc/bitcoin/{SECOND}.json")
    assert df.select("_ingested_at").distinct().count() == 1
    assert read_market(spark, str(raw_zone)).filter("coin_id = 'ethereum'").count() == 42


def test_damaged_rows_are_rejected_and_later_runs_win(spark, raw_zone):
    rows = with_calendar(read_ohlc(spark, str(raw_zone)))
    rejected = rejected_rows(rows).collect()
    assert len(rejected) == 3
    assert any("{not json" in (r._corrupt_record or "") for r in rejected)
    kept = clean(rows).collect()
    assert len(kept) == 90 and {r._run_id for r in kept} == {SECOND}


def test_ohlc_payload(spark):
    body = json.dumps([[START_MS, 1, 2, 3, 4.5], [START_MS + 1, 5, 6, 7]])
    df = spark.createDataFrame([("a", body), ("empty", "[]"), ("broken", "{")], "coin_id string, payload string")
    got = [tuple(r) for r in flatten_ohlc(df, ["coin_id"]).collect()]
    assert got == [
        ("a", START_MS, 1.0, 2.0, 3.0, 4.5, None, None),
        ("a", START_MS + 1, 5.0, 6.0, 7.0, None, None, None),
        ("broken", None, None, None, None, None, "unreadable_body", "{"),
    ]


def test_market_payload_stops_at_the_shortest(spark):
    def points(values):
        return [[START_MS + i, v] for i, v in enumerate(values)]

    bodies = {
        "uneven": {"prices": points([1, 2, 3]), "market_caps": points([4, 5]), "total_volumes": points([6, 7, 8])},
        "absent": {"prices": points([1, 2]), "total_volumes": points([6, 7])},
        "even": {"prices": points([1]), "market_caps": points([2]), "total_volumes": points([3])},
    }
    texts = [(k, json.dumps(v)) for k, v in bodies.items()] + [("broken", "{not")]
    df = spark.createDataFrame(texts, "coin_id string, payload string")
    got = [tuple(r) for r in zip_market(df, ["coin_id"]).collect()]
    assert got == [
        ("uneven", START_MS, 1.0, 4.0, 6.0, True, None, None),
        ("uneven", START_MS + 1, 2.0, 5.0, 7.0, True, None, None),
        ("absent", None, None, None, None, True, "body_without_arrays", texts[1][1]),
        ("even", START_MS, 1.0, 2.0, 3.0, False, None, None),
        ("broken", None, None, None, None, False, "unreadable_body", "{not"),
    ]


def test_payload_files(spark, tmp_path):
    put(tmp_path / f"ohlc/solana/{FIRST}.json", json.dumps([[START_MS, 1, 2, 3, 4]], indent=1))
    df = flatten_ohlc(read_payloads(spark, str(tmp_path), "ohlc"), ["coin_id", "_run_id"])
    assert [tuple(r) for r in df.collect()] == [("solana", FIRST, START_MS, 1.0, 2.0, 3.0, 4.0, None, None)]


def test_tables_are_written_partitioned_and_pruned(spark, tmp_path, steady_bars):
    path = str(tmp_path / "bars")
    assert write_table(steady_bars, path, ("coin_id",)) == 90
    back = read_table(spark, path)
    assert back.count() == 90
    one = back.filter(F.col("coin_id") == "bitcoin")
    assert one.count() == 30
    assert re.search(r"PartitionFilters: \[[^\]]*coin_id", plan_of(one))
    assert write_table(steady_bars.withColumn("extra", F.lit(1)), path, ("coin_id",)) == 90
    assert "extra" in read_table(spark, path).columns
    files = list((tmp_path / "bars").glob("coin_id=*/*.parquet"))
    assert len(files) == 3


def test_append_and_hold(spark, tmp_path, steady_bars):
    path = str(tmp_path / "log")
    for _ in range(2):
        append_table(steady_bars, path)
    with held(read_table(spark, path)) as kept:
        assert kept.is_cached and kept.count() == 180
    assert not kept.is_cached


def test_numbers_of_bodies_as_casts_read_them(spark):
    """The guarded casts give what tried casts give, for every form of a number, and for what is none."""
    forms = ["1", "-7", "+7", "007", "1.5", "-1.5e3", "1E12", "1.7E12", "1700000000000.0", "1.7e12", ".5", "5.", " 12 ", "1e400", "1e-5", "NaN", "Infinity",
             "-Infinity", "inf", "", " ", "x", "1x", "--1", "1,5", "0x10", "1e", "e5", "9" * 18, "9" * 19, "9" * 30, "-" + "9" * 18, None]
    df = spark.createDataFrame([(f,) for f in forms], "v string")
    value = F.col("v")
    double = value.try_cast("double")
    plain = df.select("v", F.coalesce(value.try_cast("long"), double.try_cast("long")).alias("ms"), double.alias("number"))
    guarded = df.select("v", payloads._millis(value).alias("ms"), payloads._number(value).alias("number"))
    for want, got in zip(plain.collect(), guarded.collect()):
        if want.v == "9" * 19 or want.v == "9" * 30 or want.v in ("Infinity", "-Infinity", "inf", "1e400"):
            assert got.ms is None, want.v  # beyond any time; a tried cast of such a number is null or the largest long
        else:
            assert got.ms == want.ms, want.v
        assert str(got.number) == str(want.number), want.v
