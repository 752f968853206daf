"""Tables that are brought up to date: bronze from new files, touched partitions, rejects known from before."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barmart.plans.layers import run
from barmart.sources.tables import append_new, merge_newest, read_table, update_table, write_table
from tests.test_layers import bar_rows, measure_rows
from tests.test_sources import DAY_MS, FIRST, SECOND, START_MS, put


def table_rows(spark, path):
    skip = ("_ingested_at",)
    df = read_table(spark, path)
    return sorted(str(r) for r in df.select(*[c for c in sorted(df.columns) if c not in skip]).collect())


def first_files(raw: Path) -> None:
    for coin in ("a", "b"):
        stamps = [START_MS + d * DAY_MS for d in range(10)]
        put(raw / f"ohlc/{coin}/{FIRST}.json", bar_rows(coin, stamps))
        put(raw / f"market/{coin}/{FIRST}.json", measure_rows(coin, stamps))
    put(raw / f"ohlc/bad/{FIRST}.json", "{damaged")
    put(raw / f"ohlc/worse/{FIRST}.json", json.dumps([{"coin_id": None, "timestamp_ms": 1}] * 2))


def second_files(raw: Path) -> None:
    stamps = [START_MS + d * DAY_MS for d in range(5, 15)]
    put(raw / f"ohlc/b/{SECOND}.json", bar_rows("b", stamps))
    put(raw / f"market/b/{SECOND}.json", measure_rows("b", stamps))
    put(raw / f"ohlc/c/{SECOND}.json", bar_rows("c", stamps))
    put(raw / f"market/worse/{SECOND}.json", json.dumps([{"coin_id": "x"}]))


@pytest.mark.parametrize("partition_by", [("coin_id",), ("event_year", "event_month")])
def test_two_runs_equal_one_full_run(spark, tmp_path, partition_by):
    raw, out, full = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "full")
    first_files(raw)
    layers = ("bronze", "silver")
    one = run(spark, str(raw), out, layers, partition_by=partition_by, incremental=True)
    assert one["bronze"].rows == {"bronze_ohlc": 20, "ohlc_files_read": 4, "bronze_market": 20, "market_files_read": 2}
    before = {p: p.stat().st_mtime_ns for p in Path(out, "bronze_ohlc").rglob("coin_id=a/*.parquet")}
    second_files(raw)
    two = run(spark, str(raw), out, layers, partition_by=partition_by, incremental=True)
    assert two["bronze"].rows == {"bronze_ohlc": 35, "ohlc_files_read": 2, "bronze_market": 25, "market_files_read": 2}
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items())  # untouched partitions stay as they are
    again = run(spark, str(raw), out, ("bronze",), partition_by=partition_by, incremental=True)
    assert again["bronze"].rows["ohlc_files_read"] == again["bronze"].rows["market_files_read"] == 0
    assert all(o.ok for o in run(spark, str(raw), full, layers, partition_by=partition_by).values())
    for name in ("bronze_ohlc", "bronze_market", "silver_enriched", "quarantine/ohlc", "quarantine/market"):
        assert table_rows(spark, f"{out}/{name}") == table_rows(spark, f"{full}/{name}"), name


def test_a_run_may_be_full_and_later_ones_incremental(spark, tmp_path):
    """Files that a full run has read are merged once more, which changes nothing."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    first_files(raw)
    assert run(spark, str(raw), out, ("bronze",))["bronze"].ok
    before = {n: table_rows(spark, f"{out}/{n}") for n in ("bronze_ohlc", "bronze_market", "quarantine/ohlc")}
    assert run(spark, str(raw), out, ("bronze",), incremental=True)["bronze"].rows["ohlc_files_read"] == 4
    assert before == {n: table_rows(spark, f"{out}/{n}") for n in before}
    with pytest.raises(ValueError):
        run(spark, str(raw), out, ("bronze",), incremental=True, partition_by=())


def test_a_failed_write_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(100).withColumn("k", (F.col("id") % 5).cast("string")), path, ("k",))
    before = table_rows(spark, path)
    bad = spark.range(100, 120).withColumn("k", (F.col("id") % 2).cast("string"))
    failing = bad.withColumn("id", F.when(F.col("id") == 117, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        update_table(failing, path, ("k",))
    assert table_rows(spark, path) == before
    update_table(bad, path, ("k",))
    kept = {r["k"]: r["count"] for r in read_table(spark, path).groupBy("k").count().collect()}
    assert kept == {"0": 10, "1": 10, "2": 20, "3": 20, "4": 20}


def test_merging_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(k, i, 1, float(i)) for k in ("", "__x", "7") for i in range(4)]
    schema = "k string, i long, run int, v double"
    write_table(spark.createDataFrame(rows, schema), path, ("k",))
    files = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    merge_newest(spark.createDataFrame([("", 1, 2, 9.0), ("", 1, 0, 8.0), ("", 7, 0, 7.0)], schema), path, ("k",), ["k", "i"], ["run"])
    found = {(r.k, r.i): r.v for r in read_table(spark, path).collect()}
    assert found == {(k, i): v for k, i, _, v in rows} | {("", 1): 9.0, ("", 7): 7.0}
    assert sum(p.exists() and p.stat().st_mtime_ns == t for p, t in files.items()) >= 2


def test_known_rows_are_not_appended_again(spark, tmp_path):
    path, schema = str(tmp_path / "q"), "file string, text string, seen int"
    df = spark.createDataFrame([("f", "x", 1), ("f", "x", 1), ("g", None, 1)], schema)
    assert append_new(df, path, ["file", "text"]) and not append_new(df.withColumn("seen", F.lit(2)), path, ["file", "text"])
    assert append_new(spark.createDataFrame([("f", "y", 3), ("g", None, 3)], schema), path, ["file", "text"])
    assert sorted((r.file, r.text, r.seen) for r in read_table(spark, path).collect() if r.text) == [("f", "x", 1), ("f", "x", 1), ("f", "y", 3)]
    assert read_table(spark, path).count() == 4
    assert not append_new(df.limit(0), str(tmp_path / "none"), ["file"]) and not (tmp_path / "none").exists()
