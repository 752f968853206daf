from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barmart.functions.calendar import iso_week, iso_year, with_calendar
from barmart.operators.cleaning import accepted_rows, newest_per, rejected_rows
from tests.conftest import plan_of


def test_calendar_columns(spark):
    df = with_calendar(spark.createDataFrame([(1704067199999,), (None,), (2**62,)], "timestamp_ms long"))
    first, missing, absurd = df.select(F.col("event_ts").cast("string").alias("ts"), "event_date", "event_year", "event_month").collect()
    assert (first.ts, str(first.event_date), first.event_year, first.event_month) == ("2023-12-31 23:59:59.999", "2023-12-31", 2023, 12)
    assert missing.ts is None and absurd.ts is None


def test_iso_weeks(spark):
    days = ["2024-12-30", "2025-01-02", "2024-01-03", "2021-01-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    got = [tuple(r) for r in df.select(iso_year(F.col("d")), iso_week(F.col("d"))).collect()]
    assert got == [(2025, 1), (2025, 1), (2024, 1), (2020, 53)]


def test_rows_without_a_key_are_set_aside(spark):
    rows = [("a", 1), (None, 1), ("b", None), ("c", 2**62)]
    df = with_calendar(spark.createDataFrame(rows, "coin_id string, timestamp_ms long"))
    assert [r.coin_id for r in accepted_rows(df).collect()] == ["a"]
    rejected = rejected_rows(df).collect()
    assert {r.coin_id for r in rejected} == {None, "b", "c"}
    assert {r._quarantine_reason for r in rejected} == {"null_key_field"}


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_newest_copy_wins_in_any_layout(spark, partitions):
    rows = [("a", 1, "20240101T000000", 5.0), ("a", 1, "20240102T000000", 4.0), ("a", 2, "20240101T000000", 1.0)]
    rows += [("hot", 1, "20240101T000000", float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "coin_id string, timestamp_ms long, _run_id string, close double")
    kept = newest_per(df.repartition(partitions), ["coin_id", "timestamp_ms"], ["_run_id"])
    assert sorted((r.coin_id, r.timestamp_ms, r.close) for r in kept.collect()) == [("a", 1, 4.0), ("a", 2, 1.0), ("hot", 1, 499.0)]


def test_copies_are_cut_before_the_exchange(spark):
    df = spark.createDataFrame([("a", 1, "r", 1.0)], "coin_id string, timestamp_ms long, _run_id string, close double")
    plan = plan_of(newest_per(df, ["coin_id", "timestamp_ms"], ["_run_id"]))
    below = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in below and "Partial" in below
