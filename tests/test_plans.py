"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from barmart.operators import features
from barmart.operators.ranking import top_per_key
from barmart.plans import gold
from barmart.queries.catalog import QUERIES
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"


def _stored(bars):
    """Bars with constant feature columns, as if read from a silver table."""
    return bars.withColumns({"pct_change_1d": F.lit(1.0), "rsi_14": F.lit(1.0), "market_regime": F.lit("")})


def test_series_features_share_one_exchange(steady_bars):
    for add in (features.add_rolling, features.add_vwap, features.add_momentum):
        assert plan_of(add(steady_bars)).count("Exchange") == 1
    plan = plan_of(features.enrich(steady_bars, dates_fit=True))
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["coin_id", "event_date"]


def test_split_ranking_never_gathers_a_group(steady_bars):
    """The only window by date alone runs over slot totals."""
    plan = plan_of(features.add_daily_ranking(steady_bars))
    lines = [line for line in plan.splitlines() if "Window [" in line and "windowspecdefinition(event_date#" in line]
    assert lines and all("_slot" in line for line in lines)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("EvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in plan


def test_key_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["filter_partition_key"](spark, SF))
    assert "EqualTo(event_type,click)" in plan


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(QUERIES["rows_per_key"](spark, SF))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["l_suppkey:bigint,l_shipdate:timestamp_ntz"]


def test_top_rows_are_limited_before_the_exchange(steady_bars):
    plan = plan_of(top_per_key(steady_bars, "coin_id", "close", 5, ["event_date"]))
    assert "Partial" in plan[plan.index("Exchange hashpartitioning") :]
    assert plan.count("WindowGroupLimit") == 2


def test_cut_series_never_gather_a_key(steady_bars):
    """Of a whole key only hourly counts and one row per block meet in one window."""
    timed = steady_bars.withColumn("event_date", F.col("event_date").cast("timestamp"))
    lines = [line for line in plan_of(features.enrich(timed)).splitlines() if "Window [" in line]
    by_key = [line for line in lines if re.search(r"\], \[coin_id#\d+\], \[", line)]
    assert by_key
    for line in by_key:
        assert re.search(r"\[coin_id#\d+\], \[(_hour|_block)#", line), line


def test_sorted_report_needs_one_exchange(steady_bars):
    plan = plan_of(gold.volatility_report(_stored(steady_bars)))
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1


def test_preview_is_a_bounded_sort(spark):
    assert "TakeOrderedAndProject(limit=10" in plan_of(QUERIES["limit_preview"](spark, SF))


def test_aggregates_combine_before_the_exchange(spark):
    plan = plan_of(QUERIES["avg_close_per_key"](spark, SF))
    assert plan.count("partial_") >= 2 and "SortAggregate" not in plan


def test_stored_tables_are_pruned(spark):
    """By a key known beforehand, and by the keys that a lookup turns out to hold."""
    plan = plan_of(QUERIES["filter_stored_key"](spark, SF))
    assert "PartitionFilters: [(CASE WHEN StartsWith(o_orderpriority" in plan
    plan = plan_of(QUERIES["pruned_by_lookup"](spark, SF))
    assert "SubqueryAdaptiveBroadcast dynamicpruning" in plan
