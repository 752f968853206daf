"""Steps that must not repeat whole tables, and blocks whose limits are found without numbering rows."""

from __future__ import annotations

import math
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barmart.operators import features
from barmart.operators import series as series_module
from barmart.operators.rsi import add_rsi
from barmart.operators.series import BLOCK, CORE, cut_series, short_series
from barmart.plans import gold
from barmart.queries import catalog
from barmart.queries.catalog import QUERIES
from barmart.schemas import Bars
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
SCHEMA = "coin_id string, event_ts timestamp, close double"
ROLES = Bars(time="event_ts", ties=("close",))


def stamped(rows=9000, seed=1):
    """A long series with crowded seconds and gaps, a short one, and rows without key or time."""
    rng, at, out = random.Random(seed), datetime(2024, 1, 1), []
    for i in range(rows):
        at += timedelta(microseconds=rng.choice([1, 1, 1, 300_000, 1_700_000, 5_000_000_000]) if i % 3000 > 700 else 1)
        out.append(("long", at, float(rng.randrange(50, 60))))
    out += [("short", datetime(2024, 1, 1) + timedelta(hours=i), float(i % 7)) for i in range(40)]
    out += [("long", None, float(i)) for i in range(20)] + [(None, datetime(2024, 1, 1), float(i)) for i in range(5)]
    return out


def values(df):
    return sorted(str(tuple(round(v, 7) if isinstance(v, float) else v for v in row)) for row in df.collect())


@pytest.mark.parametrize(("block", "history"), [(50, 50), (300, 30), (5000, 4096)])
def test_blocks_hold_each_row_once_and_enough_history(spark, block, history):
    rows = stamped()
    random.Random(2).shuffle(rows)
    cut = cut_series(spark.createDataFrame(rows, SCHEMA), ROLES, history, block).collect()
    place = lambda r: (r[1] or datetime.min, r[2])
    assert sorted(((r[0] or "", *place(r)) for r in cut if r[CORE])) == sorted((r[0] or "", *place(r)) for r in rows)
    whole = sorted((r for r in rows if r[0] == "long"), key=place)
    blocks = {}
    for r in cut:
        if r.coin_id == "long":
            blocks.setdefault(r[BLOCK], []).append(r)
        else:
            assert r[BLOCK] == 0 and r[CORE]
    kept = [b for b in sorted(blocks) if any(r[CORE] for r in blocks[b])]
    assert len(kept) > 1
    for b in kept:
        held = sorted(map(place, blocks[b]))
        first = min(place(r) for r in blocks[b] if r[CORE])
        before = [place(r) for r in whole if place(r) < first]
        assert held[: len(held) - sum(r[CORE] for r in blocks[b])][-history:] == before[-history:]


def test_cut_and_short_series_agree(spark, monkeypatch):
    monkeypatch.setattr(series_module, "BLOCK_ROWS", 4096)
    df = spark.createDataFrame(stamped(), SCHEMA)
    whole = Bars(time="event_ts", ties=("close",), short=True)
    assert values(add_rsi(df, ROLES, unique=True)) == values(add_rsi(df, whole, unique=True))
    assert values(features.add_rolling(df, ROLES, block_rows=60, unique=True)) == values(features.add_rolling(df, whole, unique=True))


def test_cheaper_table_of_places(spark):
    df = spark.createDataFrame(stamped(2000), SCHEMA)
    wide = df.withColumn("more", F.lit(1))
    assert values(features.add_rolling(wide, ROLES, 60, True, places_from=df)) == values(features.add_rolling(wide, ROLES, 60, True))


def test_short_series_are_measured(spark):
    df = spark.createDataFrame(stamped(500), SCHEMA)
    assert short_series(df, ROLES).short and short_series(df, ROLES, 520).short and not short_series(df, ROLES, 519).short
    assert short_series(df.limit(0), ROLES).short


def test_a_cut_moves_whole_rows_once(steady_bars):
    timed = steady_bars.withColumn("event_date", F.col("event_date").cast("timestamp"))
    lines = plan_of(features.add_rolling(timed, unique=True)).splitlines()
    assert sum(bool(re.search(r"Exchange hashpartitioning\(coin_id#\d+, _block#", line)) for line in lines) == 1
    assert "row_number" not in "\n".join(lines)


def test_doubles_are_rounded_without_decimal_digits(spark):
    """Halves go away from zero; large, infinite and missing values stay."""
    given = [0.1953125, -0.1953125, 2.5e-7, 0.4999995, 1e300, -1e18, 123456789.123456789, float("inf"), -0.0, None]
    df = spark.createDataFrame([(v,) for v in given], "avg_close double").repartition(1)
    rounded = catalog._rounded(df)
    assert [r[0] for r in rounded.collect()] == [0.195313, -0.195313, 0.0, 0.5, 1e300, -1e18, 123456789.123457, float("inf"), 0.0, None]
    assert "round(" not in plan_of(rounded)
    (nan,) = catalog._rounded(spark.createDataFrame([(float("nan"),)], "avg_close double")).first()
    assert nan != nan


def test_halves_next_to_halves(spark):
    """The neighbours of a half are no halves; the sign of zero stays."""
    wide = [k + d for k in (0.0, 1.0, 2.0, 7.0) for d in (0.5, 0.5 - 2.0**-54, 0.5 - 2.0**-51, 0.5 + 2.0**-51)]
    given = [s * w / 1e6 for w in [*wide, 0.2, 2.0**51 + 0.5, 2.0**51 + 1.5] for s in (1, -1)]
    df = spark.createDataFrame([(v,) for v in given], "avg_close double").repartition(1)
    for value, near in df.select(F.col("avg_close").alias("value"), catalog._round("avg_close")).collect():
        whole = math.floor(abs(value * 1e6))
        want = math.copysign((whole + (abs(value * 1e6) - whole >= 0.5)) / 1e6, value)
        assert near == want and math.copysign(1, near) == math.copysign(1, want)


@pytest.mark.parametrize("name", ["silver_split", "silver_repeated_days", "silver_enriched", "daily_summary"])
def test_generated_methods_are_short_enough_to_be_compiled(spark, name):
    """The JVM interprets methods of more than 8,000 bytes for ever."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        query = QUERIES[name](spark, SF)._jdf.queryExecution()
        code = query.explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_split_silver_reads_its_lines_twice_after_its_count(spark):
    """For the bars and for the values of a day; places of blocks aren't counted where no series is cut."""
    plan = plan_of(QUERIES["silver_split"](spark, SF))
    scans = set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan.replace("#", "")))
    assert "_block" not in plan and "_r0" in plan and len({len(s.split(",")) for s in scans}) == 2


# Exchanges of whole bars (not counts of keys, places or lookups) in the plan of a query.
@pytest.mark.parametrize(
    ("name", "most"),
    [("volatility_several_per_day", 1), ("volatility_report", 1), ("topk_volatility", 1), ("daily_summary", 2), ("silver_gaps", 2)],
)
def test_reports_deal_their_rows_out_once(spark, name, most):
    plan = plan_of(QUERIES[name](spark, SF))
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning") == most


def test_silver_deals_lines_out_before_the_bars(spark):
    for name in ("silver_enriched", "silver_several_per_day"):
        plan = plan_of(QUERIES[name](spark, SF))
        first = [line for line in plan.splitlines() if "Exchange hashpartitioning(coin_id" in line and "event_date" in line]
        assert len(first) == 2 and all("REPARTITION_BY_COL" in line for line in first)


def test_ranged_silver_needs_no_exchange_for_its_order(steady_bars):
    silver = features.enrich(steady_bars, dates_fit=True, unique=True, ranged=True)
    plan = plan_of(gold.volatility_report(silver, ranged=True))
    assert plan.count("Exchange") == plan.count("Exchange rangepartitioning") == 1
    assert values(gold.volatility_report(silver, ranged=True)) == values(gold.volatility_report(features.enrich(steady_bars)))
