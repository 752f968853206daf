from __future__ import annotations

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barmart.operators.ranking import groups_fit, rank_values, slot_limits, slot_of, top_per_key

NAMES = {"rank": "r", "dense_rank": "d", "percent_rank": "p"}


def mixed_values(seed: int, n: int) -> list[float | None]:
    pick = random.Random(seed)
    makers = [
        lambda: None,
        lambda: 0.0,
        lambda: float(pick.randint(-5, 5)),
        lambda: pick.uniform(-1e-7, 1e-7),
        lambda: pick.uniform(-1, 1) * 10 ** pick.randint(-3, 12),
    ]
    return [pick.choice(makers)() for _ in range(n)]


@pytest.fixture(scope="module")
def groups(spark):
    rows = [(g, i, v) for g in range(3) for i, v in enumerate(mixed_values(g, 400))]
    rows += [(7, 0, 4.0), (8, 0, None), (8, 1, None), (None, 0, 1.0), (None, 1, 2.0)]
    return spark.createDataFrame(rows, "g int, i int, v double"), rows


@pytest.mark.parametrize("fits", [False, True])
def test_ranks_equal_a_count_of_larger_values(groups, fits):
    df, rows = groups
    got = {(r.g, r.i): (r.r, r.d, r.p) for r in rank_values(df, ["g"], "v", NAMES, fits).collect()}
    assert len(got) == len(rows)
    by_group: dict = {}
    for g, _, v in rows:
        by_group.setdefault(g, []).append(v)
    for g, i, v in rows:
        others = by_group[g]
        known = [o for o in others if o is not None]
        larger = known if v is None else [o for o in known if o > v]
        share = len(larger) / (len(others) - 1) if len(others) > 1 else 0.0
        rank, dense, percent = got[g, i]
        assert (rank, dense) == (len(larger) + 1, len(set(larger)) + 1), (g, i, v)
        assert percent == pytest.approx(share)


def test_other_types_and_nan(spark):
    whole = spark.createDataFrame([(1, 5), (1, None), (1, 9), (1, 9)], "g int, v bigint")
    assert sorted(r.r for r in rank_values(whole, ["g"], "v", {"rank": "r"}).collect()) == [1, 1, 3, 4]
    nan = spark.createDataFrame([(1, float("nan")), (1, float("inf")), (1, 1.0), (1, float("-inf"))], "g int, v double")
    got = {str(r.v): r.r for r in rank_values(nan, ["g"], "v", {"rank": "r"}).collect()}
    assert got == {"nan": 1, "inf": 2, "1.0": 3, "-inf": 4}


@pytest.mark.parametrize("make", [lambda k: float(k), lambda k: 1.0 + k * 1e-12, lambda k: 2.0 ** (k / 40 - 500), lambda k: -1.0 / (k + 1)])
def test_slots_are_even_whatever_the_distribution(spark, monkeypatch, make):
    monkeypatch.setattr("barmart.operators.ranking.SLOT_VALUES", 50)
    df = spark.createDataFrame([(k % 2, make(k)) for k in range(4000)] + [(2, float(k)) for k in range(50)], "g int, v double").withColumn("_rows", F.lit(1))
    placed = df.join(slot_limits(df, ["g"], F.col("v")), "g", "left").withColumn("s", slot_of(F.col("v"), F.col("_limits")))
    pdf = placed.toPandas().sort_values(["g", "v"])
    assert pdf.groupby("g").s.is_monotonic_increasing.all()
    sizes = pdf.groupby(["g", "s"]).size()
    assert len(sizes[0]) == len(sizes[1]) == 40 and sizes[[0, 1]].max() <= 60 and list(sizes[2]) == [50]


def test_slots_of_odd_values(spark):
    rows = [(v,) for v in (None, float("-inf"), 0.0, 1.0, 1.5, 3.0, float("inf"), float("nan"))]
    df = spark.createDataFrame(rows, "v double")
    got = df.select(slot_of(F.col("v"), F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))).alias("s")).collect()
    assert [r.s for r in got] == [None, 0, 0, 0, 1, 2, 3, 3]


def test_groups_fit_measures_the_largest(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 40, 1).otherwise(F.col("id")))
    assert groups_fit(df, ["g"], 40) and not groups_fit(df, ["g"], 39)
    assert groups_fit(df.limit(0), ["g"])


def test_top_rows_per_key(spark):
    df = spark.createDataFrame([("a", i, float(i % 4)) for i in range(9)] + [("b", 0, None)], "k string, i int, v double")
    rows = top_per_key(df, "k", "v", 3, ["i"]).collect()
    assert [(r.k, r.i, r.v) for r in rows] == [("a", 3, 3.0), ("a", 7, 3.0), ("a", 2, 2.0)]


def test_crowded_slots_are_divided(spark, monkeypatch):
    monkeypatch.setattr("barmart.operators.ranking.SLOT_VALUES", 10)
    rows = [(k % 2, 1000.0 + k // 3 / 1e6) for k in range(900)] + [(0, None), (0, float("nan")), (1, float("inf")), (1, -1e308)]
    df = spark.createDataFrame(rows, "g int, v double")
    names = {"rank": "r", "dense_rank": "d", "percent_rank": "p"}
    split, plain = (rank_values(df, ["g"], "v", names, fits).select("g", "v", "r", "d", F.round("p", 9)) for fits in (False, True))
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    assert dict(split.dtypes)["r"] == "bigint"


def test_working_names_are_refused(spark):
    with pytest.raises(ValueError):
        rank_values(spark.createDataFrame([(1, 1.0, 1)], "g int, v double, _slot int"), ["g"], "v", {"rank": "r"})


def test_split_ranks_take_six_exchanges(spark, tmp_path):
    spark.range(5000).select(F.col("id") % 3, F.col("id") / 7).toDF("g", "v").write.parquet(str(tmp_path / "t"))
    ranked = rank_values(spark.read.parquet(str(tmp_path / "t")), ["g"], "v", NAMES)
    ranked.collect()
    final = ranked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"[- ]Exchange ", final)) <= 6 and "ReusedExchange" in final
