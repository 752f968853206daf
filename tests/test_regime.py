from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from barmart.functions.regime import regime_label

MOVES = [None, -30.0, -10.0, -9.9, -5.0, -2.0, -1.9, 0.0, 2.0, 4.9, 5.0, 10.0, 10.1, 30.0]
SPREADS = [None, 0.0, 5.0, 5.1, 20.0]
INDEXES = [None, 0.0, 29.9, 30.0, 34.9, 35.0, 50.0, 65.0, 65.1, 70.1, 100.0]


def label(df):
    return df.withColumn("label", regime_label(F.col("m"), F.col("s"), F.col("r")))


@pytest.mark.parametrize(
    "values, expected",
    [
        ((15.0, 3.0, 70.0), "trending_bullish"),
        ((-15.0, 3.0, 70.0), "trending_bullish"),
        ((-15.0, 3.0, 20.0), "trending_bearish"),
        ((15.0, 3.0, 50.0), "neutral"),
        ((1.0, 2.0, 50.0), "ranging_quiet"),
        ((1.0, 6.0, 50.0), "ranging_volatile"),
        ((5.0, 6.0, 50.0), "neutral"),
        ((2.0, 5.0, 50.0), "neutral"),
        ((None, None, None), "unknown"),
        ((1.0, None, 50.0), "unknown"),
    ],
)
def test_single_labels(spark, values, expected):
    assert label(spark.createDataFrame([values], "m double, s double, r double")).first().label == expected


def test_grid(spark):
    """All threshold combinations: nulls are unknown, and the reversing labels never come out."""
    grid = list(itertools.product(MOVES, SPREADS, INDEXES))
    rows = label(spark.createDataFrame(grid, "m double, s double, r double")).collect()
    assert len(rows) == len(grid)
    seen = {r.label for r in rows}
    assert seen == {"unknown", "trending_bullish", "trending_bearish", "ranging_volatile", "ranging_quiet", "neutral"}
    for r in rows:
        assert (r.label == "unknown") == (None in (r.m, r.s, r.r))
