from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

BAR_SCHEMA = (
    "coin_id string, event_date date, open double, high double, low double, close double, "
    "total_volume_usd double, market_cap_usd double"
)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def steady_bars(spark) -> DataFrame:
    """Three series of 30 days, each rising by one percent of its base a day."""
    # Keys, bases and factors of the expected results in FIXTURES.md (F1).
    rows = []
    for coin, base in {"bitcoin": 40000.0, "ethereum": 2000.0, "solana": 100.0}.items():
        for day in range(30):
            close = base + day * base * 0.01
            when = date(2024, 1, 1) + timedelta(days=day)
            volume = 1e6 * (day + 1)
            rows.append((coin, when, close * 0.99, close * 1.02, close * 0.97, close, volume, close * 19e6))
    return spark.createDataFrame(rows, BAR_SCHEMA)


@pytest.fixture
def series(spark):
    """Bars of named series from their closes, one per day; other columns follow the close."""

    def build(closes: dict[str, list[float | None]], start: date = date(2001, 1, 1)) -> DataFrame:
        rows = []
        for coin, values in closes.items():
            for i, close in enumerate(values):
                known = close or 1.0
                rows.append(
                    (coin, start + timedelta(days=i), known, known + 2, known - 2, close, 10.0 + i % 7, known * (1 + i % 3))
                )
        return spark.createDataFrame(rows, BAR_SCHEMA)

    return build


def plan_of(df: DataFrame) -> str:
    import contextlib
    import io

    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()
