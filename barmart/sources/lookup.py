"""The built-in lookup of series names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barmart.schemas import LOOKUP

# coin_id, ticker, category, launch year.
COINS = [
    ("bitcoin", "BTC", "Layer 1", 2009),
    ("ethereum", "ETH", "Layer 1", 2015),
    ("solana", "SOL", "Layer 1", 2020),
    ("cardano", "ADA", "Layer 1", 2017),
    ("avalanche-2", "AVAX", "Layer 1", 2020),
    ("polkadot", "DOT", "Layer 0", 2020),
    ("chainlink", "LINK", "Oracle", 2017),
    ("litecoin", "LTC", "Layer 1", 2011),
]


def coin_lookup(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COINS, LOOKUP)
