"""How rows spread: per key and per partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKEWED_RATIO = 5


def rows_per_key(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("count")).orderBy(F.desc("count"), key)


def partition_rows(df: DataFrame) -> DataFrame:
    """(partition, rows) of each partition, empty ones included: counts by partition number beside the range of all numbers."""
    counted = df.select(F.spark_partition_id().alias("partition")).groupBy("partition").agg(F.count("*").alias("rows"))
    every = df.sparkSession.range(df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition"))
    return every.join(counted, "partition", "left").select("partition", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"))


def partition_skew(df: DataFrame, skewed_ratio: float = SKEWED_RATIO) -> DataFrame:
    """One row: largest and smallest partition, their ratio (infinite if one is empty), and a flag."""
    spread = partition_rows(df).agg(
        F.count("*").alias("partitions"), F.max("rows").alias("max_rows"), F.min("rows").alias("min_rows")
    )
    quotient = F.when(F.col("min_rows") > 0, F.col("max_rows") / F.col("min_rows")).otherwise(F.lit(float("inf")))
    return spread.withColumn("ratio", quotient).withColumn("skewed", F.col("ratio") > skewed_ratio)
