from __future__ import annotations

import math

from pyspark.sql import functions as F

from barmart.operators.layout import partition_rows, partition_skew, rows_per_key


def test_rows_per_key_largest_first(spark):
    df = spark.range(100).withColumn("k", F.when(F.col("id") < 90, "hot").otherwise("cold"))
    assert [(r.k, r["count"]) for r in rows_per_key(df, "k").collect()] == [("hot", 90), ("cold", 10)]


def test_even_partitions(spark):
    row = partition_skew(spark.range(0, 400, 1, 4)).first()
    assert (row.partitions, row.max_rows, row.min_rows, row.ratio, row.skewed) == (4, 100, 100, 1.0, False)


def test_an_empty_partition_counts(spark):
    df = spark.range(0, 400, 1, 4).filter(F.col("id") < 250)
    assert sorted(r.rows for r in partition_rows(df).collect()) == [0, 50, 100, 100]
    row = partition_skew(df).first()
    assert math.isinf(row.ratio) and row.skewed
