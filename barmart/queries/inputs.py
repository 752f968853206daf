"""Bar tables derived from the given tables.

Prices are whole numbers, so sums and means are exact and independent of row order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# How rows are dealt out before they are summed up: by default as they lie.
Lay = Callable[[DataFrame], DataFrame]


def as_it_lies(lines: DataFrame) -> DataFrame:
    return lines


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(value: Column) -> Column:
    return F.floor(value).cast("double")


def _bars(trades: DataFrame, *more: Column) -> DataFrame:
    """Bar of each (coin_id, event_date) from price and seq, pre-aggregated before the exchange."""
    return trades.groupBy("coin_id", "event_date").agg(
        F.min_by("price", "seq").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "seq").alias("close"),
        *more,
    )


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as trades of their supplier; ``seq`` orders the trades of a day totally."""
    price = F.floor("l_extendedprice")
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("coin_id"),
        F.to_date("l_shipdate").alias("event_date"),
        price.cast("double").alias("price"),
        (line * 200_000 + price).alias("seq"),
        F.col("l_quantity").alias("quantity"),
    )


def supplier_prices(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    return _bars(lay(supplier_lines(spark, sf_dir)))


def supplier_measures(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    return (
        lay(supplier_lines(spark, sf_dir))
        .groupBy("coin_id", "event_date")
        .agg(F.sum("price").alias("market_cap_usd"), F.sum("quantity").alias("total_volume_usd"))
    )


def supplier_bars(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    """Some 530 bars per supplier: long series, and a key count that grows with the data.

    ``lay`` may deal the lines out by supplier or by day; then the bars are made where their lines are, without an exchange
    by both. As nearly every line is a bar of its own, summing up before an exchange would save no rows.
    """
    return _bars(
        lay(supplier_lines(spark, sf_dir)),
        F.sum("quantity").alias("total_volume_usd"),
        F.sum("price").alias("market_cap_usd"),
    )


def gap_bars(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    """Supplier bars with one close in eleven and one volume in seven missing."""
    day = F.dayofyear("event_date")
    return supplier_bars(spark, sf_dir, lay).withColumns(
        {
            "close": F.when(day % 11 != 0, F.col("close")),
            "total_volume_usd": F.when(day % 7 != 0, F.col("total_volume_usd")),
        }
    )


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per event type and day; the size is a small count, so ranks tie."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("coin_id"),
        F.to_date("ts").alias("event_date"),
        whole(F.col("value")).alias("price"),
        F.col("event_id").alias("seq"),
        F.col("user_id"),
    )
    return _bars(
        rows,
        F.sum("price").alias("total_volume_usd"),
        F.floor(F.countDistinct("user_id") / 20).cast("double").alias("market_cap_usd"),
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("coin_id"),
        F.to_date("o_orderdate").alias("event_date"),
        whole(F.col("o_totalprice")).alias("price"),
        F.col("o_orderkey").alias("seq"),
    )
    return _bars(orders)


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and volume of each (priority, date), from the line items of its orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_orderpriority").alias("coin_id"), F.to_date("o_orderdate").alias("event_date"))
        .agg(
            F.sum(whole(F.col("l_extendedprice"))).alias("market_cap_usd"),
            F.sum("l_quantity").alias("total_volume_usd"),
        )
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order twice, as two runs of a source: run 2 has another price, some keys are missing."""
    number = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(
        F.when(number % 97 != 0, F.concat_ws("/", "o_orderpriority", number.cast("string"))).alias("coin_id"),
        F.when(number % 89 != 0, F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("timestamp_ms"),
        F.col("o_totalprice"),
    )
    runs = F.explode(F.array(F.lit("20240101T000000"), F.lit("20240102T000000")))
    return orders.withColumn("_run_id", runs).select(
        "coin_id",
        "timestamp_ms",
        F.when(F.col("_run_id") == "20240102T000000", whole(F.col("o_totalprice")) + 1)
        .otherwise(whole(F.col("o_totalprice")))
        .alias("close"),
        "_run_id",
    )


def event_lookup(spark: SparkSession) -> DataFrame:
    """Four of the five event types; the fifth stays without an entry."""
    rows = [("click", "CLK", "act", 2009), ("error", "ERR", "fault", 2015), ("signup", "SGN", "act", 2020), ("view", "VEW", "read", 2017)]
    return spark.createDataFrame(rows, "coin_id string, ticker string, category string, launch_year int")


def supplier_lookup(spark: SparkSession, sf_dir: str, in_credit: bool = False) -> DataFrame:
    """Supplier names as tickers; ``in_credit`` leaves suppliers without a positive balance unknown."""
    suppliers = table(spark, sf_dir, "supplier")
    return (suppliers.filter("s_acctbal > 0") if in_credit else suppliers).select(
        F.col("s_suppkey").alias("coin_id"),
        F.col("s_name").alias("ticker"),
        F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")).alias("category"),
    )


def line_prices(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    """A price row for each line item: several for some (supplier, day)."""
    price, spread = F.col("price"), F.col("quantity")
    return lay(supplier_lines(spark, sf_dir)).select(
        "coin_id",
        "event_date",
        F.col("seq").alias("timestamp_ms"),
        price.alias("open"),
        (price + spread).alias("high"),
        (price - spread).alias("low"),
        (price + 1).alias("close"),
    )


def line_measures(spark: SparkSession, sf_dir: str, lay: Lay = as_it_lies) -> DataFrame:
    """A measure row for each line item."""
    return lay(supplier_lines(spark, sf_dir)).select(
        "coin_id",
        "event_date",
        F.col("seq").alias("timestamp_ms"),
        (F.col("price") * 2).alias("market_cap_usd"),
        F.col("quantity").alias("total_volume_usd"),
    )


def line_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar for each line item: several for some (supplier, day), a few of which share their time stamp too."""
    price, spread = F.col("price"), F.col("quantity")
    hour = F.floor(F.col("seq") / 200_000) % 3
    return supplier_lines(spark, sf_dir).select(
        "coin_id",
        "event_date",
        F.timestamp_micros(F.unix_micros(F.col("event_date").cast("timestamp")) + hour * 3_600_000_000).alias("event_ts"),
        price.alias("open"),
        (price + spread).alias("high"),
        (price - spread).alias("low"),
        (price + 1).alias("close"),
        (price * 2).alias("market_cap_usd"),
        spread.alias("total_volume_usd"),
    )


def write_runs(rows: DataFrame, raw: str, kind: str, run: str) -> None:
    """Rows of bars as a source leaves them: one JSON array for each key (``coin_id``), at ``raw/kind/key/run.json``."""
    spark, written = rows.sparkSession, f"{raw}/_{kind}-{run}"
    bodies = rows.groupBy("coin_id").agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    bodies.withColumnRenamed("coin_id", "key").write.partitionBy("key").text(written)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in files.globStatus(path(f"{written}/key=*/part-*")):
        target = path(f"{raw}/{kind}/{status.getPath().getParent().getName().removeprefix('key=')}")
        files.mkdirs(target)
        files.rename(status.getPath(), path(target, f"{run}.json"))


def raw_order_runs(spark: SparkSession, sf_dir: str, raw: str, run: int) -> None:
    """Price and measure files of the orders: run 1 lacks every third day and has other prices, run 2 is right and whole."""
    ms = (F.unix_seconds(F.col("event_date").cast("timestamp")) * 1000).alias("timestamp_ms")
    prices, measures = order_prices(spark, sf_dir), order_measures(spark, sf_dir)
    if run == 1:
        early = F.dayofyear("event_date") % 3 != 0
        prices = prices.filter(early).withColumn("close", F.col("close") + 1)
        measures = measures.filter(early).withColumn("total_volume_usd", F.lit(1.0))
    name = f"2024010{run}T000000"
    write_runs(prices.select("coin_id", ms, "open", "high", "low", "close"), raw, "ohlc", name)
    price = F.lit(1.0).alias("price_usd")
    write_runs(measures.select("coin_id", ms, price, "market_cap_usd", "total_volume_usd"), raw, "market", name)


def flag_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of a return flag as one long series along a time stamp; a few rows share one."""
    place = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("coin_id"),
        F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + place).alias("event_ts"),
        whole(F.col("l_extendedprice")).alias("close"),
    )
