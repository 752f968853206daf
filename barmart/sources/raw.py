"""Raw JSON zone: one file per series and run, ``<kind>/<key>/<run>.json``, all runs kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from barmart.schemas import RAW_MARKET, RAW_OHLC


def path_part(file: Column, pattern: str) -> Column:
    """First group of ``pattern`` in a file's URI, decoded; a plus sign stays one."""
    return F.url_decode(F.replace(F.regexp_extract(file, pattern, 1), F.lit("+"), F.lit("%2B")))


def run_id(file: Column) -> Column:
    """Run a raw file belongs to: its name without the extension."""
    return path_part(file, r"([^/]+)\.json$")


def key_of(file: Column) -> Column:
    """Series a raw file belongs to: the name of its folder."""
    return path_part(file, r"([^/]+)/[^/]+$")


def _lineage(df: DataFrame) -> DataFrame:
    file = F.col("_metadata.file_path")
    return df.select("*", file.alias("_source_file"), run_id(file).alias("_run_id")).withColumn(
        "_ingested_at", F.current_timestamp()
    )


def _reader(spark: SparkSession, stream: bool) -> DataFrameReader | DataStreamReader:
    """Of all files, or of a stream of those not read yet, however old they are."""
    return spark.readStream.option("maxFileAge", "36500d") if stream else spark.read


def _read_runs(spark: SparkSession, raw: str, kind: str, schema: T.StructType, stream: bool) -> DataFrame:
    """Rows of every run of every series; an unreadable file yields one row with null fields."""
    return _lineage(_reader(spark, stream).schema(schema).option("multiLine", True).json(f"{raw}/{kind}/*/*.json"))


def read_ohlc(spark: SparkSession, raw: str, stream: bool = False) -> DataFrame:
    return _read_runs(spark, raw, "ohlc", RAW_OHLC, stream)


def read_market(spark: SparkSession, raw: str, stream: bool = False) -> DataFrame:
    return _read_runs(spark, raw, "market", RAW_MARKET, stream)


def read_payloads(spark: SparkSession, raw: str, kind: str, stream: bool = False) -> DataFrame:
    """Whole response bodies laid out like the raw zone: coin_id (directory name), payload, lineage."""
    files = _lineage(_reader(spark, stream).text(f"{raw}/{kind}/*/*.json", wholetext=True))
    return files.withColumnRenamed("value", "payload").withColumn("coin_id", key_of(F.col("_source_file")))
