"""Stored tables: write, append, read back."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barmart.operators.cleaning import newest_per
from barmart.operators.joins import fits_broadcast

MARK = "__"
SCHEMA_FILE = "_schema.json"


def write_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), fmt: str = "parquet", clustered: bool = False
) -> int:
    """Overwrite a table, its schema included; returns the rows stored.

    Partitioned tables go through Spark's rebalance, which evens out file sizes: small keys
    share a task, a hot key is spread over several. ``clustered`` saves that exchange where
    each partition value already sits in one task. The rows are counted from the stored
    table, which does not run the plan again.
    """
    if partition_by and not clustered:
        df = df.hint("rebalance", *partition_by)
    schema = df.schema
    writer = _marked(df, partition_by).write.format(fmt).mode("overwrite").option("overwriteSchema", True)
    writer.partitionBy(*partition_by).save(path)
    _write_schema(df.sparkSession, path, schema, partition_by)
    return read_table(df.sparkSession, path, fmt).count()


def update_table(df: DataFrame, path: str, partition_by: tuple[str, ...], fmt: str = "parquet") -> None:
    """Overwrite the partitions that ``df`` has rows for, and no other.

    Their files are staged and moved in when every task has ended, so a failed write leaves the
    whole table as it was. ``df`` may read the table itself.
    """
    writer = _marked(df.hint("rebalance", *partition_by), partition_by).write.format(fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    _write_schema(df.sparkSession, path, df.schema, partition_by)


def merge_newest(
    rows: DataFrame, path: str, partition_by: tuple[str, ...], keys: list[str], newest: list[str], fmt: str = "parquet"
) -> None:
    """Bring new rows into a stored table that keeps the newest row of each key; only partitions that they touch are read and
    written. Merging rows twice, or in parts, gives the table that all of them at once would give."""
    if table_exists(rows.sparkSession, path):
        touched = rows.select(*partition_by).distinct()
        touched = F.broadcast(touched) if fits_broadcast(touched) else touched  # broadcast, they prune the scan
        stored = read_table(rows.sparkSession, path, fmt).join(touched, list(partition_by), "left_semi")
        rows = stored.unionByName(rows, allowMissingColumns=True)
    update_table(newest_per(rows, keys, newest), path, partition_by, fmt)


def append_new(df: DataFrame, path: str, same: list[str], fmt: str = "parquet") -> bool:
    """Append the rows that the stored table doesn't hold yet, compared by the columns ``same``; whether there were any.

    Repeated rows of one call all stay, a second call with them adds none.
    """
    if table_exists(df.sparkSession, path):
        place = F.md5(F.to_json(F.struct(*sorted(same))))
        stored = read_table(df.sparkSession, path, fmt)
        known = stored.select(*[F.col(c) if c in stored.columns else F.lit(None).alias(c) for c in same])
        df = df.withColumn("_place", place).join(known.select(place.alias("_place")).distinct(), "_place", "left_anti").drop("_place")
    if df.isEmpty():
        return False
    append_table(df, path, fmt)
    return True


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether one of the functions here has stored a table at ``path``."""
    files, file = _schema_file(spark, path)
    return files.exists(file)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)
    _write_schema(df.sparkSession, path, df.schema, ())


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stored table with the column types it was written with.

    Nothing is inferred from the names of partition folders, so a key "007" stays text; a
    table without rows is read as one. Tables of other origin are read as they are.
    """
    known = _read_schema(spark, path)
    if known is None:
        return spark.read.format(fmt).load(path)
    schema, partition_by = known
    rows = spark.read.format(fmt).schema(schema).load(path)
    plain = {
        c: F.when(F.col(c).startswith(MARK), F.substr(F.col(c), F.lit(len(MARK) + 1))).otherwise(F.col(c))
        for c in _texts(schema, partition_by)
    }
    return rows.withColumns(plain).select(*schema.names) if plain else rows.select(*schema.names)


def _texts(schema: T.StructType, names) -> list[str]:
    return [c for c in names if isinstance(schema[c].dataType, T.StringType)]


def _marked(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Folder names keep empty text apart from null: it gets a mark in front, as does text that begins with the mark."""
    marked = {
        c: F.when((F.col(c) == "") | F.col(c).startswith(MARK), F.concat(F.lit(MARK), c)).otherwise(F.col(c))
        for c in _texts(df.schema, partition_by)
    }
    return df.withColumns(marked) if marked else df


def _schema_file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path, SCHEMA_FILE)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def _write_schema(spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...]) -> None:
    """A small file beside the data; Spark's readers skip names that begin with an underscore."""
    files, file = _schema_file(spark, path)
    out = files.create(file, True)
    try:
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "partition_by": partition_by}).encode()))
    finally:
        out.close()


def _read_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[str]] | None:
    files, file = _schema_file(spark, path)
    if not files.exists(file):
        return None
    opened = files.open(file)
    try:
        known = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    finally:
        opened.close()
    return T.StructType.fromJson(known["schema"]), known["partition_by"]


@contextmanager
def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a table persistent while several results are built from it, then release it."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()
