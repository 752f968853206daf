"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or the folder set with setCheckpointDir. A temporary one only in local mode (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="barmart-"))
    return context.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back: computed once, and safe when an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of narrow keys (some 16 bytes each) up to which a table may be broadcast.
FEW = 1 << 20


def if_small(df: DataFrame, rows: int, most_rows: int = FEW) -> DataFrame:
    """Marks a narrow table for broadcast if its counted rows are few; larger ones are left to a shuffled join."""
    return F.broadcast(df) if rows <= most_rows else df


def join_kept(wide: DataFrame, kept: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Joins wide rows (texts) with a stored table that has unique keys `on`, inner or left.

    If its counted keys are few, they are broadcast first, and only the wide rows that have a partner are exchanged.
    """
    if kept.count() > FEW:
        return wide.join(kept, on, how)
    keys = F.broadcast(kept.select(*on))
    met = wide.join(keys, on, "left_semi").join(kept, on)
    if how == "inner":
        return met
    return met.unionByName(wide.join(keys, on, "left_anti"), allowMissingColumns=True)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024, column: int | None = None, most_bytes: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Smaller pieces of the batches, so that what is made of one fits a worker's memory many times over.

    With `column`, a column of bytes, a piece also ends before it holds more than `most_bytes` of it; a larger row is alone.
    """
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            piece = batch.slice(at, rows)
            if column is None:
                yield piece
                continue
            sizes = pc.binary_length(piece.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
            ends, first = np.cumsum(sizes, dtype=np.int64), 0
            while first < piece.num_rows:
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
                yield piece.slice(first, last - first)
                first = last


def lists(arrays: list, kind=None) -> pa.ListArray:
    """An Arrow list column from numpy arrays of 64-bit numbers."""
    import numpy as np

    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64), kind or pa.int64()))
