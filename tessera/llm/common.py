"""Helpers shared by the training-data operators.

Scratch tables go to the shared folder named by ``spark.checkpoint.dir``
(through ``tessera.session``), are written by Spark's own committer and read
back with a fixed schema, so a lost executor costs a re-read, not a rerun of
everything above it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Batches to Python by bytes, not by 10,000 rows: long texts would make them
    as large as memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8_batch(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of an Arrow string column; null is empty."""
    arr = col.fill_null("") if col.null_count else col
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_binary())
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0]:off[-1]], (off - off[0]).copy()


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lens[i]`` of all rows, in row order."""
    total = int(lens.sum())
    if not total:
        return np.empty(0, np.int64)
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def binary_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary column over one buffer: row i is ``data[offsets[i]:offsets[i + 1]]`` bytes."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20):
    """Cut a batch so that ``column`` holds about ``max_bytes`` a slice (one
    row at least), which bounds the memory of array work on long texts."""
    n = batch.num_rows
    if not n:
        return
    sizes = batch.column(column)
    lens = np.asarray(pc.fill_null(pc.binary_length(sizes), 0), np.int64)
    group = (np.cumsum(lens) - lens) // max_bytes
    cuts = np.flatnonzero(np.diff(group)) + 1
    lo = 0
    for hi in [*cuts.tolist(), n]:
        yield batch.slice(lo, hi - lo)
        lo = hi


def spread_rows(df: DataFrame, *keys) -> DataFrame:
    """Hash-partition by ``keys`` into the session's shuffle partitions."""
    return df.repartition(partitions(df.sparkSession), *keys)


def documents(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (typed, nothing else unless named), so extra
    columns and clashing names of the input never reach an operator."""
    small_batches(df.sparkSession)
    cols = [df["doc_id"].cast("long").alias("doc_id"), df["text"].cast("string").alias("text")]
    return df.select(*cols, *[df[c] for c in more])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


__all__ = ["F", "binary_column", "cut", "documents", "free_name", "partitions", "ragged", "slices",
           "spread_rows", "table", "utf8_batch"]
