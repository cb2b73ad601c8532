"""Operator 10: document lengths from flat token files without an index.

A flat file is nothing but ids (little-endian, 2 bytes while all ids fit, else
4), each document ended by a separator id. It is kept as a sequence of chunks
of ``CHUNK_IDS`` ids, cut without regard to documents: rows of a Parquet table
(file, chunk, bytes), written by Spark's committer.

The scan looks for separators in each chunk with one vectorised search, alone.
A chunk reports its ids, its first and last separator and the lengths between
neighbouring separators. A prefix scan over the chunks of a file (ids before,
separators before, last separator before) then gives the length that spans
each chunk's border. A document may span any number of chunks.

The separator is an id that no text can produce: by default the first one
after the vocabulary. Nulls: a null text is an empty document (0 tokens); a
null doc_id is kept. Bytes after a file's last separator are an unfinished
document and give no row. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe
from .common import documents, slices, table

CHUNK_IDS = 1 << 18
FLAT = "kind string, file long, at long, doc_id long, data binary"


def id_type(separator: int) -> str:
    return "<u2" if separator < 1 << 16 else "<u4"


def _flatten(path: str, separator: int, chunk_ids: int):
    kind = np.dtype(id_type(separator))

    def rows(batches):
        from pyspark import TaskContext
        file = TaskContext.get().partitionId()
        words = bpe.word_table(path)
        rest, chunk, seen = np.empty(0, kind), 0, 0

        def row(name, at, doc_ids, data):
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array([file] * n, pa.int64()), pa.array(at, pa.int64()),
                 doc_ids, data], names=["kind", "file", "at", "doc_id", "data"])

        for whole in batches:
            for batch in slices(whole, "text"):
                ids, off = words.encode([t or "" for t in batch.column("text").to_pylist()])
                n = np.diff(off)
                out = np.full(len(ids) + len(n), separator, kind)
                keep = np.ones(len(out), bool)
                keep[np.cumsum(n + 1) - 1] = False
                out[keep] = ids
                rest = np.concatenate([rest, out])
                yield row("doc", np.arange(seen, seen + len(n)), batch.column("doc_id"),
                          pa.nulls(len(n), pa.binary()))
                seen += len(n)
                while len(rest) >= chunk_ids:
                    yield row("chunk", [chunk], pa.nulls(1, pa.int64()), pa.array([rest[:chunk_ids].tobytes()], pa.binary()))
                    rest, chunk = rest[chunk_ids:].copy(), chunk + 1
        if len(rest):
            yield row("chunk", [chunk], pa.nulls(1, pa.int64()), pa.array([rest.tobytes()], pa.binary()))
    return rows


def write_flat_files(docs: DataFrame, target: str, path: str | None = None,
                     separator: int | None = None, chunk_ids: int = CHUNK_IDS) -> int:
    """Encode ``docs`` into flat files, one a task, in the order that the task
    reads them. ``target/kind=chunk`` holds the ids and ``target/kind=doc`` which
    document is the n-th of a file. Returns the separator. No shuffle."""
    path = path or bpe.default_path()
    separator = bpe.vocab_size(path) if separator is None else separator
    (documents(docs).mapInArrow(_flatten(path, separator, chunk_ids), FLAT)
     .write.partitionBy("kind").parquet(target))
    return separator


def read_flat(spark: SparkSession, source: str, kind: str) -> DataFrame:
    df = (spark.read.schema(FLAT).option("basePath", source).parquet(source)
          .where(F.col("kind") == kind))
    return df.select("file", F.col("at").alias("chunk"), "data") if kind == "chunk" else \
        df.select("file", F.col("at").alias("ordinal"), "doc_id")


def _search(separator: int):
    kind = np.dtype(id_type(separator))

    def scan(batches):
        for batch in batches:
            out = []
            for data in batch.column("data").to_pylist():
                ids = np.frombuffer(data or b"", kind)
                ends = np.flatnonzero(ids == separator)
                out.append((len(ids), len(ends), int(ends[0]) if len(ends) else None,
                            int(ends[-1]) if len(ends) else None, np.diff(ends) - 1))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("chunk"), *[pa.array(c, pa.int64()) for c in cols[:4]],
                 pa.array([x.tolist() for x in cols[4]], pa.list_(pa.int64()))],
                names=["file", "chunk", "n", "n_ends", "first_end", "last_end", "inner"])
    return scan


def count_tokens(chunks: DataFrame, separator: int) -> DataFrame:
    """``file, ordinal, n_tokens`` of each document of flat files given as
    ``file, chunk, data`` rows."""
    parts = chunks.select("file", "chunk", "data").mapInArrow(
        _search(separator), "file long, chunk long, n long, n_ends long, first_end long, last_end long, inner array<long>")
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    scan = (parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
            .withColumn("ordinal0", F.coalesce(F.sum("n_ends").over(before), F.lit(0)))
            .withColumn("prev_end", F.coalesce(F.max(F.col("base") + F.col("last_end")).over(before), F.lit(-1)))
            .where(F.col("n_ends") > 0))
    crossing = F.col("base") + F.col("first_end") - F.col("prev_end") - 1
    lens = F.concat(F.array(crossing), F.col("inner"))
    rows = scan.select("file", "ordinal0", F.posexplode(lens).alias("i", "n_tokens"))
    return rows.select("file", (F.col("ordinal0") + F.col("i")).alias("ordinal"), "n_tokens")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: its flat file, place in it and number of tokens there
    (without the separator)."""
    target = scratch_path(spark, f"llm/flat-{uuid.uuid4().hex}")
    separator = write_flat_files(table(spark, sf_dir, "documents"), target)
    counts = count_tokens(read_flat(spark, target, "chunk"), separator)
    docs = read_flat(spark, target, "doc")
    return counts.join(docs, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
