"""Operator 7: token ids in fixed-width packed files.

Format. A file is a sequence of images. An image holds whole documents and
can be read alone:

    "TIDS" | version u8 | bits u8 | pad u16 | block_ids u32 | n_docs u32 | n_ids u64
    n_docs x doc_id i64 | (n_docs + 1) x first id of the document u64
    (n_blocks + 1) x byte offset of the block in the payload u64 | payload

Every id takes ``bits = max(1, ceil(log2(ids)))`` bits, least significant bit
first; each block of ``block_ids`` ids starts on a byte, so block b is found by
its offset and unpacked alone (random access to any id). Images are rows of a
Parquet table: Spark's committer makes them appear once even if an executor is
lost, and any store that Spark writes to can hold them.

Order: files follow ascending doc_id (range partitions, sorted inside), equal
ids by text. Null texts are empty; a null doc_id comes first; repeated rows are
written as often as they occur; an empty table gives no image and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import bpe
from .common import documents, partitions, slices, table

HEAD = struct.Struct("<4sBBHIIQ")
NULL_DOC = -(1 << 63)
IMAGE_SCHEMA = "shard int, image_no int, first_doc long, n_docs long, n_ids long, image binary"


def bits_for(n_values: int) -> int:
    return max(1, int(n_values - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Bytes of ``ids`` at ``bits`` bits each, low bit first."""
    if bits in (8, 16, 32):
        return np.ascontiguousarray(ids.astype(f"<u{bits // 8}")).view(np.uint8)
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little")


def unpack(data: np.ndarray, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little")
    weights = (np.uint32(1) << np.arange(bits, dtype=np.uint32))
    return (planes.reshape(n, bits).astype(np.uint32) * weights).sum(1, dtype=np.uint32)


def write_image(doc_ids: np.ndarray, offsets: np.ndarray, ids: np.ndarray, bits: int,
                block_ids: int) -> bytes:
    if len(ids) and int(ids.max()) >= 1 << bits:
        raise ValueError(f"id {int(ids.max())} does not fit {bits} bits")
    blocks = [pack(ids[i:i + block_ids], bits) for i in range(0, len(ids), block_ids)]
    at = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    return b"".join([HEAD.pack(b"TIDS", 1, bits, 0, block_ids, len(doc_ids), len(ids)),
                     doc_ids.astype("<i8").tobytes(), offsets.astype("<u8").tobytes(),
                     at.tobytes(), *[b.tobytes() for b in blocks]])


class Image:
    """Reader of one image: whole documents, or any range of ids."""

    def __init__(self, data: bytes):
        magic, version, self.bits, _, self.block_ids, n, self.n_ids = HEAD.unpack_from(data)
        if magic != b"TIDS" or version != 1:
            raise ValueError("not a token image")
        at = HEAD.size
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        at += 8 * n
        self.offsets = np.frombuffer(data, "<u8", n + 1, at).astype(np.int64)
        at += 8 * (n + 1)
        n_blocks = -(-self.n_ids // self.block_ids)
        self.block_at = np.frombuffer(data, "<u8", n_blocks + 1, at).astype(np.int64)
        self.payload = np.frombuffer(data, np.uint8, -1, at + 8 * (n_blocks + 1))

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo .. hi - 1; only the blocks that hold them are unpacked."""
        if hi <= lo:
            return np.empty(0, np.uint32)
        first, last = lo // self.block_ids, (hi - 1) // self.block_ids
        parts = [unpack(self.payload[self.block_at[b]:self.block_at[b + 1]], self.bits,
                        min(self.block_ids, self.n_ids - b * self.block_ids))
                 for b in range(first, last + 1)]
        out = parts[0] if len(parts) == 1 else np.concatenate(parts)
        return out[lo - first * self.block_ids:hi - first * self.block_ids]


def _encode(path: str, end_id: int, bits: int, block_ids: int, image_ids: int):
    def images(batches):
        from pyspark import TaskContext
        shard, no = TaskContext.get().partitionId(), 0
        words = bpe.word_table(path)
        held: list[tuple[np.ndarray, np.ndarray]] = []  # doc ids, ids of each document
        docs: list[np.ndarray] = []
        lens: list[np.ndarray] = []

        def flush():
            nonlocal no
            d, n = np.concatenate(docs), np.concatenate(lens)
            ids = np.concatenate(held)
            image = write_image(d, np.concatenate([[0], np.cumsum(n)]), ids, bits, block_ids)
            row = pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([no], pa.int32()), pa.array([int(d[0])]),
                pa.array([len(d)]), pa.array([len(ids)]), pa.array([image], pa.binary())],
                names=["shard", "image_no", "first_doc", "n_docs", "n_ids", "image"])
            no += 1
            held.clear(), docs.clear(), lens.clear()
            return row

        for whole in batches:
            for batch in slices(whole, "text"):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                ids, off = words.encode(texts)
                n = np.diff(off)
                # the end id goes after each document's ids
                out = np.full(len(ids) + len(n), end_id, np.int32)
                keep = np.ones(len(out), bool)
                keep[np.cumsum(n + 1) - 1] = False
                out[keep] = ids
                held.append(out)
                lens.append(n + 1)
                docs.append(np.asarray(batch.column("doc_id").fill_null(NULL_DOC), np.int64))
                if sum(map(len, held)) >= image_ids:
                    yield flush()
        if docs:
            yield flush()
    return images


def write_token_files(docs: DataFrame, target: str, path: str | None = None, end_id: int = 0,
                      block_ids: int = 1 << 16, image_ids: int = 1 << 22) -> None:
    """Encode ``docs`` and write packed files under ``target``, in doc_id order.

    One range shuffle of the texts; encoding and writing happen in the same
    stage. ``image_ids`` closes an image (one document more at most), which
    bounds a task's memory.
    """
    path = path or bpe.default_path()
    bits = bits_for(max(bpe.vocab_size(path), end_id + 1))
    spark = docs.sparkSession
    ordered = (documents(docs).repartitionByRange(partitions(spark), "doc_id")
               .sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(_encode(path, end_id, bits, block_ids, image_ids), IMAGE_SCHEMA)
     .write.parquet(target))


def read_token_files(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.schema(IMAGE_SCHEMA).parquet(source)


def _digest(batches):
    for batch in batches:
        for base, data in zip(batch.column("base").to_pylist(), batch.column("image").to_pylist()):
            image = Image(data)
            ids = image.ids(0, image.n_ids).astype("<u4")
            lo, hi = image.offsets[:-1], image.offsets[1:]
            view = memoryview(ids).cast("B")
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(lo.tolist(), hi.tolist())]
            doc = pa.array(image.doc_ids, mask=image.doc_ids == NULL_DOC)
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(base + lo), pa.array(hi - lo), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_digests(images: DataFrame) -> DataFrame:
    """Per document, read from the images: start over all files, ids with the
    end id, crc32 of the ids as little-endian u32.

    Starts: images of a shard are summed inside the shard, then shards (one row
    each) in order. Both windows hold image counts, never documents.
    """
    heads = images.select("shard", "image_no", "n_ids")
    shards = heads.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_base"))
    inside = Window.partitionBy("shard").orderBy("image_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = (heads.withColumn("inner_base", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
             .join(shards, "shard")
             .select("shard", "image_no", (F.col("shard_base") + F.col("inner_base")).alias("base")))
    return (images.join(F.broadcast(bases), ["shard", "image_no"])  # 16 bytes an image of 4M ids
            .select("base", "image")
            .mapInArrow(_digest, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, f"llm/token-files-{uuid.uuid4().hex}")
    write_token_files(table(spark, sf_dir, "documents"), target)
    return document_digests(read_token_files(spark, target))
