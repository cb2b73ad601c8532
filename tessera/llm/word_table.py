"""Operator 8: BPE encoding and decoding through a distinct-word table.

1. Tasks split their documents into words. A block (a bounded run of documents
   of one task) keeps its distinct words once and its documents as positions
   into that list.
2. The blocks' words meet by word: rows ``(part, block, words)`` are
   partitioned by a hash of the word, and each distinct word of a part is
   encoded once by the library.
3. The ids return to their block, next to the documents' positions, and are
   joined back by position with array gathers. Decoding joins ids to pieces
   (a table as large as the vocabulary) and undoes UTF-8.

Texts are never shuffled; positions are (compressed), and each word once a
block. A frequent word occurs at most once a block, so it is no hot key. A
block ends at ``BLOCK_WORDS`` words or ``BLOCK_DISTINCT`` distinct words, after
a whole slice of documents. The documents are split twice, once for the words
and once for the positions: keeping both from one pass would need a table of
them on disk. The input must read the same twice (a table does); blocks are
named by their content, so if it does not, the job stops with an error.

Null texts are empty (0 ids); null or repeated doc_ids pass through row by
row; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import documents, partitions, ragged, slices, table

BLOCK_WORDS = 6_000_000
BLOCK_DISTINCT = 400_000
ROW = "block long, kind int, part int, n long, doc_ids binary, data binary"
NAMES = ["block", "kind", "part", "n", "doc_ids", "data"]
DOCS, WORDS, IDS = 0, 1, 2


def _row(block: int, kind: int, part: int, n: int, doc_ids: bytes | None, data: bytes):
    return pa.RecordBatch.from_arrays([
        pa.array([block], pa.int64()), pa.array([kind], pa.int32()), pa.array([part], pa.int32()),
        pa.array([n], pa.int64()), pa.array([doc_ids], pa.binary()), pa.array([data], pa.binary())],
        names=NAMES)


def _shrink(*arrays: np.ndarray) -> bytes:
    """Compressed arrays, each with its length and type."""
    head = b"".join(f"{a.dtype.str}:{len(a)};".encode() for a in arrays) + b"\n"
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(a.tobytes() for a in arrays))


def _grow(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at = raw.index(b"\n") + 1
    out = []
    for item in raw[:at - 2].split(b";"):
        kind, n = item.decode().split(":")
        out.append(np.frombuffer(raw, kind, int(n), at))
        at += out[-1].nbytes
    return out


def _split_blocks(path: str, n_parts: int, kind: int):
    """Documents -> rows of positions (``DOCS``, one a slice) or of distinct
    words (``WORDS``, one a block and part). A block is named by a checksum of
    its distinct words in order of first use, so positions can only meet the
    list that they were counted in."""

    def blocks(batches):
        index, words, keys = bpe.KeyIndex(), [], []
        held: list[tuple[int, bytes, bytes]] = []
        n_words = n_rows = 0

        def close():
            name = xxhash.xxh3_64_intdigest(np.concatenate(keys).tobytes()) >> 1
            if kind == DOCS:
                for n, docs, at in held:
                    yield _row(name, DOCS, 0, n, docs, at)
                return
            text = pa.array(words, pa.string())
            off = np.frombuffer(text.buffers()[1], np.int32)[:len(text) + 1].astype(np.int64)
            data = np.frombuffer(text.buffers()[2], np.uint8)[:off[-1]] if len(text) else np.empty(0, np.uint8)
            lens = np.diff(off)
            part = np.concatenate(keys) % np.uint64(n_parts)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(n_parts), side="right")
            lo = 0
            for p, hi in enumerate(ends.tolist()):
                if hi > lo:
                    take = order[lo:hi]
                    yield _row(name, WORDS, p, hi - lo, None, _shrink(
                        take.astype("<u4"), lens[take].astype("<u4"), data[ragged(off[take], lens[take])]))
                lo = hi

        for whole in batches:
            for batch in slices(whole, "text"):
                joined, cp, at, first = bpe.word_starts([t or "" for t in batch.column("text").to_pylist()], path)
                if not keys:
                    keys.append(np.empty(0, np.uint64))
                if len(cp):
                    key = bpe.word_keys(cp, at)
                    number, fresh = index.add(key)
                    keys.append(key[fresh])
                else:
                    number = fresh = np.empty(0, np.int64)
                n_words, n_rows = n_words + len(number), n_rows + batch.num_rows
                if kind == DOCS:
                    ids = batch.column("doc_id")
                    docs = _shrink(np.asarray(ids.fill_null(0), "<i8"),
                                   np.asarray(ids.is_valid()).astype("u1"), np.diff(first).astype("<u4"))
                    # byte planes compress better than 4-byte numbers
                    planes = number.astype("<u4").view(np.uint8).reshape(-1, 4)
                    held.append((batch.num_rows, docs,
                                 _shrink(*[np.ascontiguousarray(planes[:, i]) for i in range(4)])))
                else:
                    words.extend(joined[a:b] for a, b in zip(at[fresh].tolist(), at[fresh + 1].tolist()))
                if n_words >= BLOCK_WORDS or index.size >= BLOCK_DISTINCT:
                    yield from close()
                    index, n_words, n_rows = bpe.KeyIndex(), 0, 0
                    words.clear(), keys.clear(), held.clear()
        if n_rows:
            yield from close()
    return blocks


def _encode_parts(path: str):
    """Rows of a part (sorted by part): encode the part's distinct words once,
    return every block its words' ids in the block's order."""

    def encode(batches):
        part, held = None, []

        def flush():
            lists = []
            for block, data in held:
                take, lens, text = _grow(data)
                raw, ends = text.tobytes(), np.cumsum(lens, dtype=np.int64)
                starts = (ends - lens).tolist()
                lists.append((block, take, [raw[a:b] for a, b in zip(starts, ends.tolist())]))
            words = sorted(set().union(*(w for _, _, w in lists)))
            place = dict(zip(words, range(len(words))))
            flat, lens = [], []
            for lo in range(0, len(words), 20_000):
                ids = bpe.encode_words([w.decode() for w in words[lo:lo + 20_000]], path)
                lens.append(np.fromiter(map(len, ids), np.int64, len(ids)))
                flat.append(np.fromiter((x for i in ids for x in i), "<u4", int(lens[-1].sum())))
            flat, lens = np.concatenate(flat), np.concatenate(lens)
            starts = np.cumsum(lens) - lens
            for block, take, ws in lists:
                at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
                yield _row(block, IDS, part, len(ws), None, _shrink(
                    take, lens[at].astype("<u4"), flat[ragged(starts[at], lens[at])]))
            held.clear()

        for batch in batches:
            for p, block, data in zip(*[batch.column(c).to_pylist() for c in ("part", "block", "data")]):
                if p != part and held:
                    yield from flush()
                part = p
                held.append((block, data))
        if held:
            yield from flush()
    return encode


def _assemble(path: str, finish, names: list[str]):
    """Rows of a block, ids first, then documents: ids by position."""

    def assemble(batches):
        block, parts = None, []
        table: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

        def settle():
            n = max((int(t.max()) + 1 for t, _, _ in parts), default=0)
            lens = np.zeros(n, np.int64)
            for take, ln, _ in parts:
                lens[take] = ln
            starts = np.cumsum(lens) - lens
            flat = np.empty(int(lens.sum()), np.uint32)
            for take, ln, ids in parts:
                flat[ragged(starts[take], ln.astype(np.int64))] = ids
            parts.clear()
            if len(lens) and not lens.min():
                raise ValueError("words of a block are missing")
            return starts, lens, flat

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("block", "kind", "doc_ids", "data")]
            for b, kind, docs, data in zip(*cols):
                if b != block:
                    block, table = b, None
                    parts.clear()
                if kind == IDS:
                    parts.append(tuple(_grow(data)))
                    continue
                if table is None:
                    table = settle()
                starts, lens, flat = table
                doc_ids, known, counts = _grow(docs)
                planes = _grow(data)
                at = np.stack(planes, 1).view("<u4").ravel().astype(np.int64) if len(planes[0]) else np.empty(0, np.int64)
                if len(at) and int(at.max()) >= len(lens):
                    raise ValueError("positions without their words: the input changed between two reads; "
                                     "write it to a table first")
                n_ids = lens[at]
                ids = flat[ragged(starts[at], n_ids)]
                ends = np.concatenate([[0], np.cumsum(n_ids)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, mask=known == 0), *finish(ids, ends)], names=names)
    return assemble


def _joined(docs: DataFrame, path: str, finish, schema: str) -> DataFrame:
    spark = docs.sparkSession
    n_parts = 4 * partitions(spark)
    source = documents(docs)
    words = source.mapInArrow(_split_blocks(path, n_parts, WORDS), ROW)
    ids = (words.repartition(partitions(spark), "part").sortWithinPartitions("part")
           .mapInArrow(_encode_parts(path), ROW))
    positions = source.mapInArrow(_split_blocks(path, n_parts, DOCS), ROW)
    both = (ids.unionByName(positions)
            .repartition(partitions(spark), "block")
            .sortWithinPartitions("block", F.col("kind").desc(), "part"))
    names = [c.split()[0] for c in schema.split(", ")]
    return both.mapInArrow(_assemble(path, finish, names), schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids array<int>``: the library's ids of every whole text."""
    path = path or bpe.default_path()

    def finish(ids, ends):
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))]
    return _joined(docs, path, finish, "doc_id long, ids array<int>")


def decode_ids(ids: np.ndarray, ends: np.ndarray, path: str) -> list[bytes]:
    """Texts (UTF-8 bytes) of id rows, by joining ids to pieces; malformed
    sequences become U+FFFD as in the library. Ids without a piece are empty."""
    data, off = bpe.pieces(path)
    at = ids.astype(np.int64)
    lens = np.diff(off)[at]
    raw = data[ragged(off[at], lens)].tobytes()
    cuts = np.concatenate([[0], np.cumsum(lens)])[ends].tolist()
    out = []
    for a, b in zip(cuts, cuts[1:]):
        part = raw[a:b]
        out.append(part.decode("utf-8", "replace").encode())
    return out


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` -> ``doc_id, text``; null ids give an empty text."""
    path = path or bpe.default_path()

    def texts(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                rows = [np.asarray(x or [], np.uint32) for x in part.column("ids").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
                flat = np.concatenate(rows) if rows else np.empty(0, np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([t.decode() for t in decode_ids(flat, ends, path)], pa.string())],
                    names=["doc_id", "text"])
    return (encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
            .mapInArrow(texts, "doc_id long, text string"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: id count, sha256 of the ids in decimal joined by commas,
    sha256 of the decoded text."""
    path = path or bpe.default_path()

    def finish(ids, ends):
        # decimal texts of the ids by the same positional join as the pieces
        numbers = [f"{i}," for i in range(int(ids.max(initial=0)) + 1)]
        size = np.fromiter(map(len, numbers), np.int64, len(numbers))
        start = np.cumsum(size) - size
        chars = np.frombuffer("".join(numbers).encode(), np.uint8)
        at = ids.astype(np.int64)
        lens = size[at]
        raw = memoryview(chars[ragged(start[at], lens)])
        cuts = np.concatenate([[0], np.cumsum(lens)])[ends].tolist()
        ids_sha = [hashlib.sha256(raw[a:max(a, b - 1)]).hexdigest() for a, b in zip(cuts, cuts[1:])]
        text_sha = [hashlib.sha256(t).hexdigest() for t in decode_ids(ids, ends, path)]
        return [pa.array(np.diff(ends)), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
    return _joined(docs, path, finish,
                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
