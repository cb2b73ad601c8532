"""Operator 6: removal of repeated substrings (suffix-array dedup).

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else, in its own or another document. Strings are judged on the input; matches
never cross documents.

1. Anchors. Of the ``GRAM``-byte substrings of every ``LENGTH``-byte string, the one
   with the least hash (the first of equals) is its anchor: equal strings have
   equal anchors at the same place. About one byte in 80 is an anchor. Its
   context is all that a string with this anchor can reach.
2. Anchors that occur once are done: no string there repeats. Of the others,
   equal contexts are one class; they are told apart by a 128-bit BLAKE2 digest of their
   bytes, not by the prefix hashes. A class of two or more occurrences repeats as a whole.
3. Classes of one occurrence next to other classes of the same anchor differ
   somewhere in the context. Their strings meet by anchor: candidates by hash,
   then the suffixes at the outermost candidates of each context are sorted
   (suffix_sort: prefix hashes, binary search, mergesort), and neighbours that
   agree for ``LENGTH`` bytes are verified byte by byte.
4. The spans return to their documents and are cut out.

Nothing is capped. Equal texts (by 128 bits of SHA-256) are one text with a weight. An
anchor with more than ``HOT_CONTEXTS`` contexts is not brought into one task: its strings
are counted by hash with map-side combining instead, and those that are not alone
again by a digest of their bytes. So a collision of prefix hashes removes nothing.

A null text is empty. Texts shorter than ``LENGTH`` bytes lose nothing. Null or
repeated doc_ids pass through row by row; two equal rows repeat each other. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binary_column, cut, documents, free_name, partitions, ragged, slices, table, utf8_batch
from .shingles import mix64
from .suffix_sort import PrefixHash

LENGTH = 200
GRAM = 40
HOT_CONTEXTS = 16_384
BATCH_CONTEXTS = 1024
STRINGS = 300_000  # compared at a time in a task
SLICE = 1 << 20  # bytes of text whose anchors are searched at a time


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM, bits: int = 64):
    """Anchors of the texts ``data[off[i]:off[i + 1]]``: text number, position,
    hash of the gram, context bytes before and from it."""
    n, span = len(data), length - gram + 1
    empty = np.empty(0, np.int64)
    if n < length:
        return empty, empty, empty, empty, empty
    prefix = PrefixHash(data, bits)
    grams = (prefix.sums[gram:] - prefix.sums[:-gram]) * prefix.down[:n - gram + 1]
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(n - gram + 1, dtype=np.uint64)
    width, low = 1, key
    while width * 2 <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    lens = np.diff(off)
    ends = np.repeat(off[1:], lens)
    inside = np.flatnonzero(np.arange(len(low)) + length <= ends[:len(low)])
    pos = (low[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    pos = pos[np.concatenate([[True], pos[1:] != pos[:-1]])] if len(pos) else pos
    doc = np.searchsorted(off, pos, side="right") - 1
    left = np.minimum(pos - off[doc], length - gram)
    right = np.minimum(off[doc + 1] - pos, length)
    return doc, pos - off[doc], (mix64(grams[pos]) & prefix.mask).view(np.int64), left, right


def digests_of(data: np.ndarray, start: np.ndarray, size: np.ndarray, mark: np.ndarray) -> pa.Array:
    """Digests of the stretches ``data[start:start + size]``, each with its mark (16 bits)."""
    raw, blake, mark = memoryview(np.ascontiguousarray(data)), hashlib.blake2b, mark.astype("<u2").tobytes()
    ends = zip(start.tolist(), (start + size).tolist())
    return pa.array([blake(raw[a:b], digest_size=16).digest() + mark[2 * i:2 * i + 2] for i, (a, b) in enumerate(ends)], pa.binary())


COUNTED = "anchor long, weight long"
ANCHOR = "node binary, pos long, anchor long, context binary, before int, after int, weight long"


def _anchor_rows(length: int, gram: int, places: bool, bits: int):
    """Anchors of texts (``node, text``), equal texts of a slice once: with the number of
    their texts, or as ``places``."""
    def rows(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                names = batch.column("node").dictionary_encode()
                _, first, count = np.unique(np.asarray(names.indices), return_index=True, return_counts=True)
                part = batch.take(pa.array(first))
                data, off = utf8_batch(part.column("text"))
                doc, pos, gram_hash, left, right = anchors(data, off, length, gram, bits)
                if not places:
                    yield pa.RecordBatch.from_arrays([pa.array(gram_hash), pa.array(count[doc])], names=["anchor", "weight"])
                    continue
                context = digests_of(data, off[doc] + pos - left, left + right, left)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(pa.array(doc)), pa.array(pos), pa.array(gram_hash), context,
                     pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), pa.array(count[doc])],
                    names=["node", "pos", "anchor", "context", "before", "after", "weight"])
    return rows


def _contexts(batches):
    """Bytes of the wanted contexts of each text."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 200):
            part = batch.slice(lo, 200)
            data, off = utf8_batch(part.column("text"))
            wanted = part.column("wanted")
            rows = wanted.flatten()
            counts = np.diff(np.asarray(wanted.offsets, np.int64))
            pos, left, right = (np.asarray(rows.field(c), np.int64) for c in ("pos", "before", "after"))
            start = np.repeat(off[:-1], counts) + pos - left
            lens = left + right
            yield pa.RecordBatch.from_arrays(
                [rows.field("anchor"), rows.field("context"), rows.field("before"),
                 binary_column(data[ragged(start, lens)], np.concatenate([[0], np.cumsum(lens)]))],
                names=["anchor", "context", "before", "bytes"])


def reach_of(left: np.ndarray, right: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last offset (<= 0) to the anchor of a string that holds it."""
    return -np.minimum(left, length - gram), np.minimum(right - length, 0)


def possible(prefix: PrefixHash, anchor, left, right, group, low, high, length: int, gram: int):
    """Offsets at which a string can repeat at all. A string that starts more than
    half the free bytes before the anchor holds that half before it, and any
    other the like half after it; a half that no other context of the group has
    rules its strings out."""
    half = (length - gram) // 2

    def seen(start, size, there):
        out = np.zeros(len(anchor), bool)
        rows = np.flatnonzero(there)
        key = mix64(prefix.hash(start[rows], size) + mix64(group[rows].astype(np.uint64)))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        out[rows] = count[inverse] > 1
        return out

    before = seen(anchor - half, half + gram, left >= half)
    after = seen(anchor, length - half, right >= length - half)
    low = np.where(before, low, np.maximum(low, -half))
    high = np.where(after, high, np.minimum(high, -half))
    return low, np.where(before | after, high, low - 1)


def strings_at(prefix: PrefixHash, off: np.ndarray, left: np.ndarray, length: int, low: np.ndarray, high: np.ndarray):
    """The ``length``-byte strings that start ``low`` to ``high`` bytes from their
    context's anchor: context number, that offset, start, hash."""
    count = np.maximum(high - low + 1, 0)
    anchor = off[:-1] + left
    start = ragged(anchor + low, count)
    row = np.repeat(np.arange(len(left)), count)
    return row, start - anchor[row], start, prefix.hash(start, length)


def repeated_reach(data: np.ndarray, off: np.ndarray, left: np.ndarray, group: np.ndarray,
                   length: int = LENGTH, gram: int = GRAM, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """How far repeated strings reach before and after the anchor of each context
    (0, 0: no string repeats). Contexts of a group share the anchor and differ.
    Strings can only be equal at the same offset, so a few offsets are taken at a time."""
    n = len(left)
    reach_left, reach_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    prefix = PrefixHash(data, bits)
    right = np.diff(off) - left
    low, high = reach_of(left, right, length, gram)
    low, high = possible(prefix, off[:-1] + left, left, right, group, low, high, length, gram)
    width = max(1, STRINGS // max(n, 1))
    for first in range(gram - length, 1, width):
        row, offset, start, name = strings_at(prefix, off, left, length, np.maximum(low, first),
                                              np.minimum(high, first + width - 1))
        far = outermost(prefix, row, offset, start, name, group, length)
        np.maximum.at(reach_left, row[far], -offset[far])
        np.maximum.at(reach_right, row[far], length + offset[far])
    return reach_left, reach_right


def outermost(prefix: PrefixHash, row, offset, start, name, group, length: int) -> np.ndarray:
    """The first and last repeated strings of each context, with their partners.
    Candidates agree by hash; the chosen ones are suffix
    sorted, and neighbours that are equal byte by byte are confirmed."""
    key = mix64(name + mix64(group[row].astype(np.uint64) * np.uint64(1024) + (-offset).astype(np.uint64)))
    alive = np.arange(len(row))
    while len(alive):
        _, inverse, count = np.unique(key[alive], return_inverse=True, return_counts=True)
        some = count[inverse] > 1
        alive, cls = alive[some], inverse[some]
        if not len(alive):
            break
        first = np.concatenate([[True], row[alive][1:] != row[alive][:-1]])
        last = np.concatenate([first[1:], [True]])
        outer = np.zeros(int(cls.max()) + 1, bool)
        outer[cls[first | last]] = True
        chosen = outer[cls]
        items, kinds = alive[chosen], cls[chosen]
        _, segment = np.unique(group[row[items]] * 1024 - offset[items], return_inverse=True)
        order = prefix.sort(start[items], np.full(len(items), length, np.int64), segment)
        a, b = order[:-1], order[1:]
        near = (segment[a] == segment[b]) & (kinds[a] == kinds[b])
        true = np.zeros(len(a), bool)
        true[near] = prefix.equal_bytes(start[items[a[near]]], start[items[b[near]]], length)
        good = np.zeros(len(items), bool)
        good[a[true]] = good[b[true]] = True
        if good.all():
            return items
        alive = np.setdiff1d(alive, items[~good])  # a collision: look again without it
    return alive


REACH = "anchor long, context binary, reach_left int, reach_right int"


def _compare(length: int, gram: int, bits: int):
    def settle(held):
        data = np.frombuffer(b"".join(h[3] for h in held), np.uint8)
        off = np.concatenate([[0], np.cumsum([len(h[3]) for h in held])]).astype(np.int64)
        group = np.array([h[0] for h in held])
        _, group = np.unique(group, return_inverse=True)
        left, right = repeated_reach(data, off, np.array([h[2] for h in held], np.int64), group, length, gram, bits)
        some = np.flatnonzero(right)
        return pa.RecordBatch.from_arrays(
            [pa.array([held[i][0] for i in some], pa.int64()), pa.array([held[i][1] for i in some], pa.binary()),
             pa.array(left[some].astype(np.int32)), pa.array(right[some].astype(np.int32))],
            names=["anchor", "context", "reach_left", "reach_right"])

    def compare(batches):
        held, last = [], (None, None)
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "context", "before", "bytes")]):
                if row[:2] == last:  # the same context again
                    continue
                if len(held) >= BATCH_CONTEXTS and row[0] != last[0]:
                    yield settle(held)
                    held = []
                held.append(row)
                last = row[:2]
        if held:
            yield settle(held)
    return compare


def _string_hashes(length: int, gram: int, bits: int):
    """All strings of the contexts of hot anchors, by hash."""
    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                held = part.column("bytes").to_pylist()
                off = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int64)
                left = np.asarray(part.column("before"), np.int64)
                row, offset, _, name = strings_at(PrefixHash(np.frombuffer(b"".join(held), np.uint8), bits), off, left, length,
                                                  *reach_of(left, np.diff(off) - left, length, gram))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(at), part.column("context").take(at),
                     pa.array(offset.astype(np.int32)), pa.array(name.view(np.int64))],
                    names=["anchor", "context", "offset", "string"])
    return rows


def _string_digests(length: int):
    """Digests of the strings at ``offsets`` of each context."""
    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                held, lists = part.column("bytes").to_pylist(), part.column("offsets")
                base = np.cumsum([0, *map(len, held)])[:-1] + np.asarray(part.column("before"), np.int64)
                offset, row = np.asarray(lists.flatten(), np.int64), np.repeat(np.arange(len(held)), np.asarray(lists.value_lengths()))
                data = np.frombuffer(b"".join(held), np.uint8)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("anchor").take(at), part.column("context").take(at), pa.array(offset.astype(np.int32)),
                     digests_of(data, base[row] + offset, np.full(len(row), length), np.zeros(len(row)))],
                    names=["anchor", "context", "offset", "string"])
    return rows


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = 64) -> DataFrame:
    """``node, spans array<struct<lo, hi>>`` of ``doc_id, node, text`` rows: the
    byte ranges (unmerged) that repeat, for each text that has any. ``bits`` of the prefix
    hashes are used."""
    spark = rows.sparkSession
    long = rows.where(F.octet_length("text") >= length).select("node", "text")
    counted = long.mapInArrow(_anchor_rows(length, gram, False, bits), COUNTED)
    found = long.mapInArrow(_anchor_rows(length, gram, True, bits), ANCHOR)
    # A table of its own, and dealt anew by text after the join: so Spark may
    # split a hot anchor's rows in the join.
    shared = cut(counted.groupBy("anchor").agg(F.sum("weight").alias("uses")).where("uses > 1").select("anchor"), "shared")
    places = found.join(shared, "anchor").repartition(partitions(spark), "node").groupBy("node", "pos", "anchor", "context", "before", "after").agg(
        F.sum("weight").alias("weight"))
    places = cut(places, "anchors")
    classes = cut(places.groupBy("anchor", "context").agg(
        F.sum("weight").alias("uses"), F.min(F.struct("node", "pos", "before", "after")).alias("at")), "contexts")
    mixed = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("uses").alias("least")).where("kinds > 1 and least = 1")
    # One text of each class in a mixed group gives the context's bytes.
    wanted = classes.join(mixed.select("anchor", "kinds"), "anchor").select(
        "at.node", F.struct("at.pos", "at.before", "at.after", "anchor", "context").alias("item"))
    wanted = wanted.groupBy("node").agg(F.collect_list("item").alias("wanted"))  # a text's own anchors
    first = rows.groupBy("node").agg(F.min("doc_id").alias("first_doc"))
    wanted = wanted.join(first, "node").withColumnRenamed("node", "n")
    texts = rows.join(wanted, (rows["node"] == F.col("n")) & rows["doc_id"].eqNullSafe(F.col("first_doc")))
    contexts = cut(texts.select("text", "wanted").mapInArrow(
        _contexts, "anchor long, context binary, before int, bytes binary"), "context-bytes")
    hot = mixed.where(F.col("kinds") > HOT_CONTEXTS).select("anchor")
    plain = (contexts.join(hot, "anchor", "left_anti").repartition(partitions(spark), "anchor")
             .sortWithinPartitions("anchor", "context").mapInArrow(_compare(length, gram, bits), REACH))
    crowd = contexts.join(hot, "anchor", "left_semi").dropDuplicates(["anchor", "context"])
    strings = crowd.mapInArrow(_string_hashes(length, gram, bits), "anchor long, context binary, offset int, string long")
    again = strings.groupBy("anchor", "offset", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Strings of one hash are compared by their bytes.
    near = strings.join(again, ["anchor", "offset", "string"], "left_semi").groupBy("anchor", "context").agg(
        F.collect_list("offset").alias("offsets"))  # of one context: length - gram + 1 at most
    exact = cut(crowd.join(near, ["anchor", "context"]).mapInArrow(
        _string_digests(length), "anchor long, context binary, offset int, string binary"), "hot-strings")
    again = exact.groupBy("anchor", "offset", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    crowded = (exact.join(again, ["anchor", "offset", "string"], "left_semi").groupBy("anchor", "context")
               .agg(F.max(-F.col("offset")).cast("int").alias("reach_left"),
                    F.max(F.lit(length) + F.col("offset")).cast("int").alias("reach_right")))
    whole = classes.where("uses > 1").select(
        "anchor", "context", F.lit(length).alias("reach_left"), F.lit(length).alias("reach_right"))
    single = classes.where("uses = 1").select("anchor", "context")
    partial = plain.unionByName(crowded).join(single, ["anchor", "context"])
    reach = cut(whole.unionByName(partial), "reach")
    spans = places.join(reach, ["anchor", "context"]).select("node", F.struct(
        (F.col("pos") - F.least("before", "reach_left")).alias("lo"),
        (F.col("pos") + F.least("after", "reach_right")).alias("hi")).alias("span"))
    return cut(spans.groupBy("node").agg(F.collect_list("span").alias("spans")), "spans")


def merge(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((x["lo"], x["hi"]) for x in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def keep(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for lo, hi in spans:
        parts.append(text[at:lo])
        at = hi
    return b"".join([*parts, text[at:]])


def _digest(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            out = []
            for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                raw, cuts = (text or "").encode(), merge(spans)
                out.append((len(raw), sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(keep(raw, cuts)).hexdigest()))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cut_text(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            texts = [None if t is None else keep(t.encode(), merge(s)).decode("utf-8", "ignore")
                     for t, s in zip(part.column("text").to_pylist(), part.column(part.num_columns - 1).to_pylist())]
            at = part.schema.get_field_index("text")
            cols = list(part.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols[:-1], names=part.schema.names[:-1])


def text_name(text):
    """128 bits of the text's SHA-256; a null text is the empty one."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def removal_digests(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bits: int = 64) -> DataFrame:
    rows = documents(docs).withColumn("node", text_name(F.col("text")))
    spans = repeated_spans(rows, length, gram, bits)
    return rows.join(spans, "node", "left").select("doc_id", "text", "spans").mapInArrow(
        _digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs``, all columns, with the repeated bytes cut out of ``text``. A
    character that loses some of its bytes goes whole."""
    rows = documents(docs).withColumn("node", text_name(F.col("text")))
    own, theirs, cuts = (free_name(docs, c) for c in ("_own", "_node", "_spans"))
    spans = repeated_spans(rows, length, gram).select(F.col("node").alias(theirs), F.col("spans").alias(cuts))
    joined = docs.withColumn(own, text_name(docs["text"].cast("string"))).join(spans, F.col(own) == F.col(theirs), "left")
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], cuts).mapInArrow(_cut_text, docs.schema)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_digests(table(spark, sf_dir, "documents"))
