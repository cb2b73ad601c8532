"""Operator 13: fill-in-middle transformation by secondary-sort assembly.

A document of n code points is cut into prefix, middle and suffix at two points drawn
from the hash of its doc_id, and put together again with sentinels in another order:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text itself

1. Pieces. A document becomes pieces of at most ``CHUNK`` code points, each with its
   document's key and its position in the output; a sentinel opens the first piece of its
   part.
2. Assembly. Pieces are partitioned by document and sorted by (document, output position)
   inside their partition, so that a task reads each output in order and passes it
   through an incremental digest. It holds one piece, never a document.
3. Restoration. The same stream is parsed: sentinels are found in the bytes of the output
   (also where pieces meet), and what lies between goes on with its position in the
   original text. One more sort inside the partitions (no shuffle) brings the pieces into the order
   of the text, and a second digest is taken of them.

Only step 2 moves text between tasks, as compressed pieces. The text holds no sentinel
unless the form is plain, and a sentinel's first character occurs nowhere else in one, so
the parse is unique.

A null text is empty and thereby plain. A null doc_id draws nothing: its row is plain.
Repeated rows are returned as often as they come (equal rows of a run of 1 MB are sent
once, with a count, and a document's key is salted by task, so that a row repeated any
number of times is no hot key). Documents of one doc_id and different texts are told apart
by a 128-bit hash of the text. Very long texts are many pieces. An empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from .common import documents, partitions, slices, table

CHUNK = 1 << 16
SALTS = 64
OUT_BYTES = 4 << 20

DOC = ["doc_id", "key", "salt"]
PIECES = "doc_id long, key binary, salt int, copies long, form int, position long, data binary"
TURNED = "doc_id long, key binary, salt int, part int, position long, copies long, form int, data binary"
DIGESTS = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
           "restored_sha256 string")
FORMS = ["plain", "psm", "spm"]
PLAIN, PSM, SPM = range(3)
PREFIX, MIDDLE, SUFFIX = range(3)
ORDER = {PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
HEAD = -1


@dataclass(frozen=True)
class Plan:
    """Sentinels of prefix, middle and suffix; percent transformed, and of these percent spm."""

    sentinels: tuple[str, str, str] = ("<P>", "<M>", "<S>")
    percent: int = 90
    spm_percent: int = 20
    seed: int = 1

    def __post_init__(self):
        text = "".join(self.sentinels)
        if any(not s or text.count(s[0]) != sum(t[0] == s[0] for t in self.sentinels) for s in self.sentinels) \
                or len(set(self.sentinels)) < 3 or len({len(s) for s in self.sentinels}) > 1:
            raise ValueError("sentinels: three of one length, with first characters that occur nowhere else in them")

    def draw(self, doc_id: int | None, text: str) -> tuple[int, int, int]:
        """Form, and ends of prefix and middle."""
        if not text or doc_id is None or any(s in text for s in self.sentinels):
            return PLAIN, 0, 0
        digest = hashlib.sha256(f"{self.seed}:{doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
        if h3 % 100 >= self.percent:
            return PLAIN, 0, 0
        a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        return SPM if h4 % 100 < self.spm_percent else PSM, a, b


def _out_pieces(text: str, form: int, a: int, b: int, plan: Plan, chunk: int):
    """Pieces of the output, in order."""
    if form == PLAIN:
        spans = [("", 0, len(text))]
    else:
        ends = {PREFIX: (0, a), MIDDLE: (a, b), SUFFIX: (b, len(text))}
        spans = [(plan.sentinels[p], *ends[p]) for p in ORDER[form]]
    for sentinel, lo, hi in spans:
        yield sentinel + text[lo:min(hi, lo + chunk)]
        for at in range(lo + chunk, hi, chunk):
            yield text[at:min(hi, at + chunk)]


class _Rows:
    """Rows of columns, given out as batches of about ``OUT_BYTES`` bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.held, self.size = schema, [], 0

    def add(self, row: tuple, size: int):
        self.held.append(row)
        self.size += size + 64
        if self.size >= OUT_BYTES:
            yield from self.flush()

    def flush(self):
        if self.held:
            cols = [pa.array(c, f.type) for c, f in zip(zip(*self.held), self.schema)]
            yield pa.RecordBatch.from_arrays(cols, schema=self.schema)
            self.held, self.size = [], 0


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _split(plan: Plan, chunk: int):
    def rows(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        salt = TaskContext.get().partitionId() % SALTS
        out = _Rows(_schema(PIECES))
        for whole in batches:
            for batch in slices(whole, "text"):
                times: dict[tuple, int] = {}
                for row in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    row = row[0], row[1] or ""
                    times[row] = times.get(row, 0) + 1
                for (doc_id, text), copies in times.items():
                    key = xxhash.xxh3_128_digest(text.encode())
                    form, a, b = plan.draw(doc_id, text)
                    for position, piece in enumerate(_out_pieces(text, form, a, b, plan, chunk)):
                        data = pack(piece.encode())
                        yield from out.add((doc_id, key, salt, copies, form, position, data), len(data))
        yield from out.flush()
    return rows


def pieces(docs: DataFrame, plan: Plan = Plan(), chunk: int = CHUNK) -> DataFrame:
    """The outputs as compressed pieces, partitioned by document and in output order."""
    n = partitions(docs.sparkSession)
    return (documents(docs).mapInArrow(_split(plan, chunk), PIECES).repartition(n, *DOC)
            .sortWithinPartitions(*DOC, "position"))


def _in_order(batches, columns: list[str]):
    """Rows of sorted pieces with their data unpacked; of pieces equal in document and position
    (a repeated row) the first has the data, the others None."""
    unpack = zstandard.ZstdDecompressor().decompress
    last = None
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            for row in zip(*[part.column(c).to_pylist() for c in columns], part.column("data")):
                place, same = row[:5], row[:5] == last
                last = place
                yield (*row[:-1], None if same else unpack(row[-1].as_py()))


class _Parser:
    """Finds the parts of an output that comes in pieces of bytes."""

    def __init__(self, form: int, plan: Plan):
        self.marks = [(plan.sentinels[p].encode(), p) for p in ORDER.get(form, ())]
        self.part, self.rest = PREFIX, b""

    def feed(self, data: bytes):
        """``(part, bytes)`` of all that is settled by now."""
        data = self.rest + data
        self.rest = b""
        while self.marks:
            mark, part = self.marks[0]
            at = data.find(mark)
            if at < 0:
                keep = min(len(mark) - 1, len(data))
                data, self.rest = data[:len(data) - keep], data[len(data) - keep:]
                break
            if at:
                yield self.part, data[:at]
            data, self.part = data[at + len(mark):], part
            self.marks.pop(0)
        if data:
            yield self.part, data

    def end(self):
        if self.marks:
            raise ValueError("an output ends before its last sentinel")
        if self.rest:
            yield self.part, self.rest


def _restore(plan: Plan):
    """Pieces in output order -> pieces of the text with part and position, and for every
    document a head row with the digest of its output."""
    def rows(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        out = _Rows(_schema(TURNED))
        doc = None

        def close():
            for part, data in parser.end():
                yield from send(part, data)
            yield from out.add((*doc, HEAD, 0, copies, form, pack(digest.digest())), 64)

        def send(part, data):
            nonlocal count
            count += 1
            data = pack(data)
            yield from out.add((*doc, part, count, 0, form, data), len(data))

        for doc_id, key, salt, position, row_form, row_copies, data in _in_order(
                batches, [*DOC, "position", "form", "copies"]):
            if (doc_id, key, salt) != doc:
                if doc is not None:
                    yield from close()
                doc, form, copies, count = (doc_id, key, salt), row_form, 0, 0
                digest, parser = hashlib.sha256(), _Parser(form, plan)
            if position == 0:
                copies += row_copies
            if data is not None:
                digest.update(data)
                for part, piece in parser.feed(data):
                    yield from send(part, piece)
        if doc is not None:
            yield from close()
        yield from out.flush()
    return rows


def _digest(batches):
    """Pieces in text order -> the digests of each document, a row a copy."""
    out = _Rows(_schema(DIGESTS))
    doc = None

    def close():
        total = sum(chars)
        cut = (None, None) if form == PLAIN else (chars[PREFIX], chars[MIDDLE])
        row = (doc[0], total, FORMS[form], *cut, output, digest.hexdigest())
        for _ in range(copies):
            yield from out.add(row, 160)

    for doc_id, key, salt, part, _, row_form, row_copies, data in _in_order(
            batches, [*DOC, "part", "position", "form", "copies"]):
        if part == HEAD:
            if doc is not None:
                yield from close()
            doc, form, copies, output = (doc_id, key, salt), row_form, row_copies, data.hex()
            digest, chars = hashlib.sha256(), [0, 0, 0]
        else:
            digest.update(data)
            # bytes that begin a code point
            chars[part] += int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))
    if doc is not None:
        yield from close()
    yield from out.flush()


def digests(docs: DataFrame, plan: Plan = Plan(), chunk: int = CHUNK) -> DataFrame:
    """Form, lengths and digests of output and restored text, of every document."""
    turned = pieces(docs, plan, chunk).mapInArrow(_restore(plan), TURNED)
    return turned.sortWithinPartitions(*DOC, "part", "position").mapInArrow(_digest, DIGESTS)


def _texts(batches):
    out = _Rows(_schema("doc_id long, form string, output string"))
    doc, held = None, []

    def close():
        text = b"".join(held).decode()
        for _ in range(copies):
            yield from out.add((doc[0], FORMS[form], text), len(text))

    for doc_id, key, salt, position, row_form, row_copies, data in _in_order(batches, [*DOC, "position", "form", "copies"]):
        if (doc_id, key, salt) != doc:
            if doc is not None:
                yield from close()
            doc, form, copies, held = (doc_id, key, salt), row_form, 0, []
        if position == 0:
            copies += row_copies
        if data is not None:
            held.append(data)
    if doc is not None:
        yield from close()
    yield from out.flush()


def transform(docs: DataFrame, plan: Plan = Plan(), chunk: int = CHUNK) -> DataFrame:
    """``doc_id, form, output``: the outputs as texts, one document a row (as the input is)."""
    return pieces(docs, plan, chunk).mapInArrow(_texts, "doc_id long, form string, output string")


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
g AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN h IS NULL OR n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END AS output FROM c),
p AS (SELECT *, strpos(output, '<P>') AS p, strpos(output, '<S>') AS s, strpos(output, '<M>') AS m FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(output) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN output
    WHEN 'psm' THEN substr(output, 4, s - 4) || substr(output, m + 3) || substr(output, s + 3, m - s - 3)
    ELSE substr(output, p + 3, m - p - 3) || substr(output, m + 3) || substr(output, 4, p - 4) END) AS restored_sha256
FROM p
"""
