"""Operators 7, 8 and 10: ids, files and counts equal the library's."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs_frame, odd_rows, save, sha  # noqa: E402

from tessera.llm import bpe, token_counts, token_file, word_table  # noqa: E402

PATH = bpe.default_path()
T = bpe.tokenizer(PATH)
PARTS = ["a", "b", "s", "t", "re", "ve", "ll", "m", "d", "'", "''", " ", "  ", "\n", "\t", "1", "23", ".", "!?", "é", "ß", " ",
         "　", "日本", "😀", "<|endoftext|>", "՘", "\U00010940", " '", "'s", "'S", "x'll", "\r\n", "_", "-"]


def library(texts):
    return [e.ids for e in T.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def rows():
    rnd = random.Random(2)
    return odd_rows(rnd) + [(100 + i, "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))), "xx", "s") for i in range(300)]


def test_words_and_ids_equal_the_library():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(5000)] + ["", " ", "'", "'s", "'ll", "a' b"]
    joined, _, at, first = bpe.word_starts(texts, PATH)
    ids, off = bpe.word_table(PATH).encode(texts)
    for i, (t, ref) in enumerate(zip(texts, library(texts))):
        lo, hi = first[i], first[i + 1]
        assert [joined[a:b] for a, b in zip(at[lo:hi], at[lo + 1:hi + 1])] == bpe.split(t, PATH)
        assert ids[off[i]:off[i + 1]].tolist() == ref


def test_split_pattern_agrees_on_every_safe_code_point():
    for c in [*range(0xD800), *range(0xE000, 0x20000)]:
        ch = chr(c)
        if bpe.UNSAFE.search(ch) is None:
            s = f"a{ch}a1{ch}1 {ch}"
            assert [o for _, o in T.pre_tokenizer.pre_tokenize_str(s)] == [m.span() for m in bpe.PATTERN.finditer(s)], hex(c)


def test_word_table_starts_anew():
    table = bpe.WordTable(PATH, max_words=50)
    rnd = random.Random(4)
    for _ in range(20):
        texts = ["".join(rnd.choice(PARTS) for _ in range(30)) for _ in range(20)]
        ids, off = table.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(off, off[1:])] == library(texts)


def test_key_index_numbers_by_first_use():
    rng = np.random.default_rng(3)
    index, seen = bpe.KeyIndex(bits=4), {}
    for _ in range(50):
        keys = rng.integers(1, 2000, 300).astype(np.uint64) << np.uint64(50) | np.uint64(1)
        got, fresh = index.add(keys)
        for i, k in enumerate(keys.tolist()):
            seen.setdefault(k, len(seen))
            assert got[i] == seen[k]
        assert len(fresh) == len(set(fresh.tolist()))
    assert index.size == len(seen)


@pytest.mark.parametrize("bits", [1, 3, 7, 8, 11, 16, 17, 31, 32])
def test_packing_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1000).astype(np.uint32)
    image = token_file.Image(token_file.write_image(np.array([5, -2, 9]), np.array([0, 400, 400, 1000]), ids, bits, 64))
    assert image.bits == bits and image.doc_ids.tolist() == [5, -2, 9] and image.offsets.tolist() == [0, 400, 400, 1000]
    assert (image.ids(0, 1000) == ids).all()
    for lo, hi in [(0, 0), (0, 1), (63, 65), (999, 1000), (130, 700)]:
        assert (image.ids(lo, hi) == ids[lo:hi]).all()
    with pytest.raises(ValueError):
        token_file.write_image(np.array([0]), np.array([0, 1]), np.array([1 << bits]), bits, 64)


def test_op7_files(spark, tmp_path):
    data = rows()
    docs = docs_frame(spark, data, extra=True).repartition(3)
    target = str(tmp_path / "files")
    token_file.write_token_files(docs, target, image_ids=500, block_ids=100)
    images = token_file.read_token_files(spark, target)
    assert images.count() > 3
    got = sorted(map(tuple, token_file.document_digests(images).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for r, ids in zip(order, library([r[1] for r in order])):
        a = np.array([*ids, 0], "<u4")
        want.append((start, r[0], len(a), zlib.crc32(a.tobytes())))
        start += len(a)
    assert got == want


def test_op8_digests_and_round_trip(spark, monkeypatch):
    data = rows()
    docs = docs_frame(spark, data, extra=True).repartition(3, "doc_id")
    monkeypatch.setattr(word_table, "BLOCK_WORDS", 500)  # several blocks a task
    got = sorted(map(tuple, word_table.digests(docs).collect()), key=repr)
    want = [(r[0], len(ids), sha(",".join(map(str, ids)).encode()), sha(T.decode(ids, skip_special_tokens=False).encode()))
            for r, ids in zip(data, library([r[1] for r in data]))]
    assert got == sorted(want, key=repr)
    encoded = word_table.encode(docs)
    back = sorted(((r.doc_id, r.text) for r in word_table.decode(encoded).collect()), key=repr)
    assert back == sorted(((r[0], r[1] or "") for r in data), key=repr)


def test_op8_decodes_partial_characters():
    ids = np.array(T.encode("é日😀", add_special_tokens=False).ids)
    for cut in range(len(ids) + 1):
        part = ids[:cut]
        got = word_table.decode_ids(part, np.array([0, cut]), PATH)
        assert got == [T.decode(part.tolist(), skip_special_tokens=False).encode()]


def test_op10_counts_across_chunks(spark, tmp_path):
    data = rows()
    docs = docs_frame(spark, data, extra=True).repartition(3, "doc_id")
    target = str(tmp_path / "flat")
    separator = token_counts.write_flat_files(docs, target, chunk_ids=64)
    counts = token_counts.count_tokens(token_counts.read_flat(spark, target, "chunk"), separator)
    got = counts.join(token_counts.read_flat(spark, target, "doc"), ["file", "ordinal"]).select("doc_id", "n_tokens")
    want = [(r[0], len(ids)) for r, ids in zip(data, library([r[1] for r in data]))]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_op10_unfinished_document_and_no_separator(spark):
    kind = token_counts.id_type(9)
    files = {0: [1, 2, 9, 9, 3, 4, 5, 6, 7, 9, 8], 1: [1, 2, 3], 2: [9]}
    chunks = [(f, i, np.array(ids[a:a + 2], kind).tobytes()) for f, ids in files.items() for i, a in enumerate(range(0, len(ids), 2))]
    got = token_counts.count_tokens(spark.createDataFrame(chunks, "file long, chunk long, data binary"), 9)
    assert sorted(map(tuple, got.collect())) == [(0, 0, 2), (0, 1, 0), (0, 2, 5), (2, 0, 0)]


def test_empty_tables(spark, tmp_path):
    folder = save(docs_frame(spark, []), tmp_path, "documents")
    for query in (token_file.op7_token_file, word_table.op8_bpe, token_counts.op10_token_counts):
        assert query(spark, folder).count() == 0
