"""Operators 2, 6 and 9 against brute force."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs_frame, jaccard_brute, odd_rows, repeats_brute, save, sha, words  # noqa: E402

from tessera.llm import components as cc  # noqa: E402
from tessera.llm import jaccard_join, near_vectors, shingles, substring_dedup  # noqa: E402
from tessera.llm.suffix_sort import PrefixHash  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int"


def edited(rnd, text, share):
    return " ".join(w if rnd.random() > share else "zz" + str(rnd.randint(0, 9999)) for w in text.split(" "))


def near_rows(rnd):
    rows = odd_rows(rnd)
    for g in range(6):
        base = words(rnd, rnd.randint(8, 250))
        rows += [(1000 + 100 * g + i, edited(rnd, base, rnd.choice([0, 0.005, 0.02, 0.05])), "xx", "s") for i in range(14)]
    return rows


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges += [(2000, x) for x in range(2001, 2200)] + [(5, 5), (7, 8), (7, 8)]
    label = {x: x for e in edges for x in e}
    for _ in range(300):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in cc.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long").dropna()).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}


def test_word_hashes_split_like_python():
    texts = ["", "  ", "One two three\nFOUR", "a", "x　y z", " ß İ "]
    hashes, at = shingles.word_hashes(texts)
    assert np.diff(at).tolist() == [len(t.split()) for t in texts]
    same, _ = shingles.word_hashes(["one"])
    assert hashes[at[2]] == same[0]


def test_signatures_estimate_jaccard():
    rnd = random.Random(3)
    base = words(rnd, 2000)
    texts = [base, edited(rnd, base, 0.02)]
    h, off = shingles.shingles(texts)
    a, b = set(h[:off[1]].tolist()), set(h[off[1]:].tolist())
    sig = shingles.signatures(h, off)
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.15


def test_least_matches_is_the_posterior():
    # numeric integration of the posterior under a uniform prior
    x = (np.arange(200_000) + 0.5) / 200_000
    for i, k in enumerate(jaccard_join.least_matches(0.8, 1e-4)):
        n = (i + 1) * jaccard_join.STEP
        for j, keep in ((k, True), (k - 1, False)):
            like = x ** j * (1 - x) ** (n - j)
            assert ((like[x >= 0.8].sum() / like.sum()) >= 1e-4) == keep


@pytest.mark.parametrize("tile", [1024, 5])
def test_op9_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard_join, "TILE_NODES", tile)
    rows = near_rows(random.Random(11))
    got = jaccard_join.jaccard_classes(docs_frame(spark, rows, extra=True).repartition(3)).collect()
    links, label = jaccard_brute(rows)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(label[i], []).append(r[0])
    first = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    want = sorted(((r[0], first[label[i]], links[i]) for i, r in enumerate(rows)), key=repr)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=repr) == want


def test_op9_keeps_one_of_each_class(spark):
    rows = near_rows(random.Random(12))
    docs = docs_frame(spark, rows, extra=True)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    _, label = jaccard_brute(rows)
    wordless = sum(1 for r in rows if not (r[1] or "").split())
    classes = len({label[i] for i, r in enumerate(rows) if (r[1] or "").split()})
    assert kept.count() == classes + wordless
    have = {r.doc_id for r in kept.collect()}
    assert {min(rows[j][0] for j in range(len(rows)) if label[j] == c and rows[j][0] is not None)
            for c in set(label) if any(rows[j][0] is not None for j in range(len(rows)) if label[j] == c)} <= have


def test_intersections_both_ways():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    off = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = np.triu_indices(30, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]
    flat = np.concatenate(sets)
    assert jaccard_join.intersections(a, b, flat, off).tolist() == want  # many pairs
    assert jaccard_join.intersections(a[:50], b[:50], flat, off).tolist() == want[:50]  # few


def test_suffix_sort_equals_sorting():
    rng = np.random.default_rng(0)
    for _ in range(60):
        n = int(rng.integers(1, 70))
        data = rng.integers(0, 2, n).astype(np.uint8)
        start, segment = np.arange(n), rng.integers(0, 3, n)
        order = PrefixHash(data).sort(start, n - start, segment)
        assert order.tolist() == sorted(range(n), key=lambda i: (segment[i], bytes(data[i:])))
        a, b = rng.integers(0, n, 20), rng.integers(0, n, 20)
        cap = n - np.maximum(a, b)
        want = [next((k for k in range(c) if data[i + k] != data[j + k]), c) for i, j, c in zip(a, b, cap)]
        assert PrefixHash(data).lce(a, b, cap).tolist() == want


def repeat_texts(rnd):
    def noise(n):
        return "".join(rnd.choice("abé ") for _ in range(n))
    p, q = noise(300), noise(450)
    texts = [noise(500), p + noise(50), noise(20) + p[:260] + noise(30) + q, q[100:] + noise(10), "a" * 1000, "a" * 150, None, "",
             noise(180) + p[40:] + q[:215], noise(600), "ab" * 300, noise(1) + "ab" * 110]
    texts += [noise(100) + p + noise(5 + i) for i in range(6)] + [p + noise(50)] * 2 + [texts[0]] * 2
    texts += [noise(30) + p[i:i + 210] + noise(30) for i in range(0, 80, 9)]
    return texts + [noise(30_000) + q[5:300] + noise(30_000)]


@pytest.mark.parametrize("hot, bits", [(16_384, 64), (2, 64), (16_384, 8), (2, 8)])
def test_op6_equals_brute_force(spark, monkeypatch, hot, bits):
    """Also where hashes of 8 bits collide all the time."""
    monkeypatch.setattr(substring_dedup, "HOT_CONTEXTS", hot)
    texts = repeat_texts(random.Random(7))
    rows = [(i if i % 7 else None, t, "xx", "s") for i, t in enumerate(texts)]
    docs = docs_frame(spark, rows, extra=True).repartition(3)
    want = repeats_brute(texts, 200)
    got = sorted(map(tuple, substring_dedup.removal_digests(docs, bits=bits).collect()), key=repr)
    assert got == sorted(((r[0], *w[:3], sha(w[3])) for r, w in zip(rows, want)), key=repr)
    cut = substring_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns
    left = sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr)
    assert left == sorted(((r[0], None if r[1] is None else w[3].decode("utf-8", "ignore")) for r, w in zip(rows, want)), key=repr)


def test_anchors_of_equal_strings_are_equal():
    rnd = random.Random(9)
    shared = "".join(rnd.choice("abc") for _ in range(200)).encode()
    for _ in range(30):
        texts = [("".join(rnd.choice("abc") for _ in range(rnd.randint(0, 300)))).encode() for _ in range(2)]
        a, b = texts[0] + shared, texts[1] + shared + texts[0]
        off = np.array([0, len(a), len(a) + len(b)])
        doc, pos, *_ = substring_dedup.anchors(np.frombuffer(a + b, np.uint8), off)
        at = [{int(p) - s for p in pos[doc == d] if s <= p <= s + 160} for d, s in ((0, len(texts[0])), (1, len(texts[1])))]
        assert at[0] & at[1]


def vectors(rng):
    base = rng.standard_normal((6, 24))
    rows = []
    for i in range(160):
        x = base[i % 6] * rng.uniform(0.1, 5) + rng.standard_normal(24) * rng.choice([0.0, 0.02, 0.09, 1.0])
        rows.append((i, [float(v) for v in x], int(i % 2)))
    rows += [(200, None, 1), (201, [], 1), (202, [0.0] * 24, 1), (203, [None] + [1.0] * 23, 1), (204, [float("nan")] * 24, 0),
             (205, [float("inf")] + [1.0] * 23, 0), (206, rows[0][1], None), (207, rows[0][1], 0), (207, rows[0][1], 0),
             (None, rows[1][1], 1), (208, [1.0, 2.0], 1), (209, [2.0, 4.0], 1), (210, [0.0, -0.0, 1.0], 0), (211, [0.0, 0.0, 1.0], 0)]
    return rows


def vector_brute(rows, threshold=0.98):
    def ok(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    x = [np.array(np.array(r[1], np.float32), float) if ok(r[1]) and r[2] is not None else None for r in rows]
    n = len(rows)
    links, label = [0] * n, list(range(n))
    pairs = [(i, j) for i in range(n) for j in range(i) if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2]
             and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= threshold]
    for i, j in pairs:
        links[i], links[j] = links[i] + 1, links[j] + 1
    for _ in range(n):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    return links, label


@pytest.mark.parametrize("tile", [2048, 16])
def test_op2_equals_brute_force(spark, tile):
    rows = vectors(np.random.default_rng(4))
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "'x' AS node", "'y' AS tiles").repartition(3)
    got = near_vectors.near_vectors(df, tile=tile).collect()
    links, label = vector_brute(rows)
    ids = {}
    for i, r in enumerate(rows):
        ids.setdefault(label[i], []).append(r[0])
    first = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    want = [(r[0], links[i], first[label[i]] if first[label[i]] is not None else r[0]) for i, r in enumerate(rows)]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == sorted(want, key=repr)


def test_op2_bound_drops_no_link():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 64))
    y = x[rng.integers(0, 300, 500)] + rng.standard_normal((500, 64)) * rng.choice([0.05, 0.15, 0.25], (500, 1))
    _, codes, factor = near_vectors.encode(y)
    turned, _, _ = near_vectors.encode(x)
    cos = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T
    estimate = turned @ near_vectors.code_vectors(codes, 64).T / factor
    passed = estimate >= near_vectors.lower_bound(factor, 0.98, 1.0)
    assert (cos >= 0.98).any() and passed[cos >= 0.98].all()
    assert passed.mean() < 0.05  # most pairs are decided by the code


def test_op2_estimate_is_unbiased():
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((2, 64))
    x, y = x / np.linalg.norm(x), y / np.linalg.norm(y)
    got = []
    for seed in range(300):
        q = near_vectors.rotation(64, seed)
        code = np.sign(x @ q) / 8
        got.append((code @ (y @ q)) / (code @ (x @ q)))
    assert abs(np.mean(got) - x @ y) < 0.03


def test_empty_tables(spark, tmp_path):
    folder = save(docs_frame(spark, []), tmp_path, "documents")
    save(spark.createDataFrame([], VECTORS), tmp_path, "embeddings")
    for query in (near_vectors.op2_near_vectors, substring_dedup.op6_substring_dedup, jaccard_join.op9_jaccard_join):
        assert query(spark, folder).count() == 0
