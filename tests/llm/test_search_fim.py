"""Operators 11 to 13 against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import docs_frame, odd_rows, save, sha, words  # noqa: E402

from tessera.llm import exact_topk, fill_middle, orchard  # noqa: E402

VECTORS = "vec_id long, embedding array<double>, label long"


def vectors(spark, rows, extra=False):
    df = spark.createDataFrame(rows, VECTORS)
    if extra:
        for name in ("key", "tile", "stripe", "kind", "copies", "norm", "vector", "score", "rank", "cluster", "n", "id"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


# -- 11 ----------------------------------------------------------------------

def topk_brute(rows, k=20, every=20, scale=64):
    """Sorted rows (query_id, rank, vec_id, score), row by row."""
    most = 2**63 - 1
    whole = [(i, [math.floor(scale * c) if abs(c) < 2**50 else int(scale * c) for c in v])
             for i, v, *_ in rows if usable(v)]
    out = []
    for q, (qid, a) in enumerate(whole):
        if qid is None or qid % every:
            continue
        hits = [(-max(-most, min(most, sum(x * y for x, y in zip(a, b)))), cid is None, cid)
                for c, (cid, b) in enumerate(whole) if c != q and len(a) == len(b)]
        hits.sort(key=lambda h: (h[0], h[1], h[2] or 0))
        out += [(qid, r + 1, h[2], -h[0]) for r, h in enumerate(hits[:k])]
    return sorted(out, key=repr)


def topk(spark, rows, extra=False, **more):
    df = exact_topk.top_k(vectors(spark, rows, extra), lambda v: v % 20 == 0, **more)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op11_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CHUNK", 16)
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 8)) * rng.choice([0.2, 1, 9], (700, 1))
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    assert topk(spark, rows, extra=True, tile=7, stripe=60) == topk_brute(rows)
    assert topk(spark, rows, k=1) == topk_brute(rows, k=1)


def test_op11_ties_of_equal_vectors(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((900, 3)), 1)
    x[rng.permutation(900)[:500]] = [0.5, -0.25, 1.0]
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    assert topk(spark, rows, stripe=100) == topk_brute(rows)


def test_op11_reported_bins_are_bounded(spark):
    """A group reports at most k scores' worth of bins and of ties a query."""
    n = 4000
    rng = np.random.default_rng(6)
    x = np.where(rng.random((n, 1)) < 0.5, 1, rng.integers(-9, 9, (n, 4)))
    q = np.arange(3)
    held = pa.RecordBatch.from_pydict({
        "id": q, "key": q - 9, "copies": q * 0 + 1, "lo": q * 0 - 2**13, "hi": q * 0 + 2**13, "step": q * 0 + 65, "need": q * 0 + 20,
        "norm": np.full(3, 20.0), "vector": [x[i].astype("<i2").tobytes() for i in q]})
    norm = np.linalg.norm(x, axis=1)
    for kind in (exact_topk.Histogram, exact_topk.Filter):
        t = kind(4, [held])
        if kind is exact_topk.Filter:
            t.lo = np.sort(x @ x[:3].T, axis=0)[-20]
            t.need = 20 - (x @ x[:3].T > t.lo).sum(axis=0)
        t.add(x.astype(float), norm, np.arange(n), np.ones(n, np.int64), np.arange(n) + 7, np.zeros(n, bool))
        assert sum(b.num_rows for b in t.result()) <= 60


def test_op11_odd_rows(spark, tmp_path):
    one = [1.0, 0.0]
    rows = [(20, one, 1), (20, one, 1), (40, [0.0, 0.0], None), (1, one, 1), (2, [0.015, -0.015], 1), (None, one, 1), (None, one, 1),
            (60, None, 1), (80, [None, 1.0], 1), (100, [math.nan, 1.0], 1), (120, [math.inf, 1.0], 1), (140, [], 1), (160, [], 1),
            (180, [1.0, 2.0, 3.0], 1), (3, [-5.0, 1e6], 1), (200, [-3e17, 1.5], 1), (4, [2e300, 1.0], 1), (5, [1e12, -1e12], 1)]
    assert topk(spark, rows, extra=True) == topk_brute(rows)
    assert topk(spark, rows, k=2, stripe=2, tile=1) == topk_brute(rows, k=2)
    assert topk(spark, []) == [] and topk(spark, [(1, one, 1)]) == [] and topk(spark, [(20, one, 1)]) == []
    path = save(vectors(spark, rows, extra=True), tmp_path, "embeddings")
    assert sorted((tuple(r) for r in exact_topk.op11_topk(spark, path).collect()), key=repr) == topk_brute(rows)


def test_op11_long_range_of_scores(spark):
    """More than two rounds."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(c) for c in rng.standard_normal(4) * 10.0 ** rng.integers(0, 6)], 0) for i in range(300)]
    assert topk(spark, rows) == topk_brute(rows)


# -- 12 ----------------------------------------------------------------------

def cluster_brute(rows, k=8, dim=64, rounds=10, scale=1024, seed=3):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v, *_ in rows if usable(v) and len(v) == dim]
    key = lambda r: (r[0] is None, "" if r[0] is None else sha(f"{seed}:{r[0]}".encode()),
                     b"".join(c.to_bytes(8, "little", signed=True) for c in r[1]))
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for j in range(len(centroids)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in found:
        inertia[j] += d
    most = 2**63 - 1
    out = [(i, j, min(d, most), min(inertia[j], most), min(sum(inertia.values()), most), sha(",".join(map(str, centroids[j])).encode()))
           for i, d, j in found]
    return sorted(out, key=repr)


def clusters(spark, rows, **more):
    df = orchard.digests(*orchard.cluster(vectors(spark, rows, extra=True), **more))
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op12_equals_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((6, 64))[rng.integers(0, 6, 250)] + 0.3 * rng.standard_normal((250, 64))
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    path = save(vectors(spark, rows), tmp_path, "embeddings")
    df = orchard.op12_orchard(spark, path)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == cluster_brute(rows)


def test_op12_ties_and_empty_clusters(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(c) for c in rng.integers(-1, 2, 2)], 0) for i in range(120)]
    want = cluster_brute(rows, k=12, dim=2, rounds=3)
    assert clusters(spark, rows, k=12, dim=2, rounds=3) == want
    assert len({r[1] for r in want}) < 12


def test_op12_odd_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [0.5, 0.0], 1), (None, [9.0, 9.0], 1), (2, None, 1), (3, [None, 1.0], 1),
            (4, [math.nan, 0.0], 1), (5, [1.0], 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1e6, -1e6], 1), (9, [3e12, 5.0], 1),
            (10, [-0.0004, 4.0], None)]
    for k in (2, 3, 20):
        assert clusters(spark, rows, k=k, dim=2) == cluster_brute(rows, k=k, dim=2)
    assert clusters(spark, [], k=3, dim=2) == [] and clusters(spark, [(2, None, 1)], k=3, dim=2) == []
    far = clusters(spark, [(1, [1e300, 0.0], 1), (2, [-1e300, 0.0], 1), (3, [0.0, 0.0], 1)], k=1, dim=2)
    assert [r[:3] for r in far] == [(1, 0, far[0][2]), (2, 0, far[1][2]), (3, 0, far[2][2])] and far[0][2] == 2**63 - 1


def test_op12_search_skips_far_centroids():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-20_000, 20_000, (64, 8))
    x = centroids[rng.integers(0, 64, 3000)] + rng.integers(-900, 900, (3000, 8))
    search = orchard.Orchard(centroids)
    best, dist, compared = search.assign(x)
    full = ((x[:, None] - centroids) ** 2).sum(axis=2)
    assert (best == full.argmin(axis=1)).all() and (dist == full.min(axis=1)).all()
    assert compared < 0.75 * full.size


# -- 13 ----------------------------------------------------------------------

def fim_brute(doc_id, text):
    t = text or ""
    n = len(t)
    form, a, b, out = "plain", None, None, t
    if t and doc_id is not None and not any(s in t for s in ("<P>", "<S>", "<M>")):
        d = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
        h = [int(d[i:i + 8], 16) for i in range(0, 32, 8)]
        if h[2] % 100 < 90:
            form = "spm" if h[3] % 100 < 20 else "psm"
            lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            p, m, s = t[:lo], t[lo:hi], t[hi:]
            out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
            a, b = lo, hi - lo
    return (doc_id, n, form, a, b, sha(out.encode()), sha(t.encode())), out


def fim_rows():
    rnd = random.Random(8)
    rows = odd_rows(rnd)
    rows += [(100 + i, t, "xx", "s") for i, t in enumerate(
        ["<P>", "a<S>b", "x<M>", "<P", "<", "S>", "<<<<", "P>M>S>", "<P<S<M", "🤦🏼‍♂️é" * 9, "\x00a\x00", "\n", "<" * 50])]
    rows += [(1000 + i, "<" * i + words(rnd, i % 30) + "<P<" + "é🙂<" * (i % 7), "yy", "s") for i in range(150)]
    return rows


@pytest.mark.parametrize("chunk", [1, 3, 1 << 16])
def test_op13_equals_brute_force(spark, chunk):
    rows = [r for r in fim_rows() if chunk > 1 or len(r[1] or "") < 500]
    got = fill_middle.digests(docs_frame(spark, rows, extra=True), chunk=chunk).collect()
    assert Counter(tuple(r) for r in got) == Counter(fim_brute(r[0], r[1])[0] for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_op13_outputs_and_registered_query(spark, tmp_path):
    rows = fim_rows() + [(7777, "again and again", "xx", "s")] * 300
    docs = docs_frame(spark, rows).repartition(5)
    out = fill_middle.transform(docs).collect()
    assert Counter((r.doc_id, r.form, r.output) for r in out) == Counter(
        (r[0], fim_brute(*r[:2])[0][2], fim_brute(*r[:2])[1]) for r in rows)
    got = fill_middle.op13_fill_middle(spark, save(docs, tmp_path, "documents"))
    assert Counter(tuple(r) for r in got.collect()) == Counter(fim_brute(r[0], r[1])[0] for r in rows)
    empty = fill_middle.digests(docs_frame(spark, rows).limit(0))
    assert empty.collect() == [] and empty.columns == got.columns


def test_op13_one_shuffle(spark):
    plan = fill_middle.digests(docs_frame(spark, [(1, "a b", "x", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 2


def test_op13_sentinels_that_could_overlap_are_refused():
    for bad in (("<P>", "<S>", "<S>"), ("aa", "ab", "ac"), ("<P>", "<PM>", "<S>"), ("", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.Plan(sentinels=bad)
