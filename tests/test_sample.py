"""Stratified split (W1, L1-L3) and the skew-safe ordered helpers."""

import hashlib
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import activity as A
from tessera.operators import sample as S
from tessera.operators import segments as G


def test_balanced_split_80_10_10(spark):
    rows = [(i, f"positive sample {i}", 1) for i in range(50)] + \
           [(50 + i, f"negative sample {i}", 0) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    s = S.stratified_split(df).groupBy("split").agg(F.count("*").alias("n"), F.avg("label").alias("m"))
    got = {r.split: (r.n, r.m) for r in s.collect()}
    assert got == {"train": (80, 0.5), "val": (10, 0.5), "test": (10, 0.5)}


def test_cutoffs_equal_window_rank(spark):
    rnd = random.Random(7)
    rows = [(i, 0 if rnd.random() < 0.7 else 1) for i in range(3000)]  # a hot class
    df = spark.createDataFrame(rows, "doc_id long, label int")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(S.order_hash("doc_id", 42), "doc_id"))
    quotas = [0, 1, 7, 450, 10_000]
    got = S.with_cutoffs(df, "doc_id", "label", [F.lit(q) for q in quotas], 42, prefix=2).withColumn("r", rank)
    for i, q in enumerate(quotas):
        assert got.where(F.col(f"_in_{i}") != (F.col("r") <= q)).count() == 0
    assert got.count() == 3000


def _odd_rows(n=1200):
    """Repeated, null and hot keys, null labels, rows equal in every column."""
    rnd = random.Random(11)
    rows = []
    for i in range(n):
        key = rnd.choice([7, 7, 7, None, rnd.randrange(40), i])
        rows.append((key, rnd.choice(["same", "same", f"text {i}"]), rnd.choice([0, 1, 1, None])))
    return rows


def test_quotas_are_exact_with_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES", 7)
    rows = _odd_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(5)
    sizes = Counter(r[2] for r in rows)
    for quotas in ([0, 1, 2], [50, 50, 51], [100, 333, 5000]):
        got = S.with_cutoffs(df, "doc_id", "label", [F.lit(q) for q in quotas], 42, prefix=1).collect()
        assert Counter((r.doc_id, r.text, r.label) for r in got) == Counter(rows)
        for i, q in enumerate(quotas):
            assert Counter(r.label for r in got if r[f"_in_{i}"]) == Counter({c: min(q, n) for c, n in sizes.items() if q})
        # in the order of (hash, key): no row that is out comes before one that is in
        for label in sizes:
            inside = [_place(r.doc_id) for r in got if r.label == label and r._in_1]
            outside = [_place(r.doc_id) for r in got if r.label == label and not r._in_1]
            assert not inside or not outside or max(inside) <= min(outside)


def _place(key):
    return hashlib.md5(("42" if key is None else f"42:{key}").encode()).hexdigest()


def test_quotas_when_all_rows_are_equal(spark):
    df = spark.createDataFrame([(1, "t", 0)] * 1000, "doc_id long, text string, label int").repartition(7)
    assert S.balanced_cap(df, max_samples=100).count() == 100
    split = {r.split: r["count"] for r in S.stratified_split(df).groupBy("split").count().collect()}
    assert split == {"test": 100, "val": 100, "train": 800}
    none = spark.createDataFrame([(None, f"t{i}", 0) for i in range(1000)], "doc_id long, text string, label int")
    assert S.balanced_cap(none, max_samples=100).count() == 100
    # the same rows whatever the layout
    one, two = (S.balanced_cap(none.repartition(n, "text"), max_samples=100).select("text").collect() for n in (2, 9))
    assert sorted(one) == sorted(two)


def test_caps_leave_out_null_labels_and_splits(spark):
    rows = [(i, None if i % 3 == 0 else i % 3) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    got = Counter(r.label for r in S.balanced_cap(df, max_samples=60).collect())
    assert got == {1: 30, 2: 30}
    assert S.balanced_cap(df, max_samples=300).count() == 300
    s = spark.createDataFrame([(i % 9, ["train", "train", "val", "test", None][i % 5]) for i in range(500)], "doc_id long, split string")
    got = Counter(r.split for r in S.proportional_cap(s, max_total=40).collect())
    assert got == {"train": 20, "val": 10, "test": 10}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_segmented_scans_match_plain_windows(spark, partitions):
    """A key with half of the rows, null keys and values; more partitions than keys."""
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.5 else rnd.choice([None, "a", "z", f"k{rnd.randint(0, 5)}"]), i,
             rnd.random() if rnd.random() < 0.8 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, o long, v double")
    w = Window.partitionBy("k").orderBy("o")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("k", "o", "v", F.max("v").over(before).alias("m"), F.lag("o").over(w).alias("p"), F.lead("v").over(w).alias("n"))
    r = G.Ranged.of(df, ["k"], ["o"], partitions)
    assert r.rows.select("_pid").distinct().count() >= min(partitions, 2)
    if partitions == 40:
        assert r.rows.where("k = 'hot'").select("_pid").distinct().count() > 10  # split
    got = G.neighbours(G.running_max_before(r, F.col("v"), "m"), ["o", "v"]).rows
    got = got.select("k", "o", "v", "m", F.col("prev_o").alias("p"), F.col("next_v").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    empty = G.neighbours(G.Ranged.of(df.limit(0), ["k"], ["o"]), ["o"]).rows
    assert empty.count() == 0


def _hits(rnd, n):
    """Hits in milliseconds: bursts, equal times, gaps, and one user with most of them."""
    out, at = [], {}
    for i in range(n):
        user = "hot" if rnd.random() < 0.7 else rnd.choice([None, "b", "c", f"u{rnd.randint(0, 30)}"])
        at[user] = at.get(user, 0) + rnd.choice([0, 0, 1, 5, 40, 300 if rnd.random() < 0.1 else 7])
        out.append((i, user, at[user]))
    rnd.shuffle(out)
    return out


def _one_by_one(rows, span):
    state, out = {}, {}
    for i, user, t in sorted(rows, key=lambda r: (r[2], r[0])):
        start, hits = state.get(user, (None, 0))
        if start is None or t >= start + span:
            start, hits = t, 0
        state[user] = start, hits + 1
        out[i] = start, hits + 1
    return out


@pytest.mark.parametrize("partitions, span", [(1, 60), (9, 60), (60, 60), (60, 5000), (25, 1)])
def test_rate_windows_equal_one_by_one(spark, partitions, span):
    rows = _hits(random.Random(partitions + span), 3000)
    df = spark.createDataFrame(rows, "event_id long, user_id string, ms long").selectExpr(
        "event_id", "user_id", "timestamp_millis(ms) AS ts")
    got = A.rate_windows(df, limit=3, window=timedelta(milliseconds=span), partitions=partitions)
    if partitions == 60:
        assert got.select("_pid", "user_id").where("user_id = 'hot'").distinct().count() > 20  # one user, many tasks
    got = {r.event_id: (r.start, r.hits, r.flagged) for r in got.selectExpr(
        "event_id", "unix_millis(window_start) AS start", "hits", "flagged").collect()}
    assert got == {i: (s, h, h > 3) for i, (s, h) in _one_by_one(rows, span).items()}


def test_rate_windows_without_rows_or_times(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", datetime(2024, 1, 1))], "event_id long, user_id string, ts timestamp")
    got = A.rate_windows(df, limit=1, window=timedelta(seconds=1)).select("event_id", "hits", "flagged").collect()
    assert [tuple(r) for r in got] == [(2, 1, False)]
    assert A.rate_windows(df.limit(0), limit=1, window=timedelta(seconds=1)).count() == 0


@pytest.mark.parametrize("partitions", [1, 30])
def test_sessions_equal_one_by_one(spark, partitions):
    rows = _hits(random.Random(5), 2500)
    df = spark.createDataFrame([(*r, float(r[0])) for r in rows], "event_id long, user_id string, ms long, value double").selectExpr(
        "event_id", "user_id", "timestamp_millis(ms) AS ts", "value")
    want, last = [], {}
    for i, user, t in sorted(rows, key=lambda r: (r[2], r[0])):
        if user not in last or t >= last[user][2] + 30:
            last[user] = [user, t, t, 0, 0.0]
            want.append(last[user])
        last[user][2:] = [t, last[user][3] + 1, last[user][4] + i]
    got = A.sessions(df, timedelta(milliseconds=30), partitions).selectExpr(
        "user_id", "unix_millis(session_start)", "unix_millis(session_end)", "events", "value").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((u, a, b + 30, n, v) for u, a, b, n, v in want), key=str)


def test_balanced_cap(spark):
    rows = [(i, 1 if i < 30 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, label int")
    got = S.balanced_cap(df, max_samples=20)
    c = {r.label: r["count"] for r in got.groupBy("label").count().collect()}
    assert c == {0: 10, 1: 10}
