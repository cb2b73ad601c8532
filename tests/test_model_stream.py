"""Baseline training (K2-K3), TF-IDF shape (K1) and the rate-flag stream."""

import collections
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.functions.text import clean_text
from tessera.operators import features as FE
from tessera.operators import model as MD
from tessera.streaming import backlog as BL
from tessera.streaming import stream as ST


def test_baseline_training_separable(spark):
    rows = [("harbour lamp gladly shines", 1, "train"), ("gladly shines garden", 1, "train"),
            ("rust drizzle grumbles", 0, "train"), ("grumbles swamp rust", 0, "train"),
            ("garden lamp gladly", 1, "train"), ("swamp drizzle rust grumbles", 0, "train"),
            ("lamp shines", 1, "val"), ("rust swamp", 0, "val"),
            ("gladly garden", 1, "test"), ("grumbles drizzle", 0, "test")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "doc_id long, text string, label int, split string")
    cfg = DEFAULT.with_(tfidf_max_features=100, ngram_max=1)
    cands = MD.train_and_evaluate(df, cfg)
    base = [c for c in cands if c.model_type.startswith("baseline")][0]
    assert base.metrics["accuracy"] >= 0.7 and base.metrics["n_features"] > 0
    q = spark.createDataFrame([("garden shines",)], "text string")
    assert MD.predict(base.model, q).first().pred_class == 1


def test_tfidf_shapes(spark):
    cfg = DEFAULT.with_(tfidf_max_features=10, ngram_max=1)
    train = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["north wind", "south wind", "north shore", "calm shore"])], "doc_id long, text string")
    idf, n = FE.fit_vocabulary(train, "text", cfg)
    assert n == 4 and idf.count() <= 10
    w = FE.tfidf_weights(train, "text", "doc_id", idf, 1)
    norms = w.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert len(norms) == 4 and all(abs(r.s - 1) < 1e-9 for r in norms)


def sequential(rows, limit, window_s):
    """X4 one hit at a time: ``rows`` = (event_id, user, ts)."""
    state, out = {}, {}
    for eid, user, ts in sorted(rows, key=lambda r: (r[2], r[0])):
        start, hits = state.get(user, (None, 0))
        if start is None or (ts - start).total_seconds() >= window_s:
            start, hits = ts, 0
        state[user] = (start, hits + 1)
        out[eid] = (hits + 1, hits + 1 > limit)
    return out


def closed(rows, delay):
    """Events that the watermark has passed at the end."""
    last = max(ts for _, _, ts in rows)
    return {e for e, _, ts in rows if ts <= last - delay}


def write_slices(spark, root, slices):
    """One parquet file per slice, written (and so listed) in order."""
    for rows in slices:
        spark.createDataFrame([(e, ts, u, "view", 1.0, "{}") for e, u, ts in rows],
                              ST.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(str(root))
    return str(root)


def hits_of(df):
    return {r.event_id: (r.hits, r.flagged) for r in df.collect()}


T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("per_batch", [100, 10_000])
def test_rate_flags_match_sequential_over_shuffled_files(spark, tmp_path, per_batch):
    rnd = random.Random(2)
    rows = [(i, rnd.randint(0, 2), T0 + timedelta(milliseconds=rnd.randint(0, 4 * 3_600_000))) for i in range(4000)]
    parts = [rows[i::8] if i % 2 else sorted(rows[i::8], key=lambda r: r[2], reverse=True) for i in range(8)]
    src = write_slices(spark, tmp_path / "events", parts)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        flags = ST.rate_flags(ST.event_stream(spark, src), DEFAULT, limit=5, window_s=60)
        got = hits_of(ST.run_available(flags, "rate_test", src))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = sequential(rows, 5, 60)
    assert got == {e: want[e] for e in closed(rows, timedelta(hours=1))}


def test_fold_hits_equals_one_by_one():
    rng = np.random.default_rng(3)
    for _ in range(50):
        ts = np.sort(rng.integers(0, 300, rng.integers(1, 60)))
        cut = int(rng.integers(0, len(ts) + 1))
        s1, c1, start, hits = ST.fold_hits(ts[:cut], 40, None, 0)
        s2, c2, _, _ = ST.fold_hits(ts[cut:], 40, start, hits)
        want = sequential([(i, 0, T0 + timedelta(seconds=int(t))) for i, t in enumerate(ts)], 5, 40)
        assert [*c1, *c2] == [want[i][0] for i in range(len(ts))]
        assert all(a <= t < a + 40 for a, t in zip([*s1, *s2], ts))


def test_rate_flags_state_times_out_across_batches(spark, tmp_path):
    rnd = random.Random(5)
    slices, rows, eid = [], [], 0
    for b in range(4):  # every slice holds its own users, two hours apart
        part = []
        for _ in range(200):
            part.append((eid, 10 * b + rnd.randint(0, 4),
                         T0 + timedelta(hours=2 * b, seconds=rnd.randint(0, 300))))
            eid += 1
        slices.append(part)
        rows += part
    src = write_slices(spark, tmp_path / "events", slices)
    q = (ST.rate_flags(ST.event_stream(spark, src, max_files=1), DEFAULT, limit=5, window_s=60, late_delay="10 minutes")
         .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start(str(tmp_path / "out")))
    q.awaitTermination()
    want = sequential(rows, 5, 60)
    assert hits_of(spark.read.parquet(str(tmp_path / "out"))) == {
        e: want[e] for e in closed(rows, timedelta(minutes=10))}
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    # a slice's users leave the state one batch after their windows close
    assert len(state) >= 4 and max(state) <= 10 and state[-1] <= 5


def test_rate_flags_without_delay_counts_every_arrival(spark, tmp_path):
    slices = [[(0, 1, T0 + timedelta(hours=3))], [(1, 1, T0), (2, 1, T0 + timedelta(seconds=1))]]
    src = write_slices(spark, tmp_path / "events", slices)
    flags = ST.rate_flags(ST.event_stream(spark, src, max_files=1), DEFAULT, limit=1, window_s=60, late_delay=None)
    # no hit is dropped: the late hits count against the user's open window
    assert hits_of(ST.run_available(flags, "rate_nodelay", src)) == {0: (1, False), 1: (2, True), 2: (3, True)}


def test_parameters_never_meet_old_results(spark, tmp_path):
    rows = [(i, 0, T0 + timedelta(seconds=i)) for i in range(120)] + [(999, 1, T0 + timedelta(hours=9))]
    src = write_slices(spark, tmp_path / "events", [rows])
    for limit, window in ((5, 60), (1, 10)):
        flags = ST.rate_flags(ST.event_stream(spark, src), DEFAULT, limit=limit, window_s=window)
        want = sequential(rows, limit, window)
        assert hits_of(ST.run_available(flags, "same_name", src)) == {e: want[e] for e in range(120)}


def test_resume_adds_nothing_twice(spark, tmp_path):
    rows = [(i, 0, T0 + timedelta(hours=i)) for i in range(30)]
    src = write_slices(spark, tmp_path / "events", [rows])
    one = [ST.run_available(ST.hourly_volume(ST.event_stream(spark, src)), "resumed", src, resume="a").count() for _ in range(2)]
    assert one[0] == one[1] > 0


def test_volume_and_dedup_over_files_out_of_order(spark, tmp_path):
    days = [[(100 * d + i, 1, T0 + timedelta(days=d, minutes=10 * i)) for i in range(100)] for d in (3, 1, 2)]
    src = write_slices(spark, tmp_path / "events", days)
    write_slices(spark, tmp_path / "events", [days[1]])  # delivered twice
    volume = ST.run_available(ST.hourly_volume(ST.event_stream(spark, src)), "volume", src)
    end = max(ts for part in days for _, _, ts in part) - timedelta(hours=1)
    per_hour = collections.Counter(ts.replace(minute=0, second=0) for part in [*days, days[1]] for _, _, ts in part)
    want = {h: n for h, n in per_hour.items() if h + timedelta(hours=1) <= end}
    assert {r.window_start: r["count"] for r in volume.collect()} == want
    kept = ST.run_available(ST.deduplicated(ST.event_stream(spark, src)), "dedup", src)
    assert sorted(r.event_id for r in kept.collect()) == sorted(e for part in days for e, _, _ in part)
    # one file a batch ties the answer to the order of the files: it is refused
    with pytest.raises(ST.LateRows):
        ST.run_available(ST.hourly_volume(ST.event_stream(spark, src, max_files=1)), "volume", src)
    late = ST.run_available(ST.hourly_volume(ST.event_stream(spark, src, max_files=1)), "volume", src, allow_late=True)
    assert late.count() < len(want)


def test_drift_stream_without_closed_window_is_empty(spark, tmp_path):
    src = write_slices(spark, tmp_path / "events", [[(1, 1, datetime(2024, 1, 9))]])
    ref = spark.createDataFrame([("predicted_sentiment", "positive", 5)], "feature string, category string, ref_n bigint")
    reports, alerts = ST.drift_on_closed_windows(ST.event_stream(spark, src), ref, ["predicted_sentiment"], "drift_none", src)
    assert reports.count() == 0 and alerts.count() == 0 and "drift_score" in reports.columns


def test_distributed_topk_equals_sorted_limit(spark):
    t = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    st = FE.term_counts(t.select(clean_text("text").alias("text")), "text").persist()
    simple = [tuple(r) for r in st.orderBy(F.col("tf").desc(), "term").limit(3000).collect()]
    dist = [tuple(r) for r in FE.vocabulary(st, 3000).collect()]
    assert len(simple) == 3000 and sorted(simple) == sorted(dist)


def test_dedup_stream_across_batches(spark, tmp_path):
    src = tmp_path / "dup"
    rows = [(i, datetime(2024, 1, 1) + timedelta(minutes=i), 1, "view", 1.0, "{}") for i in range(50)]
    df = spark.createDataFrame(rows, ST.EVENTS_SCHEMA).coalesce(1)
    df.write.mode("append").parquet(str(src))
    df.write.mode("append").parquet(str(src))  # every event delivered twice, in a second file
    out = ST.run_available(ST.deduplicated(ST.event_stream(spark, str(src))), "dedup_test", str(src))
    assert out.count() == 50 and out.select("event_id").distinct().count() == 50


def _sparse(rnd, n, hours=30):
    return [(i, rnd.randint(0, 4), T0 + timedelta(milliseconds=rnd.randint(0, hours * 3_600_000))) for i in range(n)]


QUERIES = {
    "volume": lambda s: ST.hourly_volume(s, "1 hour"),
    "sessions": lambda s: ST.user_sessions(s, "5 minutes", "1 hour"),
    "dedup": lambda s: ST.deduplicated(s, "1 hour"),
    "flags": lambda s: ST.rate_flags(s, DEFAULT, limit=3, window_s=600, late_delay="1 hour"),
}


def _backlog(spark, root, rows=60):
    return BL.Backlog(spark, str(root), ST.EVENTS_SCHEMA, timedelta(hours=1), slice_rows=rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_backlog_in_slices_equals_one_batch(spark, tmp_path, name):
    """Ten overlapping files in no order; each event delivered twice."""
    rows = _sparse(random.Random(4), 400)
    src = write_slices(spark, tmp_path / "events", [rows[i::5] for i in range(5)] + [rows[i::5] for i in range(5)])
    want = ST.run_available(QUERIES[name](ST.event_stream(spark, src)), "one", src)
    got, progress = _backlog(spark, tmp_path / "b", 90).run(BL.source_files(spark, src), QUERIES[name])
    assert got.columns == want.columns and len(progress) >= 8
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    whole = ST.finish(lambda: QUERIES[name](ST.event_stream(spark, src)).writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    if name != "flags":  # whose state rows are the users
        assert max(p.most_state for p in progress) < whole.most_state / 2  # the state holds a slice and the delay
    assert all(p.dropped == 0 for p in progress)


def test_late_rows_of_a_delivery_do_not_depend_on_files_or_slices(spark, tmp_path):
    rnd = random.Random(6)
    rows = _sparse(rnd, 300)
    first, second = rows[::2], rows[1::2] + [(1000 + i, 1, T0 + timedelta(hours=30, minutes=i)) for i in range(100)]
    limit = max(ts for *_, ts in first) - timedelta(hours=1)
    limit = limit.replace(microsecond=limit.microsecond // 1000 * 1000)
    late = {e for e, _, ts in second if ts <= limit}
    kept = {e for e, *_ in first + second} - late
    for n, parts, size in ((0, 1, 10_000), (1, 4, 50), (2, 7, 20)):
        a = write_slices(spark, tmp_path / f"a{n}", [first[i::parts] for i in range(parts)])
        b = write_slices(spark, tmp_path / f"b{n}", [second[i::parts] for i in rnd.sample(range(parts), parts)])
        backlog = _backlog(spark, tmp_path / f"backlog{n}", size)
        backlog.run(BL.source_files(spark, a), QUERIES["dedup"])
        out, _ = backlog.run(BL.source_files(spark, a) + BL.source_files(spark, b), QUERIES["dedup"])
        assert {r.event_id for r in out.collect()} == kept and out.count() == len(kept)
        assert {(r.event_id, r.delivery) for r in backlog.late_rows().collect()} == {(e, 1) for e in late}


def test_a_stopped_backlog_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    rows = _sparse(random.Random(8), 200)
    src = write_slices(spark, tmp_path / "events", [rows[:100], rows[100:]])
    files, calls = BL.source_files(spark, src), []

    def failing(start):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt
        return ST.finish(start)

    monkeypatch.setattr(BL, "finish", failing)
    backlog = _backlog(spark, tmp_path / "b", 40)
    with pytest.raises(KeyboardInterrupt):
        backlog.run(files, QUERIES["dedup"])
    out, _ = backlog.run(files, QUERIES["dedup"])
    assert sorted(r.event_id for r in out.collect()) == list(range(200))
    again, progress = backlog.run(files, QUERIES["dedup"])
    assert again.count() == 200 and progress == []
    assert backlog.late_rows().count() == 0


def test_rows_without_a_time_are_late_and_an_empty_delivery_is_empty(spark, tmp_path):
    src = write_slices(spark, tmp_path / "events", [[(1, 1, T0), (2, 1, None)]])
    backlog = _backlog(spark, tmp_path / "b")
    out, _ = backlog.run(BL.source_files(spark, src), QUERIES["dedup"])
    assert [r.event_id for r in out.collect()] == [1] and [r.event_id for r in backlog.late_rows().collect()] == [2]
    empty = _backlog(spark, tmp_path / "e")
    out, _ = empty.run([], QUERIES["volume"])
    assert out.count() == 0 and "count" in out.columns and empty.late_rows().count() == 0


def test_drops_are_counted_over_all_batches(spark, tmp_path):
    """More micro-batches than a query remembers."""
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        days = [[(10 * d + i, 1, T0 + timedelta(days=d)) for i in range(10)] for d in (9, 10, 1, *range(11, 18))]
        src = write_slices(spark, tmp_path / "events", days)
        with pytest.raises(ST.LateRows, match="10 rows"):
            ST.run_available(ST.deduplicated(ST.event_stream(spark, src, max_files=1)), "d", src)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)


def test_counted_terms_equal_the_native_ngrams(spark, monkeypatch):
    monkeypatch.setattr(FE, "BATCH_BYTES", 50)
    texts = ["One two, two THREE &amp; four", "", None, "a b c", "two three two three", "x" * 40 + " 12 <b>12</b>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    native = FE.with_grams(df, "text", "g", 3).select("doc_id", F.explode("g").alias("term"))
    want = {r.term: (r.tf, r.df) for r in native.groupBy("term").agg(F.count("*").alias("tf"), F.countDistinct("doc_id").alias("df")).collect()}
    got = FE.term_counts(df.select(clean_text("text").alias("c")), "c", 3).collect()
    assert {r.term: (r.tf, r.df) for r in got} == want and len(got) == len(want)


def test_terms_are_counted_as_numbers_in_small_pieces():
    """counts of a column of texts at once, also where texts touch, are empty or null."""
    import pyarrow as pa
    texts = ["left out", "aa bb", "bb cc", None, "", "x", "aa bb aa bb", "é9é aa1", "left out"]
    terms, tf, df = FE.count_terms(pa.array(texts).slice(1, 7), 3)
    want = {}
    for i, text in enumerate(texts[1:8]):
        for g in FE._grams(text or "", 3):
            n, rows = want.setdefault(g, [0, set()])
            want[g] = [n + 1, rows | {i}]
    assert dict(zip(terms.to_pylist(), zip(tf.tolist(), df.tolist()))) == {g: (n, len(r)) for g, (n, r) in want.items()}
    assert len(FE.count_terms(pa.array([None, ""], pa.string()), 2)[0]) == 0
    assert FE.BATCH_BYTES <= 1 << 20  # what a worker counts at a time


def test_a_worker_counts_many_texts_in_little_memory():
    """what a worker needs besides its Arrow batch is that of a small piece of texts."""
    import tracemalloc

    import pyarrow as pa
    texts = [" ".join(f"w{(i * 7919 + j * 104729) % 5003}" for j in range(300)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    got = {}
    tracemalloc.start()
    try:
        for piece in FE._pieces(batch, "text", FE.BATCH_BYTES):
            tracemalloc.reset_peak()
            before = tracemalloc.get_traced_memory()[0]
            terms, tf, df = FE.count_terms(piece.column("text"), 2)
            assert tracemalloc.get_traced_memory()[1] - before < 8 << 20
            tracemalloc.stop()
            for term, n, rows in zip(terms.to_pylist(), tf.tolist(), df.tolist()):
                old = got.get(term, (0, 0))
                got[term] = (old[0] + n, old[1] + rows)
            tracemalloc.start()
    finally:
        tracemalloc.stop()
    terms, tf, df = FE.count_terms(batch.column("text"), 2)
    assert got == dict(zip(terms.to_pylist(), zip(tf.tolist(), df.tolist())))


def test_vocabulary_shuffles_no_statistics(spark):
    """the few buckets that reach rank k are broadcast to the statistics."""
    st = spark.createDataFrame([(f"t{i}", i % 7 + 1, 1) for i in range(200)], "term string, tf long, df long")
    plan = FE.vocabulary(st, 20)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2


def test_fitting_naive_bayes_keeps_no_rows(spark, monkeypatch):
    """n-grams, many times the text, are never cached; naive Bayes reads its rows once."""
    kept = []
    frame = type(spark.range(1))
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: (kept.append(self.columns), persist(self, *a))[1])
    rows = [(i, f"good film {i}" if i % 2 else f"bad film {i}", i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    cfg = DEFAULT.with_(logreg_max_iter=5)
    assert set(MD.fit_candidates(df, cfg, only=("naive_bayes_counts",))) == {"naive_bayes_counts"} and not kept
    assert list(MD.fit_candidates(df, cfg)) == ["baseline_tfidf_logreg", "naive_bayes_counts"]
    assert kept == [["tf", "label_d"]]
