"""Drift (R1/R2), alerts (R4, T6), registry (W4), run fold (W5), evaluation
and metrics helpers, restating the reference's cases."""

import json
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.functions.dates import window_start
from tessera.functions.mathx import softmax_argmax
from tessera.operators import alerts as AL
from tessera.operators import drift as D
from tessera.operators import evaluate as EV
from tessera.operators import metrics as M
from tessera.operators import registry as RG
from tessera.operators import runs as RN


def test_drift_fallback_case(spark):
    ref = spark.createDataFrame([("positive", 10), ("positive", 12), ("negative", 9), ("negative", 11)],
                                "predicted_sentiment string, input_length int")
    cur = spark.createDataFrame([("positive", 10)] * 4, "predicted_sentiment string, input_length int")
    dist, rep = D.detect_drift(ref, cur, DEFAULT.with_(drift_threshold=0.1))
    d = {r.feature: r.distance for r in dist.collect()}
    assert abs(d["predicted_sentiment"] - 0.5) < 1e-12 and abs(d["input_length"] - 0.75) < 1e-12
    r = rep.first()
    assert (r.reference_size, r.current_size, r.features_drifted, r.drift_score) == (4, 4, 2, 1.0)
    assert r.prediction_drift_detected and r.report_path


def _report(spark, score, pred=False):
    return spark.createDataFrame(
        [("r1", datetime(2024, 1, 1).date(), score, 1, 5, pred, "p", datetime(2024, 1, 1))],
        "id string, report_date date, drift_score double, features_drifted int, total_features int, "
        "prediction_drift_detected boolean, report_path string, created_at timestamp_ntz")


def test_alert_rule_thresholds(spark):
    assert AL.alerts_from_reports(_report(spark, 0.2)).first().severity == "warning"
    a = AL.alerts_from_reports(_report(spark, 0.4)).first()
    assert a.severity == "critical" and a.message == "Critical drift detected: score=0.4000"
    assert AL.alerts_from_reports(_report(spark, 0.1)).count() == 0
    assert AL.alerts_from_reports(_report(spark, 0.1, True)).first().alert_type == "model_degradation"
    meta = json.loads(AL.alerts_from_reports(_report(spark, 0.4)).first().metadata)
    assert meta == {"drift_score": 0.4, "features_drifted": 1, "total_features": 5, "report_path": "p"}


def test_lead_alert_banner(spark):
    rows = [("a", "drift_warning", "warning", "m1", datetime(2024, 1, 3), False),
            ("b", "drift_critical", "critical", "m2", datetime(2024, 1, 2), False),
            ("c", "drift_warning", "warning", "m3", datetime(2024, 1, 1), True)]
    df = spark.createDataFrame(rows, "id string, alert_type string, severity string, message string, "
                                     "created_at timestamp_ntz, is_resolved boolean")
    r = AL.lead_alert(df).first()
    assert r.id == "b" and r.more_count == 1
    assert AL.lead_alert(df.withColumn("is_resolved", F.lit(True))).count() == 0


def _sequential_registry(history):
    """The registry rules applied one registration at a time."""
    prod, out = None, []
    for f1, has in history:
        cur = prod[1] if prod else None
        new = {"f1_macro": f1} if has and f1 is not None else ({} if has else None)
        promote = (not cur) or float((new or {}).get("f1_macro", 0.0)) > float(cur.get("f1_macro", 0.0))
        out.append(promote)
        if promote:
            prod = (len(out), new if has else None)
    return out


def test_registry_cases_and_random_histories(spark):
    def ledger(history):
        rows = [("m", i + 1, f1, has) for i, (f1, has) in enumerate(history)]
        df = spark.createDataFrame(rows, "name string, version long, f1_macro double, has_metrics boolean")
        return RG.promotion_ledger(df).orderBy("version").collect()
    r = ledger([(0.7, True), (0.8, True)])
    assert r[1].promoted and r[1].stage == "Production" and r[0].stage == "Archived"
    r = ledger([(0.9, True), (0.8, True)])
    assert not r[1].promoted and r[1].stage == "Staging"
    r = ledger([(0.8, True)])
    assert r[0].promoted and r[0].old_f1 == 0.0
    rnd = random.Random(11)
    for _ in range(15):
        h = [(rnd.choice([None, 0.5, 0.6, 0.7, 0.8]), rnd.random() < 0.8) for _ in range(rnd.randint(1, 9))]
        got = [x.promoted for x in ledger(h)]
        assert got == _sequential_registry(h), h


def test_gate_strictness(spark):
    df = spark.createDataFrame([(0.81, 0.80, True), (0.80, 0.80, True), (0.80, None, False)],
                               "new double, cur double, has boolean")
    got = [r[0] for r in df.select(RG.is_better(F.col("new"), F.col("cur"), F.col("has"))).collect()]
    assert got == [True, False, True]


def _sequential_runs(events):
    rows, open_row = [], {}
    for eid, key, kind, at in sorted(events, key=lambda e: (e[1], e[3], e[0])):
        if kind == "start":
            open_row[key] = at
        else:
            if key in open_row:
                st = open_row.pop(key)
                rows.append((key, kind, st, at, max(0, round((at - st).total_seconds()))))
            else:
                rows.append((key, kind, at, at, 0))
    for key, st in open_row.items():
        rows.append((key, "running", st, None, None))
    return sorted(rows, key=str)


def test_run_fold_matches_sequential_rules(spark):
    rnd = random.Random(5)
    t0 = datetime(2024, 1, 1)
    ev = [(i, f"r{rnd.randint(0, 3)}", rnd.choice(["start", "start", "success", "failed"]),
           t0 + timedelta(seconds=rnd.randint(0, 20000))) for i in range(400)]
    df = spark.createDataFrame([(i, "d", k, kind, at, '{"a": 1}') for i, k, kind, at in ev],
                               "event_id long, dag_id string, run_id string, kind string, "
                               "evt_at timestamp_ntz, metrics string")
    got = sorted(((r.run_id, r.status, r.started_at, r.completed_at, r.duration_seconds)
                  for r in RN.fold_runs(df).collect()), key=str)
    assert got == _sequential_runs(ev)


def test_unmatched_finish_and_double_start(spark):
    rows = [(1, "d", "x", "success", datetime(2024, 1, 1, 0, 0), "{}"),
            (2, "d", "y", "start", datetime(2024, 1, 1, 0, 0), None),
            (3, "d", "y", "start", datetime(2024, 1, 1, 0, 1), None),
            (4, "d", "y", "failed", datetime(2024, 1, 1, 0, 2, 30), '{"error": "boom"}')]
    df = spark.createDataFrame(rows, "event_id long, dag_id string, run_id string, kind string, "
                                     "evt_at timestamp_ntz, metrics string")
    got = {r.run_id: r for r in RN.fold_runs(df).collect()}
    assert got["x"].duration_seconds == 0 and got["x"].status == "success"
    assert got["y"].duration_seconds == 90 and json.loads(got["y"].metrics)["error"] == "boom"


def test_evaluation_keys_and_confusion(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y_true int, y_pred int")
    r = EV.evaluate(df).first().asDict()
    assert r["accuracy"] == 0.5 and "f1_macro" in r and (r["cm_tn"], r["cm_fn"]) == (1, 1)


def test_window_choice_and_status(spark):
    as_of = datetime(2024, 1, 31)
    assert window_start(as_of, days=3, hours=5) == as_of - timedelta(hours=5)
    assert window_start(as_of, days=0) == as_of - timedelta(days=7)
    assert window_start(as_of, hours=0) == as_of
    df = spark.createDataFrame([(0.05,), (0.20,), (0.40,)], "s double")
    got = [r[0] for r in df.select(M.status_of(F.col("s"), 0.15)).collect()]
    assert got == ["healthy", "warning", "critical"]


def test_scoring_argmax(spark):
    import math
    df = spark.createDataFrame([([math.log(0.12), math.log(0.88)],)], "scores array<double>")
    i, p = softmax_argmax("scores")
    r = df.select(i.alias("i"), F.round(p, 4).alias("p")).first()
    assert (r.i, r.p) == (1, 0.88)


def test_leaderboard_order(spark):
    df = spark.createDataFrame([("a", 0.49), ("b", 0.85)], "run_id string, f1 double")
    assert [r.run_id for r in RG.leaderboard(df).collect()] == ["b", "a"]


def test_drift_needs_both_sides(spark):
    df = spark.createDataFrame([("positive", 10)], "predicted_sentiment string, input_length int")
    for ref, cur, side in ((df.limit(0), df, "Reference"), (df, df.limit(0), "Current")):
        with pytest.raises(ValueError, match=f"{side} dataset is empty"):
            D.detect_drift(ref, cur)
    aligned = spark.createDataFrame([(datetime(2024, 1, 9).date(), "f", "a", 0, 5)],
                                    "report_date date, feature string, category string, ref_n bigint, cur_n bigint")
    dist = D._distances(aligned, 0.1, ["report_date", "feature"])
    with pytest.raises(Exception, match="Reference dataset is empty"):
        D.reports_from_distances(dist).collect()


def test_ks_ranges_carry_over(spark):
    rnd = random.Random(4)
    days = [datetime(2024, 1, d).date() for d in range(1, 15)]
    rows = [(rnd.choice(days), rnd.randint(-50, 400)) for _ in range(3000)]
    cfg = DEFAULT.with_(as_of=datetime(2024, 1, 12))
    df = spark.createDataFrame(rows, "day date, value int")
    one = {r.report_date: r.ks_statistic for r in D.ks_backfill(df, "value", cfg=cfg, partitions=1).collect()}
    for n in (3, 20):
        got = {r.report_date: r.ks_statistic for r in D.ks_backfill(df, "value", cfg=cfg, partitions=n).collect()}
        assert got.keys() == one.keys() and all(abs(got[d] - one[d]) < 1e-12 for d in one)
    for day, stat in one.items():
        ref = sorted(v for d, v in rows if d < cfg.reference_end)
        cur = sorted(v for d, v in rows if 0 < (day - d).days <= cfg.drift_window_days)
        gap = max(abs(sum(r <= x for r in ref) / len(ref) - sum(c <= x for c in cur) / len(cur)) for x in {*ref, *cur})
        assert abs(gap - stat) < 1e-12


@pytest.mark.parametrize("partitions", [1, 12])
def test_ks_of_continuous_values_with_nulls_and_a_hot_value(spark, partitions, monkeypatch):
    rnd = random.Random(9)
    days = [datetime(2024, 1, d).date() for d in range(1, 20)]
    rows = [(rnd.choice(days), rnd.choice([None, 0.25, 0.25, rnd.gauss(0, 1), rnd.gauss(1, 3) * 10 ** rnd.randint(-9, 9)])) for _ in range(2500)]
    cfg = DEFAULT.with_(as_of=datetime(2024, 1, 16))
    df = spark.createDataFrame(rows, "day date, value double")
    got = {r.report_date: (r.ks_statistic, r.reference_size, r.current_size) for r in D.ks_backfill(df, "value", cfg=cfg, partitions=partitions).collect()}
    place = lambda v: -1e300 if v is None else v
    assert len(got) == 9
    for day, (stat, n, m) in got.items():
        ref = np.sort([place(v) for d, v in rows if d < cfg.reference_end])
        cur = np.sort([place(v) for d, v in rows if 0 < (day - d).days <= cfg.drift_window_days])
        x = np.concatenate([ref, cur])
        gap = np.abs(np.searchsorted(ref, x, "right") / len(ref) - np.searchsorted(cur, x, "right") / len(cur)).max()
        assert (n, m) == (len(ref), len(cur)) and abs(gap - stat) < 1e-12
    with pytest.raises(ValueError, match="Reference dataset is empty"):
        D.ks_backfill(df.where("day > '2024-01-10'"), "value", cfg=cfg)
