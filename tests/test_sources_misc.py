"""Sources and sinks (S2-S5), constraints (V9), JSON helpers (J2-J4),
prefix lookup (F13), UTC stamp (D2) and streaming scoring (X6)."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.functions import jsonx as J
from tessera.operators import registry as RG
from tessera.schemas import PREDICTIONS, split_valid
from tessera.sources import ingest as IG
from tessera.sources import publish as PB


def test_normalize_columns(spark):
    df = spark.createDataFrame([("a", 1, "x")], "sentence string, sentiment int, extra string")
    assert IG.normalize_columns(df).columns == ["text", "label"]
    df2 = spark.createDataFrame([("a", "b", 1)], "text string, sentence string, label int")
    assert IG.normalize_columns(df2).first().text == "a"


def test_versioned_write_latest_and_splits(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 0)], "text string, label int")
    IG.write_versioned(df.limit(1), str(tmp_path), "raw", "20240101T000000Z")
    IG.write_versioned(df, str(tmp_path), "raw", "20240102T000000Z")
    assert IG.read_latest(spark, str(tmp_path), "raw").count() == 2
    s = df.withColumn("split", F.when(F.col("label") == 1, "train").otherwise("test"))
    IG.write_splits(s, str(tmp_path / "splits"))
    with pytest.raises(IG.MissingSplitsError, match="val"):
        IG.load_splits(spark, str(tmp_path / "splits"))


def test_utc_stamp():
    assert IG.utc_version(datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)) == "20240102T030405Z"


def test_constraints_quarantine(spark):
    rows = [("a", "drift_warning", "warning", "m"), ("b", "bogus", "warning", "m"),
            ("c", "drift_critical", "loud", None)]
    df = spark.createDataFrame(rows, "id string, alert_type string, severity string, message string")
    ok, bad = split_valid(df, "alerts")
    assert [r.id for r in ok.collect()] == ["a"]
    reasons = {r.id: set(r.violations) for r in bad.collect()}
    assert reasons == {"b": {"alert_type:check"}, "c": {"severity:check", "message:not_null"}}


def test_numeric_metric_filter(spark):
    df = spark.createDataFrame([(1, json.dumps({"f1": 0.8, "n": 3, "ok": True, "s": "x", "d": {"a": 1}}))],
                               "id int, m string")
    got = {r.key: r.value for r in J.numeric_metrics(df, "m", ["id"]).collect()}
    assert got == {"f1": 0.8, "n": 3.0}


def test_drift_summary_last_entry_wins(spark):
    doc = {"metrics": [
        {"metric": "DatasetDriftMetric", "result": {"number_of_drifted_columns": 1, "number_of_columns": 4,
                                                    "share_of_drifted_columns": 0.25}},
        {"metric": "ColumnDriftMetric", "result": {"column_name": "label", "drift_detected": True}},
        {"metric": "DataDriftTable", "result": {"number_of_drifted_columns": 2, "number_of_columns": 4,
                                                "share_of_drifted_columns": 0.5}}]}
    df = spark.createDataFrame([(json.dumps(doc),)], "r string")
    s = df.select(J.drift_summary("r").alias("s")).first().s
    assert (s.drift_score, s.features_drifted, s.prediction_drift_detected) == (0.5, 2, True)


def test_drift_summary_keeps_the_last_share(spark):
    def entry(metric, k, share=None):
        result = {"number_of_drifted_columns": k, "number_of_columns": 4}
        return {"metric": metric, "result": result if share is None else {**result, "share_of_drifted_columns": share}}
    docs = [{"metrics": [entry("DatasetDriftMetric", 1, 0.25), entry("DataDriftTable", 2)]},
            {"metrics": [entry("DatasetDriftMetric", 3)]}, {"metrics": []}, {}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, r string")
    got = [(r.s.dataset_drift_detected, r.s.drift_score, r.s.features_drifted)
           for r in df.orderBy("i").select(J.drift_summary("r").alias("s")).collect()]
    assert got == [(True, 0.25, 2), (False, 0.0, 3), (False, 0.0, 0), (False, 0.0, 0)]


def test_json_rejects_are_kept_with_their_reason(spark):
    texts = ['{"a": 1', '{"a": NaN}', "[1, 2]", "3", '{"a": 1}', "{}", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, m string")
    got = {r.i: r.reason for r in J.json_rejects(df, "m", ["i"]).collect()}
    assert got == {0: "not JSON", 1: "not JSON", 2: "not an object", 3: "not an object", 7: "not JSON"}
    assert [r.i for r in J.numeric_metrics(df, "m", ["i"]).collect()] == [4]


def test_first_with_prefix(spark):
    df = spark.createDataFrame([("g", 0, "distilbert-x", 0.4), ("g", 1, "baseline-lr", 0.8),
                                ("g", 2, "baseline-nb", 0.9)],
                               "experiment string, position int, model_type string, f1 double")
    assert RG.first_with_prefix(df, "baseline").first()[1] == 0.8


CFG = DEFAULT.with_(ngram_max=1, tfidf_max_features=50)
POS = ["lamp shines gladly", "garden gladly blooms", "shines lamp blooms", "gladly blooms brook"]
NEG = ["rust grumbles swamp", "drizzle rust grumbles", "swamp drizzle rust", "grumbles drizzle rust"]


def labelled(spark, flip=0):
    rows = [(i, t, 1 - flip) for i, t in enumerate(POS * 5)] + [(100 + i, t, flip) for i, t in enumerate(NEG * 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def table(spark, path):
    return sorted(map(str, spark.read.parquet(str(path)).collect()))


def published(spark, root, name):
    return sorted(map(str, PB.read(spark, root, name).collect()))


def test_streaming_scoring_rows_fit_the_log(spark, tmp_path):
    from tessera.operators import model as MD
    from tessera.streaming import stream as ST
    splits = labelled(spark).withColumn("split", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))
    cand = MD.train_and_evaluate(splits, CFG)[0]
    src = tmp_path / "texts"
    spark.createDataFrame([(1, "garden shines"), (2, "swamp rust"), (3, ""), (4, "x" * 6000), (5, None)], "conv_id long, text string") \
        .coalesce(1).write.parquet(str(src))

    def stream():
        return spark.readStream.schema("conv_id long, text string").parquet(str(src))
    out = ST.run_available(ST.scored_stream(cand.model, stream(), "text", ["conv_id"], "1", CFG), "scoring_test", str(src))
    assert {r.conv_id: r.predicted_sentiment for r in out.collect()} == {1: "positive", 2: "negative"}
    good, bad = split_valid(out, "predictions")
    assert good.count() == 2 and bad.count() == 0
    assert {f.name for f in PREDICTIONS.fields} <= set(out.columns)
    rejected = ST.run_available(ST.rejected_stream(stream(), "text", ["conv_id"], CFG), "rejected_test", str(src))
    assert {r.conv_id: r.reason for r in rejected.collect()} == {3: "empty text", 4: "text too long", 5: "null text"}


def test_jobs_run_twice_leave_equal_tables(spark, tmp_path):
    from tessera.plans.jobs import scoring_job, training_job
    texts = spark.createDataFrame([(1, "lamp blooms"), (2, "rust drizzle"), (3, "")], "conv_id long, text string")
    root, seen = str(tmp_path), []
    for _ in range(2):
        out = training_job(spark, labelled(spark), root, CFG, run_key="day1")
        scored = scoring_job(spark, texts, "text", ["conv_id"], root, out["ledger"], "batch1", CFG)
        assert {r.conv_id: r.predicted_sentiment for r in scored["predictions"].collect()} == {1: "positive", 2: "negative"}
        seen.append([published(spark, root, t) for t in (
            "model_versions", "pipeline_runs", "predictions", "predictions_quarantine")])
        seen[-1].append(table(spark, out["splits_path"]))
    assert seen[0] == seen[1]
    assert [len(t) for t in seen[0][:4]] == [1, 2, 2, 1]
    led = out["ledger"].first()
    assert led.promoted and led.stage == "Production" and len(out["candidates"]) == 2
    runs = {r.dag_id: json.loads(r.metrics) for r in PB.read(spark, root, "pipeline_runs").collect()}
    assert runs["training"]["winner"].startswith("baseline") and runs["training"]["promoted"] and runs["scoring"]["scored"] == 2
    assert "converged" in out["candidates"][0].metrics


def test_a_losing_retrain_leaves_production_as_it_is(spark, tmp_path):
    from tessera.operators import model as MD
    from tessera.plans.jobs import training_job
    root = str(tmp_path)
    q = spark.createDataFrame([("lamp blooms",)], "text string")
    first = training_job(spark, labelled(spark), root, CFG, run_key="day1")
    second = training_job(spark, labelled(spark, flip=1), root, CFG, run_key="day2")  # equal F1: not better
    stages = {r.version: (r.stage, r.run_id) for r in second["ledger"].collect()}
    assert stages[1][0] == "Production" and stages[2][0] == "Staging" and stages[1][1] != stages[2][1]
    version, model = MD.load_production(second["ledger"], f"{root}/models", CFG.registry_name)
    assert version == "1" and MD.predict(model, q).first().pred_class == 1
    assert MD.predict(second["winner"].model, q).first().pred_class == 0
    assert first["winner"].run_id == stages[1][1]


def test_failed_jobs_leave_a_row(spark, tmp_path):
    from tessera.operators.validate import DataValidationError
    from tessera.plans.jobs import training_job
    with pytest.raises(DataValidationError):
        training_job(spark, labelled(spark).withColumn("text", F.lit(" ")), str(tmp_path), CFG, run_key="bad")
    row = PB.read(spark, str(tmp_path), "pipeline_runs").first()
    assert (row.status, json.loads(row.metrics)) == ("failed", {"error": "DataValidationError"})


def test_daily_monitoring_job_twice(spark, tmp_path):
    from tessera.plans.jobs import daily_monitoring_job
    seen = []
    for _ in range(2):
        out = daily_monitoring_job(spark, "/root/testdata/sf0.001", str(tmp_path))
        seen.append([published(spark, str(tmp_path), t) for t in ("drift_reports", "alerts", "pipeline_runs")])
    assert seen[0] == seen[1] and len(seen[0][0]) == 24 and len(seen[0][1]) >= 1
    assert out["reports"].select("report_date").distinct().count() == 24
    assert out["payloads"].count() == 24 and all("distance" in str(json.loads(r.report)) for r in out["payloads"].collect())


def test_flattened_props_oracle_on_mixed_json(spark, tmp_path):
    """J4 in Spark equals the registered DuckDB oracle on every JSON kind."""
    import duckdb

    from tessera.plans.catalog import ORACLE
    props = ['{"k": 3, "s": "a b", "t": true}', '{"f": 1.5, "n": null}',
             '{"l": [1, 2], "o": {"x": "y"}}', None, '{}']
    src = str(tmp_path / "events.parquet")
    spark.createDataFrame([(i, p) for i, p in enumerate(props)],
                          "event_id bigint, props string").coalesce(1).write.parquet(src)
    got = sorted((r.event_id, r.key, r.value, r.is_scalar)
                 for r in J.flatten_params(spark.read.parquet(src), "props", ["event_id"]).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{src}')")
    want = sorted((int(a), b, c, bool(d)) for a, b, c, d in
                  con.execute(ORACLE["flattened_props"]).fetchall())
    assert got == want
    assert (2, "o", '{"x":"y"}', False) in got and (1, "n", "null", False) in got


def test_json_safe_nested_values(spark):
    import datetime as dt
    from decimal import Decimal
    schema = ("v struct<i:int, f:double, g:array<double>, t:timestamp_ntz, d:date, b:binary, n:decimal(10,3), s:string, "
              "m:map<int, struct<x:date>>, z:struct<q:int>, deep:array<struct<a:array<timestamp_ntz>>>>")
    row = (1, 0.5, [1.0, float("nan"), float("inf"), None], dt.datetime(2024, 1, 2, 3), dt.date(2024, 1, 2), b"\x01\xff", Decimal("1.250"), "é\"",
           {7: (dt.date(2024, 5, 6),)}, None, [([dt.datetime(2024, 1, 1)],), (None,)])
    df = spark.createDataFrame([(row,), (None,)], schema)
    one, two = (r.j for r in df.select(J.to_json_text(df, "v").alias("j")).collect())
    got = json.loads(one)  # JSON that any reader takes
    assert got == {"i": 1, "f": 0.5, "g": [1.0, "NaN", "Infinity", None], "t": "2024-01-02 03:00:00", "d": "2024-01-02", "b": "01FF", "n": 1.25,
                   "s": "é\"", "m": {"7": {"x": "2024-05-06"}}, "z": None, "deep": [{"a": ["2024-01-01 00:00:00"]}, {"a": None}]}
    assert two is None


def test_logistic_regression_is_the_optimum(spark):
    """K2: the gradient of the penalised mean loss vanishes at the fitted coefficients."""
    import numpy as np
    from tessera.operators import model as MD
    cfg = CFG.with_(logreg_C=0.5)
    rows = labelled(spark).unionByName(spark.createDataFrame([(900 + i, t, y) for i, (t, y) in enumerate(
        [("lamp rust", 1), ("rust garden", 0), ("gladly swamp brook", 1), ("drizzle", 1)])], "doc_id long, text string, label int"))
    model, _ = MD.fit_candidates(rows, cfg, only=("baseline_tfidf_logreg",))["baseline_tfidf_logreg"]
    from tessera.operators.features import with_grams
    got = model.transform(with_grams(rows, "text", "grams", 1)).select("features", "label").collect()
    x, y = np.array([r.features.toArray() for r in got]), np.array([r.label for r in got])
    w, b = model.stages[-1].coefficients.toArray(), model.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = np.append(x.T @ (p - y) / len(y) + w / (cfg.logreg_C * len(y)), (p - y).mean())
    assert np.abs(gradient).max() < 1e-4 and np.abs(w).max() > 0.1
