"""Atomic publication of a run's tables (S8-S10) and the model store (K3, K6)."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tessera.config import DEFAULT
from tessera.operators import model as MD
from tessera.plans import jobs
from tessera.sources import publish as PB

DAY8, DAY9, DAY10 = date(2024, 1, 8), date(2024, 1, 9), date(2024, 1, 10)


def alerts(spark, *rows):
    return PB.Table(spark.createDataFrame(list(rows), "report_date date, message string"), "report_date")


def reports(spark, *rows):
    return PB.Table(spark.createDataFrame(list(rows), "report_date date, score double"), "report_date")


def seen(spark, root):
    return {t: sorted(tuple(r) for r in PB.read(spark, root, t, "x int").collect()) for t in ("alerts", "drift_reports")}


def test_rerun_on_corrected_data_leaves_the_new_rows_only(spark, tmp_path):
    root = str(tmp_path)
    PB.publish(spark, root, "january", {"alerts": alerts(spark, (DAY8, "a"), (DAY9, "b")), "drift_reports": reports(spark, (DAY8, 0.9), (DAY9, 0.8))})
    PB.publish(spark, root, "later", {"alerts": alerts(spark, (DAY10, "c"))})
    PB.publish(spark, root, "january", {"alerts": alerts(spark, (DAY9, "b2")), "drift_reports": reports(spark, (DAY8, 0.1), (DAY9, 0.8))})
    assert seen(spark, root) == {"alerts": [(DAY9, "b2"), (DAY10, "c")], "drift_reports": [(DAY8, 0.1), (DAY9, 0.8)]}
    PB.publish(spark, root, "january", {"alerts": alerts(spark), "drift_reports": reports(spark, (DAY8, 0.1))})
    assert seen(spark, root) == {"alerts": [(DAY10, "c")], "drift_reports": [(DAY8, 0.1)]}
    # a day that another run publishes is that run's
    PB.publish(spark, root, "backfill", {"alerts": alerts(spark, (DAY10, "d"))})
    assert seen(spark, root)["alerts"] == [(DAY10, "d")]
    assert PB.read(spark, root, "alerts").where(F.col("report_date") == DAY10).columns == ["report_date", "message"]


def test_a_run_stopped_between_two_tables_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    PB.publish(spark, root, "r", {"alerts": alerts(spark, (DAY8, "old")), "drift_reports": reports(spark, (DAY8, 0.5))})
    before = seen(spark, root)
    broken = PB.Table(reports(spark, (DAY8, 0.7)).rows.withColumn("score", F.raise_error(F.lit("disk full")).cast("double")), "report_date")
    with pytest.raises(Exception, match="disk full"):
        PB.publish(spark, root, "r", {"alerts": alerts(spark, (DAY8, "new")), "drift_reports": broken})
    assert seen(spark, root) == before

    def stopped(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # all tables written, the entry not
        m.setattr(PB, "put_new", stopped)
        with pytest.raises(KeyboardInterrupt):
            PB.publish(spark, root, "r", {"alerts": alerts(spark, (DAY8, "new")), "drift_reports": reports(spark, (DAY8, 0.7))})
    assert seen(spark, root) == before
    assert len(PB.vacuum(spark, root, older_than_hours=0)) >= 3 and seen(spark, root) == before
    PB.publish(spark, root, "r", {"alerts": alerts(spark, (DAY8, "new")), "drift_reports": reports(spark, (DAY8, 0.7))})
    assert seen(spark, root) == {"alerts": [(DAY8, "new")], "drift_reports": [(DAY8, 0.7)]}


def test_runs_that_publish_at_once_all_count(spark, tmp_path):
    root = str(tmp_path)

    def one(i):
        return PB.publish(spark, root, f"run{i}", {"runs": PB.Table(spark.createDataFrame([(i,)], "i int"))})

    with ThreadPoolExecutor(6) as pool:
        numbers = sorted(pool.map(one, range(6)))
    assert numbers == list(range(6)) and sorted(r.i for r in PB.read(spark, root, "runs").collect()) == list(range(6))
    assert not PB.put_new(spark, f"{root}/{PB.ENTRIES}/0000000003.json", "{}")
    assert len(PB.entries(spark, root)) == 6


def test_columns_may_be_added_and_names_escaped(spark, tmp_path):
    root = str(tmp_path)
    PB.publish(spark, root, "a", {"t": PB.Table(spark.createDataFrame([(1, "x/y=z %")], "n int, who string"), "who")})
    PB.publish(spark, root, "b", {"t": PB.Table(spark.createDataFrame([(2, "w", 0.5), (3, None, 1.0)], "n int, who string, f double"), "who")})
    assert sorted((r.n, r.who, r.f) for r in PB.read(spark, root, "t").collect()) == [(1, "x/y=z %", None), (2, "w", 0.5), (3, None, 1.0)]
    with pytest.raises(LookupError):
        PB.read(spark, root, "other")
    assert PB.read(spark, root, "other", "n int").count() == 0


def test_scoring_rerun_without_rejects_empties_the_quarantine(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    monkeypatch.setattr(MD, "load_production", lambda *a: ("1", None))
    monkeypatch.setattr(MD, "predict", lambda model, df, col: df.selectExpr("*", "'positive' predicted_sentiment", "0.9 confidence"))
    texts = spark.createDataFrame([(1, "good"), (2, ""), (3, None)], "conv_id long, text string")
    ledger = spark.createDataFrame([], "name string")
    for rows, rejects in ((texts, 2), (texts.where("conv_id = 1"), 0)):
        out = jobs.scoring_job(spark, rows, "text", ["conv_id"], root, ledger, "b1")
        assert out["predictions"].count() == 1 and PB.read(spark, root, "predictions_quarantine").count() == rejects


def test_a_failed_rerun_keeps_what_was_published(spark, tmp_path):
    root = str(tmp_path)
    for fail in (False, True):
        try:
            with jobs.recorded(spark, root, "drift", "r1", DEFAULT) as (metrics, tables):
                tables["alerts"] = alerts(spark, (DAY8, "x"))
                if fail:
                    raise ValueError
        except ValueError:
            pass
    assert PB.read(spark, root, "alerts").count() == 1
    assert [r.status for r in PB.read(spark, root, "pipeline_runs").collect()] == ["failed"]


def test_a_save_stopped_half_way_is_repaired(spark, tmp_path, monkeypatch):
    from pyspark.ml.feature import Normalizer
    root, model = str(tmp_path / "models"), PipelineModel(stages=[Normalizer(inputCol="a", outputCol="b")])
    with pytest.raises(LookupError):
        MD.load_model(spark, root, "run1")

    def stopped(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # all of the model is there, the marker not
        m.setattr(MD, "put_new", stopped)
        with pytest.raises(KeyboardInterrupt):
            MD.save_model(model, root, "run1")
    (tmp_path / "models" / "run1-half" / "metadata").mkdir(parents=True)
    with pytest.raises(LookupError):
        MD.load_model(spark, root, "run1")
    path = MD.save_model(model, root, "run1")
    assert len(MD.load_model(spark, root, "run1").stages) == 1
    assert MD.save_model(model, root, "run1") == path  # a complete model stays
