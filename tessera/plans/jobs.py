"""End-to-end jobs (the lifecycle of SURVEY section 3) composed from the operators.

``training_job``: validate -> clean (written once) -> validate again -> split ->
write the split table -> fit both candidates -> pick the winner (A15) -> record
the version and recompute stages (W4).

``scoring_job``: score a batch with the Production model into the prediction log,
with inadmissible texts in quarantine.

``daily_monitoring_job``: drift reports for the report dates -> alerts.

Every job has a ``run_key``. All tables of a run, its ``pipeline_runs`` row among them, are
published by one entry written last (``sources.publish``): readers see all of a run or
nothing, and a rerun replaces everything that the run published before, also where it
has no rows any more. A failed run publishes its row alone. Times are the job's logical date
(``cfg.as_of``), not the clock.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.jsonx import to_json_text
from ..functions.text import clean_text
from ..operators import alerts as AL
from ..operators import drift as D
from ..operators import model as MD
from ..operators import registry as RG
from ..operators import sample as S
from ..operators import validate as VA
from ..session import cut_lineage, scratch_path
from ..sources import ingest as IG
from ..sources import publish as PB
from ..sources import views as V
from ..sources.tables import Tables


RUN_ROW = ("id string, dag_id string, run_id string, status string, started_at timestamp_ntz, "
           "completed_at timestamp_ntz, duration_seconds int, metrics string")
VERSION_ROW = ("name string, run_id string, registered_at timestamp_ntz, has_metrics boolean, f1_macro double, "
               "accuracy double, version bigint, run_key string")


def _run_row(spark: SparkSession, dag_id: str, run_key: str, status: str, metrics: dict, cfg: Config) -> PB.Table:
    """The job's row of the run log."""
    row = [(hashlib.sha256(f"{dag_id}:{run_key}".encode()).hexdigest(), dag_id, run_key, status, cfg.as_of, cfg.as_of, 0,
            json.dumps(metrics, sort_keys=True))]
    return PB.Table(spark.createDataFrame(row, RUN_ROW))


@contextmanager
def recorded(spark: SparkSession, root: str, dag_id: str, run_key: str, cfg: Config):
    """Runs a job's body, which fills metrics and tables, and publishes its tables
    together with its run row."""
    metrics: dict = {}
    tables: dict[str, PB.Table] = {}
    run = f"{dag_id}:{run_key}"
    try:
        yield metrics, tables
    except Exception as e:
        failed = _run_row(spark, dag_id, run_key, "failed", {**metrics, "error": type(e).__name__}, cfg)
        PB.publish(spark, root, run, {"pipeline_runs": failed})
        raise
    PB.publish(spark, root, run, {**tables, "pipeline_runs": _run_row(spark, dag_id, run_key, "success", metrics, cfg)})


def training_job(spark: SparkSession, labelled: DataFrame, out_root: str | None = None,
                 cfg: Config = DEFAULT, run_key: str = "manual") -> dict:
    """K3/K8 pipeline: returns metrics of both candidates, the winner and the
    registry ledger of ``out_root`` with the new version."""
    out_root = out_root or scratch_path(spark, f"training-{uuid.uuid4().hex}")
    with recorded(spark, out_root, "training", run_key, cfg) as (metrics, tables):
        raw = IG.normalize_columns(labelled, keep=("doc_id",))
        VA.validate(raw)
        # read by the second gate and the split
        cleaned = cut_lineage(raw.withColumn("text", clean_text("text")), "cleaned")
        VA.validate(cleaned)  # a row cleaning to empty text fails here
        split_path = f"{out_root}/splits/run_key={run_key}/attempt={uuid.uuid4().hex}"
        IG.write_splits(S.stratified_split(cleaned, "doc_id", "label", cfg), split_path)
        cands = MD.train_and_evaluate(IG.load_splits(spark, split_path), cfg, run_key)
        best = max(enumerate(cands), key=lambda ic: (ic[1].metrics["f1_macro"], -ic[0]))[1]
        model_path = MD.save_model(best.model, f"{out_root}/models", best.run_id)
        before = PB.read(spark, out_root, "model_versions", VERSION_ROW)
        others = before.where(F.col("run_key") != run_key)
        # a rerun keeps its version
        version = before.agg(F.coalesce(F.max(F.when(F.col("run_key") == run_key, F.col("version"))),
                                        F.coalesce(F.max("version"), F.lit(0)) + 1)).first()[0]
        new = spark.createDataFrame(
            [(cfg.registry_name, best.run_id, cfg.as_of, True, float(best.metrics["f1_macro"]),
              float(best.metrics["accuracy"]), version, run_key)], before.schema)
        tables["model_versions"] = PB.Table(new)
        ledger = cut_lineage(RG.promotion_ledger(others.unionByName(new).drop("run_key")), "ledger")
        mine = ledger.where(F.col("version") == version).first()
        f1 = {c.model_type: float(c.metrics["f1_macro"]) for c in cands}
        metrics.update(winner=best.model_type, promoted=bool(mine["promoted"]), version=int(version), **{
            f"{prefix}_f1": next((v for k, v in f1.items() if k.startswith(prefix)), None)
            for prefix in ("baseline", "naive")})
    return {"candidates": cands, "winner": best, "model_path": model_path, "ledger": ledger, "splits_path": split_path}


def scoring_job(spark: SparkSession, texts: DataFrame, text_col: str, key_cols: list[str], out_root: str,
                ledger: DataFrame, batch_id: str, cfg: Config = DEFAULT) -> dict:
    """Score ``texts`` with the Production model of ``out_root``; rows go to
    ``predictions`` and inadmissible texts to ``predictions_quarantine``, by batch."""
    with recorded(spark, out_root, "scoring", batch_id, cfg) as (metrics, tables):
        version, model = MD.load_production(ledger, f"{out_root}/models", cfg.registry_name)
        flagged = VA.admissibility(texts, text_col, cfg.max_text_length)
        scored = MD.predict(model, flagged.where("admissible"), text_col)
        # written once: counted for the run row and published
        rows = cut_lineage(MD.log_rows(scored, text_col, key_cols, version, cfg.registry_name, cfg.as_of, batch_id), "scored")
        rejects = flagged.where("not admissible").select(
            *key_cols, F.col("n_chars").alias("input_length"), F.lit(batch_id).alias("batch_id"))
        tables.update(predictions=PB.Table(rows), predictions_quarantine=PB.Table(rejects))
        metrics.update(model_version=version, scored=rows.count())
    written = PB.read(spark, out_root, "predictions").where(F.col("batch_id") == batch_id)
    return {"predictions": written, "version": version}


def daily_monitoring_job(spark: SparkSession, sf_dir: str, log_root: str | None = None,
                         cfg: Config = DEFAULT, run_key: str = "backfill") -> dict:
    """Drift reports, alerts and JSON payloads for every report date,
    published by date under ``log_root``."""
    log_root = log_root or scratch_path(spark, f"logs-{uuid.uuid4().hex}")
    with recorded(spark, log_root, "drift_detection", run_key, cfg) as (metrics, tables):
        profile = V.profile(Tables(spark, sf_dir), cfg)
        D.require_rows(profile.where(F.col("day") < F.lit(cfg.reference_end)),
                       profile.where(F.col("day") >= F.lit(cfg.reference_end)))
        reports = cut_lineage(D.drift_reports(profile, list(V.PROFILE_FEATURES), cfg), "reports")
        alerts = cut_lineage(AL.alerts_from_reports(reports, cfg), "alerts")
        whole = reports.withColumn("row", F.struct(*[c for c in reports.columns if c != "details"]))
        payloads = whole.select("report_date", F.col("details").alias("report"), to_json_text(whole, "row").alias("summary"))
        tables.update(drift_reports=PB.Table(reports, "report_date"), alerts=PB.Table(alerts, "report_date"),
                      drift_payloads=PB.Table(payloads, "report_date"))
        metrics.update(reports=reports.count(), alerts=alerts.count())
    return {t: PB.read(spark, log_root, n) for t, n in (("reports", "drift_reports"), ("alerts", "alerts"), ("payloads", "drift_payloads"))}
