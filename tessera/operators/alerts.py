"""Alert rule, resolution ledger and banner.

Alerts are an append-only table derived from drift reports; resolutions are
a second append-only table. "Resolve" is a left join to the latest
resolution per alert id instead of an in-place UPDATE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.common import det_id
from ..functions.text import format_score

# Fixed alert messages (must equal the reference's).
MSG_CRITICAL = "Critical drift detected: score="
MSG_WARNING = "Drift warning: score="
MSG_DEGRADATION = "Prediction distribution shift detected."


def alerts_from_reports(reports: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """At most one alert per drift report.

    ``> 2t`` drift_critical (critical); ``> t`` drift_warning (warning);
    otherwise a prediction drift gives model_degradation (warning); else none.
    """
    s = F.col("drift_score")
    t = cfg.drift_threshold
    kind = (F.when(s > F.lit(2 * t), "drift_critical").when(s > F.lit(t), "drift_warning")
            .when(F.col("prediction_drift_detected"), "model_degradation"))
    sev = F.when(kind == "drift_critical", "critical").when(kind.isNotNull(), "warning")
    msg = (F.when(kind == "drift_critical", F.concat(F.lit(MSG_CRITICAL), format_score(s)))
           .when(kind == "drift_warning", F.concat(F.lit(MSG_WARNING), format_score(s)))
           .when(kind == "model_degradation", F.lit(MSG_DEGRADATION)))
    meta = F.to_json(F.struct(s.cast("double").alias("drift_score"), "features_drifted",
                              "total_features", "report_path"))
    a = reports.select(
        det_id(F.lit("alert"), F.col("id")).alias("id"),
        F.col("id").alias("report_id"),
        F.col("report_date"),
        kind.alias("alert_type"), sev.alias("severity"), msg.alias("message"),
        meta.alias("metadata"), F.col("created_at"))
    return a.where(F.col("alert_type").isNotNull())


def resolutions_before(alerts: DataFrame, before, cfg: Config = DEFAULT) -> DataFrame:
    """Fixture resolutions: alerts of reports before ``before`` are resolved a
    day after they were raised (FIXTURES.md)."""
    from ..functions.common import date_lit
    return (alerts.where(F.col("report_date") < date_lit(before))
            .select(F.col("id").alias("alert_id"),
                    (F.col("created_at") + F.expr("INTERVAL 1 DAY")).alias("resolved_at")))


def apply_resolutions(alerts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Alerts left join the latest resolution per id."""
    latest = resolutions.groupBy("alert_id").agg(F.max("resolved_at").alias("resolved_at"))
    j = alerts.join(latest, alerts["id"] == latest["alert_id"], "left").drop("alert_id")
    return j.withColumn("is_resolved", F.col("resolved_at").isNotNull())


def active_alerts(alerts: DataFrame) -> DataFrame:
    """Unresolved alerts, newest first."""
    return (alerts.where(~F.col("is_resolved"))
            .select("id", "alert_type", "severity", "message", "metadata", "created_at")
            .orderBy(F.col("created_at").desc(), F.col("id").desc()))


def lead_alert(alerts: DataFrame) -> DataFrame:
    """Banner lead (first critical among active, else the newest active)
    and the count of the others; no row when nothing is active."""
    act = alerts.where(~F.col("is_resolved"))
    order = F.struct((F.col("severity") == "critical").alias("c"), F.col("created_at"),
                     F.col("id"))
    row = F.max_by(F.struct("id", "alert_type", "severity", "message"), order)
    return (act.agg(row.alias("lead"), F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 0)
            .select("lead.id", "lead.alert_type", "lead.severity", "lead.message",
                    (F.col("n") - 1).alias("more_count")))


def latency_spike_alerts(predictions: DataFrame, factor: float = 2.0) -> DataFrame:
    """R6 (declared type, never produced by the reference): a day whose p95
    latency exceeds ``factor`` x the median of the previous 7 days' p95."""
    from pyspark.sql import Window
    d = (predictions.groupBy(F.to_date("created_at").alias("day"))
         .agg(F.percentile("latency_ms", 0.95).alias("p95")))
    # One row per day: a 7-row frame, its median from the sorted values.
    w = Window.orderBy("day").rowsBetween(-7, -1)
    d = d.withColumn("_prev", F.array_sort(F.collect_list("p95").over(w)))
    n = F.size("_prev")
    mid = F.element_at("_prev", F.floor((n - 1) / 2).cast("int") + 1)
    mid2 = F.element_at("_prev", F.floor(n / 2).cast("int") + 1)
    d = d.withColumn("base", F.when(n > 0, (mid + mid2) / 2))
    return (d.where(F.col("p95") > F.lit(factor) * F.col("base"))
            .select(det_id(F.lit("latency"), F.col("day")).alias("id"),
                    F.lit("latency_spike").alias("alert_type"), F.lit("warning").alias("severity"),
                    F.concat(F.lit("Latency p95 spike: "), format_score(F.col("p95"), 1)).alias("message"),
                    F.col("day").cast("timestamp_ntz").alias("created_at")))


def pipeline_failure_alerts(run_history: DataFrame) -> DataFrame:
    """One alert per failed run row."""
    return (run_history.where(F.col("status") == "failed")
            .select(det_id(F.lit("runfail"), F.col("id")).alias("id"),
                    F.lit("pipeline_failure").alias("alert_type"), F.lit("warning").alias("severity"),
                    F.concat(F.lit("Pipeline failed: "), F.col("dag_id"), F.lit("/"), F.col("run_id"))
                     .alias("message"),
                    F.coalesce("completed_at", "started_at").alias("created_at")))
