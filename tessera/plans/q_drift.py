"""Drift, alert and status queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import date_lit
from ..operators import alerts as AL
from ..operators import drift as D
from ..operators import metrics as M
from ..session import cut_lineage
from ..sources import views as V
from .catalog import register
from .oracle_views import AS_OF, V_PREDICTIONS, V_PROFILE, with_views
from .q_ledgers import _LEDGER_SQL

CFG = DEFAULT
FEATURES = list(V.PROFILE_FEATURES)
REF_END = CFG.reference_end.isoformat()
LAST = CFG.as_of.date().isoformat()
THR = CFG.drift_threshold


def drift_reports_df(t):
    """One row per report date, materialised once: several branches (alerts,
    resolutions, status, volume join) read it."""
    return cut_lineage(D.drift_reports(V.profile(t, CFG), FEATURES, CFG), "drift_reports")


def alerts_df(t, reps=None):
    a = AL.alerts_from_reports(reps if reps is not None else drift_reports_df(t), CFG)
    return AL.apply_resolutions(a, AL.resolutions_before(a, CFG.resolve_before, CFG))


# --- SQL restatement: range join + full outer category union ------------------
_LONG = " UNION ALL ".join(
    f"SELECT day, '{f}' AS feature, coalesce(CAST({f} AS VARCHAR), 'None') AS category FROM profile"
    for f in FEATURES)
_DIST_CTES = with_views(V_PREDICTIONS, V_PROFILE) + f""", long AS ({_LONG}),
dates AS (SELECT CAST(d AS DATE) AS report_date
          FROM range(DATE '{REF_END}', DATE '{LAST}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
ref AS (SELECT feature, category, count(*) AS n FROM long WHERE day < DATE '{REF_END}' GROUP BY ALL),
refp AS (SELECT feature, category, n, n / sum(n) OVER (PARTITION BY feature) AS p,
                sum(n) OVER (PARTITION BY feature) AS ref_tot FROM ref),
cur AS (SELECT d.report_date, l.feature, l.category, count(*) AS n
        FROM dates d JOIN long l
          ON l.day >= d.report_date - INTERVAL {CFG.drift_window_days} DAY AND l.day < d.report_date
        GROUP BY ALL),
curq AS (SELECT report_date, feature, category, n / sum(n) OVER (PARTITION BY report_date, feature) AS q,
                sum(n) OVER (PARTITION BY report_date, feature) AS cur_tot FROM cur),
keys AS (SELECT c.report_date, r.feature, r.category
         FROM (SELECT DISTINCT report_date FROM curq) c CROSS JOIN refp r
         UNION SELECT report_date, feature, category FROM curq),
pq AS (SELECT k.report_date, k.feature, coalesce(r.p, 0) AS p, coalesce(c.q, 0) AS q
       FROM keys k LEFT JOIN refp r ON k.feature = r.feature AND k.category = r.category
       LEFT JOIN curq c ON k.report_date = c.report_date AND k.feature = c.feature AND k.category = c.category),
sizes AS (SELECT DISTINCT c.report_date, c.feature, c.cur_tot, r.ref_tot
          FROM curq c JOIN (SELECT DISTINCT feature, ref_tot FROM refp) r ON c.feature = r.feature),
dist AS (
  SELECT pq.report_date, pq.feature,
         sum(abs(p - q)) / 2 AS distance,
         sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
             + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js_divergence,
         sum((greatest(q, {D.PSI_EPS}) - greatest(p, {D.PSI_EPS})) * ln(greatest(q, {D.PSI_EPS}) / greatest(p, {D.PSI_EPS}))) AS psi,
         sum(abs(p - q)) / 2 > {THR} AS drifted
  FROM pq GROUP BY pq.report_date, pq.feature),
chi AS (
  SELECT k.report_date, k.feature,
         sum(pow(coalesce(r.n, 0) * sqrt(t.cur_tot / t.ref_tot) - coalesce(c.n, 0) * sqrt(t.ref_tot / t.cur_tot), 2)
             / (coalesce(r.n, 0) + coalesce(c.n, 0))) AS chi_square
  FROM keys k JOIN sizes t ON k.report_date = t.report_date AND k.feature = t.feature
  LEFT JOIN ref r ON k.feature = r.feature AND k.category = r.category
  LEFT JOIN cur c ON k.report_date = c.report_date AND k.feature = c.feature AND k.category = c.category
  GROUP BY k.report_date, k.feature),
dist2 AS (SELECT d.*, s.ref_tot AS reference_size, s.cur_tot AS current_size
          FROM dist d JOIN sizes s ON d.report_date = s.report_date AND d.feature = s.feature),
rep AS (
  SELECT report_date,
         sha256('drift:' || CAST(report_date AS VARCHAR)) AS id,
         sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS features_drifted,
         greatest(count(*), 1) AS total_features,
         sum(CASE WHEN drifted THEN 1 ELSE 0 END) / greatest(count(*), 1) AS drift_score,
         coalesce(bool_or(CASE WHEN feature = 'predicted_sentiment' THEN drifted END), FALSE) AS prediction_drift_detected,
         max(reference_size) AS reference_size, max(current_size) AS current_size,
         'drift_reports/report_date=' || CAST(report_date AS VARCHAR) AS report_path,
         CAST(report_date AS TIMESTAMP) AS created_at
  FROM dist2 GROUP BY report_date),
alerts0 AS (
  SELECT sha256('alert:' || id) AS id, report_date,
         CASE WHEN drift_score > {2 * THR} THEN 'drift_critical'
              WHEN drift_score > {THR} THEN 'drift_warning'
              WHEN prediction_drift_detected THEN 'model_degradation' END AS alert_type,
         CASE WHEN drift_score > {THR} * 2 THEN 'critical'
              WHEN drift_score > {THR} OR prediction_drift_detected THEN 'warning' END AS severity,
         CASE WHEN drift_score > {2 * THR} THEN '{AL.MSG_CRITICAL}' || printf('%.4f', drift_score)
              WHEN drift_score > {THR} THEN '{AL.MSG_WARNING}' || printf('%.4f', drift_score)
              WHEN prediction_drift_detected THEN '{AL.MSG_DEGRADATION}' END AS message,
         CAST(to_json(struct_pack(drift_score := CAST(drift_score AS DOUBLE),
                                  features_drifted := CAST(features_drifted AS INTEGER),
                                  total_features := CAST(total_features AS INTEGER),
                                  report_path := report_path)) AS VARCHAR) AS metadata,
         created_at
  FROM rep),
alerts AS (
  SELECT a.*, r.resolved_at, r.resolved_at IS NOT NULL AS is_resolved
  FROM (SELECT * FROM alerts0 WHERE alert_type IS NOT NULL) a
  LEFT JOIN (SELECT id AS alert_id, created_at + INTERVAL 1 DAY AS resolved_at FROM alerts0
             WHERE alert_type IS NOT NULL AND report_date < DATE '{CFG.resolve_before.isoformat()}') r
  ON a.id = r.alert_id)
"""


@register("drift_feature_distances", _DIST_CTES + """
SELECT d.report_date, d.feature, distance, js_divergence, psi, chi_square, drifted, reference_size, current_size
FROM dist2 d JOIN chi ON chi.report_date = d.report_date AND chi.feature = d.feature""",
          "report_date:date feature:str distance:dbl js_divergence:dbl psi:dbl chi_square:dbl drifted:bool "
          "reference_size:int current_size:int")
def drift_feature_distances(t):
    """TVD, JS, PSI and chi-square per report date and feature."""
    d = D.feature_distances(V.profile(t, CFG), FEATURES, CFG)
    return d.select("report_date", "feature", "distance", "js_divergence", "psi", "chi_square", "drifted",
                    "reference_size", "current_size")


_REP_SPEC = ("id:str report_date:date dataset_drift_detected:bool drift_score:dbl features_drifted:int "
             "total_features:int prediction_drift_detected:bool reference_size:int current_size:int "
             "report_path:str created_at:ts")


@register("drift_reports", _DIST_CTES + f"""
SELECT id, report_date, drift_score > {THR} AS dataset_drift_detected, drift_score, features_drifted,
       total_features, prediction_drift_detected, reference_size, current_size, report_path, created_at
FROM rep""", _REP_SPEC)
def drift_reports(t):
    """The daily drift report backfilled for every date."""
    return drift_reports_df(t).drop("details")


@register("drift_ks_length", with_views(V_PREDICTIONS, V_PROFILE) + f""", v AS (
  SELECT CAST(created_at AS DATE) AS day, input_length AS value FROM predictions),
dates AS (SELECT CAST(d AS DATE) AS report_date
          FROM range(DATE '{REF_END}', DATE '{LAST}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)),
ref AS (SELECT value, count(*) AS n FROM v WHERE day < DATE '{REF_END}' GROUP BY value),
cur AS (SELECT d.report_date, v.value, count(*) AS n FROM dates d JOIN v
          ON v.day >= d.report_date - INTERVAL {CFG.drift_window_days} DAY AND v.day < d.report_date GROUP BY ALL),
keys AS (SELECT c.report_date, r.value FROM (SELECT DISTINCT report_date FROM cur) c CROSS JOIN ref r
         UNION SELECT report_date, value FROM cur),
a AS (SELECT k.report_date, k.value, coalesce(r.n, 0) AS rn, coalesce(c.n, 0) AS cn
      FROM keys k LEFT JOIN ref r ON k.value = r.value
      LEFT JOIN cur c ON k.report_date = c.report_date AND k.value = c.value),
cum AS (SELECT report_date,
               sum(rn) OVER (PARTITION BY report_date ORDER BY value) / sum(rn) OVER (PARTITION BY report_date) AS fr,
               sum(cn) OVER (PARTITION BY report_date ORDER BY value) / sum(cn) OVER (PARTITION BY report_date) AS fc,
               sum(rn) OVER (PARTITION BY report_date) AS rt, sum(cn) OVER (PARTITION BY report_date) AS ct
        FROM a)
SELECT report_date, max(abs(fr - fc)) AS ks_statistic, max(rt) AS reference_size, max(ct) AS current_size
FROM cum GROUP BY report_date""", "report_date:date ks_statistic:dbl reference_size:int current_size:int")
def drift_ks_length(t):
    """Kolmogorov-Smirnov statistic of input_length per report date."""
    p = V.predictions(t).select(F.to_date("created_at").alias("day"), "input_length")
    return D.ks_backfill(p, "input_length", "day", CFG)


_ALERT_SPEC = ("id:str report_date:date alert_type:str severity:str message:str metadata:str "
               "created_at:ts is_resolved:bool resolved_at:ts")


@register("drift_alerts", _DIST_CTES + """
SELECT id, report_date, alert_type, severity, message, metadata, created_at, is_resolved, resolved_at
FROM alerts""", _ALERT_SPEC)
def drift_alerts(t):
    """Alerts from the drift reports with resolutions applied."""
    return alerts_df(t).select("id", "report_date", "alert_type", "severity", "message", "metadata",
                               "created_at", "is_resolved", "resolved_at")


@register("active_alerts", _DIST_CTES + """
SELECT id, alert_type, severity, message, metadata, created_at FROM alerts WHERE NOT is_resolved""",
          "id:str alert_type:str severity:str message:str metadata:str created_at:ts")
def active_alerts(t):
    """Unresolved alerts, newest first."""
    return AL.active_alerts(alerts_df(t))


@register("recent_alerts", _DIST_CTES + """
SELECT id, alert_type, severity, message, is_resolved, metadata, created_at
FROM alerts ORDER BY created_at DESC, id DESC LIMIT 5""",
          "id:str alert_type:str severity:str message:str is_resolved:bool metadata:str created_at:ts")
def recent_alerts(t):
    """The 5 newest alerts of the overview page."""
    return M.recent_alerts(alerts_df(t), 5)


@register("lead_alert", _DIST_CTES + """
, act AS (SELECT * FROM alerts WHERE NOT is_resolved),
lead AS (SELECT * FROM act ORDER BY (severity = 'critical') DESC, created_at DESC, id DESC LIMIT 1)
SELECT lead.id, lead.alert_type, lead.severity, lead.message, (SELECT count(*) FROM act) - 1 AS more_count
FROM lead""", "id:str alert_type:str severity:str message:str more_count:int")
def lead_alert(t):
    """Banner lead alert and the "+n more" count."""
    return AL.lead_alert(alerts_df(t))


@register("latest_drift_status", _DIST_CTES + f"""
SELECT report_date, drift_score > {THR} AS dataset_drift_detected, drift_score,
       CASE WHEN drift_score > {2 * THR} THEN 'critical' WHEN drift_score > {THR} THEN 'warning'
            ELSE 'healthy' END AS drift_status
FROM rep ORDER BY report_date DESC, created_at DESC, id DESC LIMIT 1""",
          "report_date:date dataset_drift_detected:bool drift_score:dbl drift_status:str")
def latest_drift_status(t):
    """Latest report and its healthy/warning/critical status."""
    r = M.latest_drift(drift_reports_df(t))
    return r.withColumn("drift_status", M.status_of(F.col("drift_score"), CFG.drift_threshold))


@register("drift_history", _DIST_CTES + f"""
SELECT report_date, drift_score, drift_score > {THR} AS dataset_drift_detected, features_drifted,
       total_features, prediction_drift_detected, report_path
FROM rep WHERE CAST(report_date AS TIMESTAMP) >= {AS_OF} - INTERVAL 14 DAY""",
          "report_date:date drift_score:dbl dataset_drift_detected:bool features_drifted:int "
          "total_features:int prediction_drift_detected:bool report_path:str")
def drift_history(t):
    """A5: drift reports of the last 14 days, by date."""
    return M.drift_history(drift_reports_df(t), CFG.as_of, 14)


@register("kpi_summary", _DIST_CTES + f"""
, today AS (SELECT count(*) AS n, coalesce(avg(latency_ms), 0) AS avg_latency FROM predictions
            WHERE CAST(created_at AS DATE) = DATE '2024-01-30'),
latest AS (SELECT drift_score FROM rep ORDER BY report_date DESC, created_at DESC, id DESC LIMIT 1)
SELECT n AS predictions_today, round(avg_latency, 2) AS avg_latency_ms,
       CAST(NULL AS VARCHAR) AS model_version, CAST(NULL AS DOUBLE) AS model_f1,
       coalesce((SELECT CASE WHEN drift_score > {2 * THR} THEN 'critical'
                             WHEN drift_score > {THR} THEN 'warning' ELSE 'healthy' END FROM latest),
                'healthy') AS drift_status
FROM today""", "predictions_today:int avg_latency_ms:dbl model_version:str model_f1:dbl drift_status:str")
def kpi_summary(t):
    """KPIs of 2024-01-30 plus the latest drift status."""
    from datetime import date
    return M.summary(V.predictions(t), drift_reports_df(t), date(2024, 1, 30), cfg=CFG)


@register("kpi_summary_production", _DIST_CTES + f"""
, today AS (SELECT count(*) AS n, coalesce(avg(latency_ms), 0) AS avg_latency FROM predictions
            WHERE CAST(created_at AS DATE) = DATE '2024-01-30'),
latest AS (SELECT drift_score FROM rep ORDER BY report_date DESC, created_at DESC, id DESC LIMIT 1),
served AS ({_LEDGER_SQL} SELECT * FROM ledger WHERE name = (SELECT min(name) FROM ledger) AND stage = 'Production')
SELECT n AS predictions_today, round(avg_latency, 2) AS avg_latency_ms,
       (SELECT CAST(max(version) AS VARCHAR) FROM served) AS model_version, (SELECT arg_max(new_f1, version) FROM served) AS model_f1,
       coalesce((SELECT CASE WHEN drift_score > {2 * THR} THEN 'critical'
                             WHEN drift_score > {THR} THEN 'warning' ELSE 'healthy' END FROM latest),
                'healthy') AS drift_status
FROM today""", "predictions_today:int avg_latency_ms:dbl model_version:str model_f1:dbl drift_status:str")
def kpi_summary_production(t):
    """A1 with the version and F1 that are served: the Production version of the first
    model of the ledger."""
    from datetime import date
    from ..operators import registry as RG
    from .q_ledgers import ledger_df
    ledger = cut_lineage(ledger_df(t), "ledger")
    served = RG.production(ledger, ledger.agg(F.min("name")).first()[0])
    return M.summary(V.predictions(t), drift_reports_df(t), date(2024, 1, 30), *served, cfg=CFG)


@register("recent_alerts_page", _DIST_CTES + """
SELECT id, alert_type, severity, message, is_resolved, metadata, created_at
FROM alerts ORDER BY created_at DESC, id DESC LIMIT 50""",
          "id:str alert_type:str severity:str message:str is_resolved:bool metadata:str created_at:ts")
def recent_alerts_page(t):
    """The 50 newest alerts of the alerts page."""
    return M.recent_alerts(alerts_df(t), CFG.listing_limit)


@register("drift_monitor_daily", _DIST_CTES + f"""
, vol AS (SELECT CAST(date_trunc('day', created_at) AS DATE) AS day, count(*) AS n FROM predictions GROUP BY 1)
SELECT r.report_date, r.drift_score, r.features_drifted, r.prediction_drift_detected,
       CASE WHEN r.drift_score > {2 * THR} THEN 'critical' WHEN r.drift_score > {THR} THEN 'warning'
            ELSE 'healthy' END AS drift_status,
       a.alert_type, a.severity, coalesce(a.is_resolved, FALSE) AS is_resolved,
       coalesce(v.n, 0) AS predictions_on_day
FROM rep r LEFT JOIN alerts a ON r.report_date = a.report_date
LEFT JOIN vol v ON v.day = r.report_date - INTERVAL 1 DAY""",
          "report_date:date drift_score:dbl features_drifted:int prediction_drift_detected:bool "
          "drift_status:str alert_type:str severity:str is_resolved:bool predictions_on_day:int")
def drift_monitor_daily(t):
    """Flagship: R5 drift backfill joined with R4 alerts and the A2 volume of
    the day each report closes."""
    reps = drift_reports_df(t)
    al = alerts_df(t, reps)
    # The days that the reports close: bounded by the report dates themselves.
    first, last = CFG.reference_end - timedelta(days=1), CFG.as_of.date()
    p = V.predictions(t).where((F.col("created_at") >= date_lit(first)) & (F.col("created_at") < date_lit(last)))
    vol = p.groupBy(F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("predictions_on_day"))
    r = reps.select("report_date", "drift_score", "features_drifted", "prediction_drift_detected",
                    M.status_of(F.col("drift_score"), CFG.drift_threshold).alias("drift_status"))
    j = (r.join(al.select("report_date", "alert_type", "severity", "is_resolved"), "report_date", "left")
         .join(vol, F.date_sub(r["report_date"], 1) == vol["day"], "left"))
    return j.select("report_date", "drift_score", "features_drifted", "prediction_drift_detected",
                    "drift_status", "alert_type", "severity",
                    F.coalesce("is_resolved", F.lit(False)).alias("is_resolved"),
                    F.coalesce("predictions_on_day", F.lit(0)).alias("predictions_on_day"))


@register("drift_summary_from_report", _DIST_CTES + """
SELECT report_date, drift_score > 0 AS dataset_drift_detected, drift_score, features_drifted,
       total_features, prediction_drift_detected FROM rep""",
          "report_date:date dataset_drift_detected:bool drift_score:dbl features_drifted:int "
          "total_features:int prediction_drift_detected:bool")
def drift_summary_from_report(t):
    """Each date's distances written as a preset-style report document
    (JSON text) and summarised back by ``create_drift_summary`` rules. On every
    other date a last entry repeats the counts without a share."""
    from ..functions import jsonx as J
    d = D.feature_distances(V.profile(t, CFG), FEATURES, CFG)
    per_col = F.struct(F.lit("ColumnDriftMetric").alias("metric"), F.struct(
        F.col("feature").alias("column_name"), F.col("drifted").alias("drift_detected")).alias("result"))
    g = d.groupBy("report_date").agg(
        F.sum(F.col("drifted").cast("int")).alias("k"), F.count(F.lit(1)).alias("n"),
        F.collect_list(per_col).alias("cols"))
    dataset = F.struct(F.lit("DatasetDriftMetric").alias("metric"), F.struct(
        F.col("k").alias("number_of_drifted_columns"), F.col("n").alias("number_of_columns"),
        (F.col("k") / F.col("n")).alias("share_of_drifted_columns")).alias("result"))
    # to_json leaves the null share out
    bare = F.struct(F.lit("DataDriftTable").alias("metric"), F.struct(
        F.col("k").alias("number_of_drifted_columns"), F.col("n").alias("number_of_columns"),
        F.lit(None).cast("double").alias("share_of_drifted_columns")).alias("result"))
    tail = F.when(F.dayofmonth("report_date") % 2 == 1, F.array(F.to_json(bare))).otherwise(F.array().cast("array<string>"))
    # Build the document as real JSON text: {"metrics": [ ... ]}
    doc = F.concat(F.lit('{"metrics": ['), F.array_join(F.concat(
        F.array(F.to_json(dataset)), F.transform("cols", lambda c: F.to_json(c)), tail), ", "), F.lit("]}"))
    s = g.select("report_date", J.drift_summary(doc).alias("s"))
    return s.select("report_date", "s.dataset_drift_detected", "s.drift_score", "s.features_drifted",
                    "s.total_features", "s.prediction_drift_detected")
