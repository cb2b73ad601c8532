"""Monitoring aggregates over the prediction log.

All of them are a pushed-down time filter on ``created_at`` followed by one
hash aggregate with map-side combine, so a hot bucket or label never lands in
a single task.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.common import one_row
from ..functions.dates import bucket_unit, on_day, trailing_window, truncate
from .quantiles import quantiles


def status_of(score: Column, threshold: float) -> Column:
    """``> 2t`` critical, ``> t`` warning, otherwise healthy (strict)."""
    return (F.when(score > F.lit(2 * threshold), "critical")
            .when(score > F.lit(threshold), "warning").otherwise("healthy"))


def latest_drift(drift_reports: DataFrame) -> DataFrame:
    """T4: the newest report by (report_date, created_at); 0 or 1 row."""
    order = F.struct("report_date", "created_at", "id")
    row = F.max_by(F.struct("dataset_drift_detected", "drift_score", "report_date"), order)
    return (drift_reports.agg(row.alias("r"), F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 0)
            .select("r.report_date", "r.dataset_drift_detected", "r.drift_score"))


def latest_status(drift_reports: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """O2: the newest report with its status."""
    return latest_drift(drift_reports).withColumn("drift_status", status_of(F.col("drift_score"), cfg.drift_threshold))


def summary(predictions: DataFrame, drift_reports: DataFrame, day: date,
            model_version: str | None = None, model_f1: float | None = None,
            cfg: Config = DEFAULT) -> DataFrame:
    """A1: one row of KPIs for ``day`` plus the status of the latest report.

    The two inputs are tagged and folded by one aggregate (no cross join).
    """
    today = predictions.where(on_day("created_at", day)).select(
        F.lit(1).alias("_p"), F.col("latency_ms").cast("double").alias("_lat"),
        F.lit(None).cast("struct<d:date,c:timestamp_ntz,i:string>").alias("_o"),
        F.lit(None).cast("double").alias("_score"))
    drift = drift_reports.select(
        F.lit(0).alias("_p"), F.lit(None).cast("double").alias("_lat"),
        F.struct(F.col("report_date").alias("d"), F.col("created_at").alias("c"),
                 F.col("id").alias("i")).alias("_o"),
        F.col("drift_score").cast("double").alias("_score"))
    u = today.unionByName(drift)
    agg = u.agg(
        F.sum("_p").alias("_n"),
        F.avg("_lat").alias("_avg"),
        F.max_by("_score", "_o").alias("_latest"))
    return agg.select(
        F.coalesce(F.col("_n"), F.lit(0)).cast("bigint").alias("predictions_today"),
        F.round(F.coalesce(F.col("_avg"), F.lit(0.0)), 2).alias("avg_latency_ms"),
        F.lit(model_version).cast("string").alias("model_version"),
        F.lit(model_f1).cast("double").alias("model_f1"),
        F.when(F.col("_latest").isNull(), "healthy")
         .otherwise(status_of(F.col("_latest"), cfg.drift_threshold)).alias("drift_status"),
    )


def prediction_volume(predictions: DataFrame, as_of: datetime, days: int | None = None,
                      hours: int | None = None) -> DataFrame:
    """A2: count per hour (when ``hours`` is given) or per day; no empty buckets."""
    unit = bucket_unit(hours)
    return (predictions.where(trailing_window("created_at", as_of, days, hours))
            .groupBy(truncate("created_at", unit).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy("bucket"))


def latency_percentiles(predictions: DataFrame, as_of: datetime | None, days: int | None = None,
                        hours: int | None = None, exact: bool = True) -> DataFrame:
    """A3: interpolated p50/p95/p99 and n; null becomes 0. Without ``as_of``
    over the whole log.

    Exact values come from ``quantiles`` (no task holds all distinct values);
    ``exact=False`` uses ``percentile_approx`` sketches.
    """
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    lat = F.col("latency_ms")
    w = predictions if as_of is None else predictions.where(trailing_window("created_at", as_of, days, hours))
    if exact:
        agg = one_row(quantiles(w, lat, names), w.agg(F.count(F.lit(1)).alias("count")))
    else:
        agg = w.agg(*[F.percentile_approx(lat, q, 10000).cast("double").alias(n) for n, q in names.items()],
                    F.count(F.lit(1)).alias("count"))
    return agg.select(*[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in names], "count")


def sentiment_distribution(predictions: DataFrame, as_of: datetime, days: int | None = None,
                           hours: int | None = None) -> DataFrame:
    """A4: count per predicted label."""
    return (predictions.where(trailing_window("created_at", as_of, days, hours))
            .groupBy("predicted_sentiment").agg(F.count(F.lit(1)).alias("count")))


def sentiment_share(predictions: DataFrame, as_of: datetime, days: int | None = None,
                    hours: int | None = None) -> DataFrame:
    """M4: positive and negative share of the window (0 when empty)."""
    w = predictions.where(trailing_window("created_at", as_of, days, hours))
    pos = F.sum(F.when(F.col("predicted_sentiment") == "positive", 1).otherwise(0))
    neg = F.sum(F.when(F.col("predicted_sentiment") == "negative", 1).otherwise(0))
    n = F.count(F.lit(1))
    return w.agg(n.alias("total"),
                 F.coalesce(F.try_divide(pos.cast("double"), n), F.lit(0.0)).alias("positive_share"),
                 F.coalesce(F.try_divide(neg.cast("double"), n), F.lit(0.0)).alias("negative_share"))


def drift_history(drift_reports: DataFrame, as_of: datetime, days: int | None = 30) -> DataFrame:
    """A5: reports in the window, by date.

    The bound compares a DATE with a timestamp: the DATE is promoted to its
    midnight, so the boundary day survives only when ``as_of`` is midnight.
    """
    bound = trailing_window(F.col("report_date").cast("timestamp_ntz"), as_of, days, None)
    return (drift_reports.where(bound)
            .select("report_date", "drift_score", "dataset_drift_detected", "features_drifted",
                    "total_features", "prediction_drift_detected", "report_path")
            .orderBy("report_date"))


def recent_predictions(predictions: DataFrame, limit: int | None = None,
                       cfg: Config = DEFAULT) -> DataFrame:
    """Newest N (default 20, at most 200); ties broken by id.

    Planned as TakeOrderedAndProject: per-partition top-N, then a merge of
    N rows per partition.
    """
    n = min(int(limit or cfg.recent_limit), cfg.recent_limit_max)
    return (predictions.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)
            .select("id", "created_at", "predicted_sentiment", "confidence", "latency_ms",
                    "model_version"))


def confidence_histogram(predictions: DataFrame, as_of: datetime, days: int | None = None,
                         hours: int | None = None) -> DataFrame:
    """``floor(min(c, 0.9999) * 10) / 10`` computed in DECIMAL."""
    c = F.col("confidence")
    b = F.floor(F.least(c, F.lit(0.9999).cast("decimal(5,4)")) * 10) / 10
    return (predictions.where(trailing_window("created_at", as_of, days, hours))
            .groupBy(b.cast("double").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("bucket"))


def recent_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """Newest alerts (50 on the alerts page, 5 on the overview)."""
    return (alerts.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)
            .select("id", "alert_type", "severity", "message", "is_resolved", "metadata",
                    "created_at"))


def recent_runs(run_history: DataFrame, limit: int = 50) -> DataFrame:
    """Newest run rows by start."""
    return (run_history.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(limit)
            .select("id", "dag_id", "run_id", "status", "started_at", "completed_at",
                    "duration_seconds", "metrics"))
