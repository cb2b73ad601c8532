"""Monitoring queries (A1-A7, T1, M4, S6) over the derived prediction log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.dates import trailing_window
from ..operators import metrics as M
from ..sources import views as V
from .catalog import register
from .oracle_views import AS_OF, V_PREDICTIONS, with_views
from .oracle_views import V_REVIEWS as V_REVIEWS_FOR_INGEST

CFG = DEFAULT
AS = CFG.as_of
TODAY = date(2024, 1, 30)
W_PRED = with_views(V_PREDICTIONS)


@register("prediction_volume_daily", W_PRED + f"""
SELECT date_trunc('day', created_at) AS bucket, count(*) AS count
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 14 DAY
GROUP BY 1""", "bucket:ts count:int")
def prediction_volume_daily(t):
    """Daily volume over the 14-day overview window."""
    return M.prediction_volume(V.predictions(t), AS, days=14)


@register("prediction_volume_hourly", W_PRED + f"""
SELECT date_trunc('hour', created_at) AS bucket, count(*) AS count
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 48 HOUR
GROUP BY 1""", "bucket:ts count:int")
def prediction_volume_hourly(t):
    """Hourly volume; hours win over days."""
    return M.prediction_volume(V.predictions(t), AS, days=30, hours=48)


@register("latency_percentiles", W_PRED + f"""
SELECT coalesce(percentile_cont(0.5) WITHIN GROUP (ORDER BY latency_ms), 0) AS p50,
       coalesce(percentile_cont(0.95) WITHIN GROUP (ORDER BY latency_ms), 0) AS p95,
       coalesce(percentile_cont(0.99) WITHIN GROUP (ORDER BY latency_ms), 0) AS p99,
       count(*) AS count
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 7 DAY""",
          "p50:dbl p95:dbl p99:dbl count:int")
def latency_percentiles(t):
    """Exact interpolated latency percentiles over 7 days."""
    return M.latency_percentiles(V.predictions(t), AS, days=7)


@register("latency_percentiles_all", W_PRED + """
SELECT coalesce(percentile_cont(0.5) WITHIN GROUP (ORDER BY latency_ms), 0) AS p50,
       coalesce(percentile_cont(0.95) WITHIN GROUP (ORDER BY latency_ms), 0) AS p95,
       coalesce(percentile_cont(0.99) WITHIN GROUP (ORDER BY latency_ms), 0) AS p99,
       count(*) AS count
FROM predictions""",
          "p50:dbl p95:dbl p99:dbl count:int")
def latency_percentiles_all(t):
    """A3 over the whole log."""
    return M.latency_percentiles(V.predictions(t), None)


@register("sentiment_distribution", W_PRED + f"""
SELECT predicted_sentiment, count(*) AS count
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 7 DAY
GROUP BY 1""", "predicted_sentiment:str count:int")
def sentiment_distribution(t):
    """A4: count per predicted label over 7 days."""
    return M.sentiment_distribution(V.predictions(t), AS, days=7)


@register("sentiment_share", W_PRED + f"""
SELECT count(*) AS total,
       coalesce(sum(CASE WHEN predicted_sentiment = 'positive' THEN 1 ELSE 0 END) / nullif(count(*), 0), 0) AS positive_share,
       coalesce(sum(CASE WHEN predicted_sentiment = 'negative' THEN 1 ELSE 0 END) / nullif(count(*), 0), 0) AS negative_share
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 30 DAY""",
          "total:int positive_share:dbl negative_share:dbl")
def sentiment_share(t):
    """M4: positive / negative share of the 30-day window."""
    return M.sentiment_share(V.predictions(t), AS, days=30)


@register("confidence_histogram", W_PRED + f"""
SELECT floor(least(confidence, 0.9999) * 10) / 10 AS bucket, count(*) AS count
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 7 DAY
GROUP BY 1""", "bucket:dbl count:int")
def confidence_histogram(t):
    """Confidence histogram in 0.1 steps (DECIMAL arithmetic)."""
    return M.confidence_histogram(V.predictions(t), AS, days=7)


@register("recent_predictions", W_PRED + """
SELECT id, created_at, predicted_sentiment, confidence, latency_ms, model_version
FROM predictions ORDER BY created_at DESC, id DESC LIMIT 20""",
          "id:int created_at:ts predicted_sentiment:str confidence:dbl latency_ms:int model_version:str")
def recent_predictions(t):
    """The newest 20 predictions (top-k is the feature)."""
    return M.recent_predictions(V.predictions(t))


@register("drift_window_extract", W_PRED + f"""
SELECT id, predicted_sentiment, confidence, input_length, latency_ms, created_at
FROM predictions WHERE created_at >= {AS_OF} - INTERVAL 7 DAY""",
          "id:int predicted_sentiment:str confidence:dbl input_length:int latency_ms:int created_at:ts")
def drift_window_extract(t):
    """The drift job's current window (5 columns + id), pruned and pushed."""
    p = V.predictions(t)
    return (p.where(trailing_window("created_at", AS, CFG.drift_window_days))
            .select("id", "predicted_sentiment", "confidence", "input_length", "latency_ms",
                    "created_at"))


@register("prediction_log", W_PRED + """
SELECT id, input_text_hash, input_length, predicted_sentiment, confidence,
       model_version, model_name, latency_ms, created_at FROM predictions""",
          "id:int input_text_hash:str input_length:int predicted_sentiment:str confidence:dbl "
          "model_version:str model_name:str latency_ms:int created_at:ts")
def prediction_log(t):
    """The full derived prediction log rows."""
    return V.predictions(t)


@register("latency_spike_alerts", W_PRED + """
, d AS (SELECT CAST(created_at AS DATE) AS day, quantile_cont(latency_ms, 0.95) AS p95
        FROM predictions GROUP BY 1),
b AS (SELECT day, p95, median(p95) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS base FROM d)
SELECT sha256('latency:' || CAST(day AS VARCHAR)) AS id, 'latency_spike' AS alert_type, 'warning' AS severity,
       'Latency p95 spike: ' || printf('%.1f', p95) AS message, CAST(day AS TIMESTAMP) AS created_at
FROM b WHERE p95 > 1.05 * base""".replace("\n, d AS", ", d AS", 1),
          "id:str alert_type:str severity:str message:str created_at:ts")
def latency_spike_alerts(t):
    """The declared latency_spike type: daily p95 above 1.05x the median
    p95 of the previous 7 days (one row per day, a tiny window)."""
    from ..operators import alerts as AL
    return AL.latency_spike_alerts(V.predictions(t), factor=1.05)


@register("ingested_reviews", with_views(V_REVIEWS_FOR_INGEST) + """
SELECT doc_id, text, label FROM reviews""", "doc_id:int text:str label:int")
def ingested_reviews(t):
    """The labelled splits unioned back and normalised to
    (text, label), keyed by doc_id."""
    from pyspark.sql import functions as F
    from ..operators import sample as S
    from ..sources import ingest as IG
    s = S.stratified_split(V.reviews(t), "doc_id", "label", CFG)
    parts = [s.where(F.col("split") == name).select("doc_id", F.col("text").alias("sentence"), "label")
             for name in ("train", "val", "test")]
    u = IG.union_splits(parts)
    return IG.normalize_columns(u, keep=("doc_id",))


@register("ingested_sources", with_views(V_REVIEWS_FOR_INGEST) + """
SELECT 'reviews' AS source, doc_id AS item, text, label FROM reviews
UNION ALL SELECT 'turns', conv_id * 1000 + turn, text, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 0 END FROM conversations
UNION ALL SELECT 'pages', page_id, html, NULL FROM pages""", "source:str item:int text:str label:int")
def ingested_sources(t):
    """S1/S2/U1 over three tables with columns of their own: normalised to (text, label),
    a missing label as null, and unioned."""
    from ..sources import ingest as IG
    role = F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 0)
    tables = {
        "reviews": V.reviews(t).withColumnRenamed("doc_id", "item"),
        "turns": t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("item"), F.col("text").alias("sentence"), role.alias("sentiment")),
        "pages": t.pages.select(F.col("page_id").alias("item"), F.col("html").alias("sentence"))}
    parts = [IG.normalize_columns(df, keep=("item",)).withColumn("source", F.lit(name)) for name, df in tables.items()]
    return IG.union_splits(parts).select("source", "item", "text", "label")
