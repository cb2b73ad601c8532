"""Streaming queries (X1-X5): file stream over ``events`` run to completion
with ``availableNow``; append-mode results hold the windows the watermark has
closed, which is what the oracles restate."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import activity as A
from ..session import scratch_path
from ..streaming import backlog as BL
from ..streaming import stream as ST
from .catalog import register

CFG = DEFAULT


def _drift_sql() -> str:
    from . import q_drift
    return q_drift._DIST_CTES + """
SELECT report_date, drift_score, features_drifted, total_features, prediction_drift_detected,
       reference_size, current_size
FROM rep WHERE CAST(report_date AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"""


_DRIFT_SQL = _drift_sql()


def _events(t):
    path = f"{t.root}/events.parquet"
    return ST.event_stream(t.spark, path), path


@register("stream_hourly_volume", """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM events GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
          "window_start:ts window_end:ts count:int")
def stream_hourly_volume(t):
    """Hourly volume as a watermarked tumbling-window stream."""
    s, path = _events(t)
    return ST.run_available(ST.hourly_volume(s, "1 hour"), "hourly_volume", path)


# Two deliveries of the events: a fifth of the first half of the month comes with the second.
_SECOND = "event_id % 5 = 0 OR ts >= TIMESTAMP '2024-01-16 00:00:00'"


def _deliveries(t):
    """The two deliveries as folders of several files, and a backlog to take them."""
    events, root = t.events, scratch_path(t.spark, f"backlog-{uuid.uuid4().hex}")
    for name, rows in (("first", events.where(f"NOT ({_SECOND})")), ("second", events.where(_SECOND))):
        rows.repartition(5, "user_id").write.parquet(f"{root}/{name}")
    size = max(1, events.count() // 6)
    return root, BL.Backlog(t.spark, f"{root}/backlog", ST.EVENTS_SCHEMA, timedelta(hours=1), slice_rows=size)


def _taken(t):
    root, backlog = _deliveries(t)
    for name in ("first", "second"):
        out, _ = backlog.run(BL.source_files(t.spark, f"{root}/{name}"), lambda s: ST.hourly_volume(s, "1 hour"))
    return out, backlog.late_rows()


_LATE = f"""(SELECT * FROM events WHERE ({_SECOND}) AND ts <=
  to_timestamp((SELECT epoch_ms(max(ts)) FROM events WHERE NOT ({_SECOND})) / 1000.0)::TIMESTAMP - INTERVAL 1 HOUR)"""


@register("stream_backlog_volume", f"""
WITH e AS (SELECT * FROM events WHERE event_id NOT IN (SELECT event_id FROM {_LATE}))
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
       time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
FROM e GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
          "window_start:ts window_end:ts count:int")
def stream_backlog_volume(t):
    """X1 over a backlog: two deliveries of overlapping files, taken in time slices."""
    return _taken(t)[0]


@register("stream_backlog_late", f"SELECT event_id, ts, user_id, 1 AS delivery FROM {_LATE}",
          "event_id:int ts:ts user_id:int delivery:int")
def stream_backlog_late(t):
    """The rows of the second delivery that came too late, all of them."""
    return _taken(t)[1].select("event_id", "ts", "user_id", "delivery")


@register("stream_sliding_categories", """
WITH w AS (
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) - k * INTERVAL 1 DAY AS window_start, event_type AS category
  FROM events, range(0, 7) r(k))
SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, category, count(*) AS count
FROM w GROUP BY ALL
HAVING window_start + INTERVAL 7 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
          "window_start:ts window_end:ts category:str count:int")
def stream_sliding_categories(t):
    """7-day windows sliding by a day, counts per event type (drift input)."""
    s, path = _events(t)
    return ST.run_available(ST.sliding_category_counts(s, "event_type", "1 day"),
                            "sliding_categories", path)


_SESSIONS = """
WITH e AS (
  SELECT user_id, ts, value,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE
              THEN 1 ELSE 0 END AS new_session
  FROM events),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
             count(*) AS events, sum(value) AS value
      FROM s GROUP BY user_id, sid)
SELECT * FROM g"""


@register("stream_user_sessions", _SESSIONS + " WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR",
          "user_id:int session_start:ts session_end:ts events:int value:dbl")
def stream_user_sessions(t):
    """Per-user session windows with a 30-minute gap; closed sessions."""
    s, path = _events(t)
    return ST.run_available(ST.user_sessions(s), "user_sessions", path)


_FLAGS = """
WITH RECURSIVE e AS (
  SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
f(event_id, user_id, ts, rn, window_start, hits) AS (
  SELECT event_id, user_id, ts, rn, ts, 1 FROM e WHERE rn = 1
  UNION ALL
  SELECT e.event_id, e.user_id, e.ts, e.rn,
         CASE WHEN e.ts >= f.window_start + INTERVAL {W} SECOND THEN e.ts ELSE f.window_start END,
         CASE WHEN e.ts >= f.window_start + INTERVAL {W} SECOND THEN 1 ELSE f.hits + 1 END
  FROM f JOIN e ON e.user_id = f.user_id AND e.rn = f.rn + 1)
SELECT event_id, user_id, ts, window_start, hits, hits > {L} AS flagged FROM f""".format(W=CFG.rate_window_seconds, L=CFG.rate_limit_per_minute)


@register("stream_rate_flags", _FLAGS + """
WHERE epoch_us(ts) <= ((SELECT epoch_ms(max(ts)) FROM events) - 3600000) * 1000""",
          "event_id:int user_id:int ts:ts window_start:ts hits:int flagged:bool")
def stream_rate_flags(t):
    """First-hit anchored 60 s windows per user, flagged above the limit
    for the hits that the watermark (one hour) has passed."""
    s, path = _events(t)
    return ST.run_available(ST.rate_flags(s, CFG), "rate_flags_wm", path)


@register("stream_dedup", """
SELECT DISTINCT event_id, ts, user_id, event_type FROM events""",
          "event_id:int ts:ts user_id:int event_type:str")
def stream_dedup(t):
    """Duplicates within the watermark dropped by event_id."""
    s, path = _events(t)
    d = ST.run_available(ST.deduplicated(s), "dedup", path)
    return d.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")


@register("stream_drift_reports", _DRIFT_SQL, "report_date:date drift_score:dbl features_drifted:int total_features:int prediction_drift_detected:bool reference_size:int current_size:int")
def stream_drift_reports(t):
    """X2 full: drift reports scored per micro-batch on closed sliding windows
    (oracle: the batch drift report for the same, closed, report dates)."""
    from ..operators import drift as D
    from ..sources import views as V
    feats = list(V.PROFILE_FEATURES)
    ref = (D.daily_category_counts(V.profile(t, CFG), feats)
           .where(F.col("day") < F.lit(CFG.reference_end))
           .groupBy("feature", "category").agg(F.sum("n").alias("ref_n")))
    s, path = _events(t)
    rep, _ = ST.drift_on_closed_windows(s, ref, feats, "drift_windows", path, CFG)
    return rep.select("report_date", "drift_score", "features_drifted", "total_features",
                      "prediction_drift_detected", "reference_size", "current_size")


@register("user_sessions", _SESSIONS, "user_id:int session_start:ts session_end:ts events:int value:dbl")
def user_sessions(t):
    """X3 over the whole table: every session, users dealt by time ranges."""
    return A.sessions(t.events, timedelta(minutes=30))


@register("rate_flags", _FLAGS, "event_id:int user_id:int ts:ts window_start:ts hits:int flagged:bool")
def rate_flags(t):
    """X4 over the whole table: every hit, users dealt by time ranges."""
    flags = A.rate_windows(t.events, CFG.rate_limit_per_minute, timedelta(seconds=CFG.rate_window_seconds))
    return flags.drop("_pid")
