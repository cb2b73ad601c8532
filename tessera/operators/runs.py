"""Run lifecycle fold (W5, N5) over an append-only event table.

The reference keeps one mutable row per DAG run: a start deletes the open
row and inserts a new one; a finish updates the open row (status, end,
duration, metrics) or, when none is open, inserts a zero-length terminal
row. Folded over the ordered events of a ``(dag_id, run_id)`` key this is:

* a finish whose previous event is a start closes that start's row;
* a finish after another finish (or first) is an unmatched, 0 s row;
* a start followed by no event stays ``running``; a start followed by a
  start is replaced and leaves no row.

So only the previous and next event of each event are needed (``lag`` and
``lead``), computed by a segmented scan over ranges of (key, time), so a hot run key
is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import det_id
from ..functions.dates import duration_seconds
from .segments import Ranged, neighbours

KEY = ["dag_id", "run_id"]


def fold_runs(events: DataFrame) -> DataFrame:
    """``pipeline_runs`` rows from ``(event_id, dag_id, run_id, kind,
    evt_at, metrics)`` events; ``kind`` is start, success or failed."""
    n = neighbours(Ranged.of(events, KEY, ["evt_at", "event_id"]), ["kind", "evt_at", "event_id"]).rows
    is_start = F.col("kind") == "start"
    prev_start = F.col("prev_kind") == "start"
    finish = (~is_start).alias("_finish")
    matched = (~is_start) & F.coalesce(prev_start, F.lit(False))
    keep = (~is_start) | F.col("next_kind").isNull()
    rows = n.where(keep).select(
        "dag_id", "run_id", finish, matched.alias("_matched"), "event_id", "evt_at", "kind",
        "metrics", F.col("prev_evt_at"), F.col("prev_event_id"))
    started = F.when(F.col("_matched"), F.col("prev_evt_at")).otherwise(F.col("evt_at"))
    anchor = F.when(F.col("_matched"), F.col("prev_event_id")).otherwise(F.col("event_id"))
    return rows.select(
        det_id("dag_id", "run_id", anchor).alias("id"),
        "dag_id", "run_id",
        F.when(F.col("_finish"), F.col("kind")).otherwise(F.lit("running")).alias("status"),
        started.alias("started_at"),
        F.when(F.col("_finish"), F.col("evt_at")).alias("completed_at"),
        F.when(F.col("_matched"), duration_seconds(F.col("prev_evt_at"), F.col("evt_at")))
         .when(F.col("_finish"), F.lit(0)).cast("int").alias("duration_seconds"),
        F.when(F.col("_finish"), F.coalesce(F.col("metrics"), F.lit("{}"))).alias("metrics"),
    )


def run_summary(run_history: DataFrame) -> DataFrame:
    """Per DAG, counts by status, last start, mean duration of finished runs."""
    return run_history.groupBy("dag_id").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum((F.col("status") == "success").cast("int")).alias("succeeded"),
        F.sum((F.col("status") == "failed").cast("int")).alias("failed"),
        F.sum((F.col("status") == "running").cast("int")).alias("running"),
        F.max("started_at").alias("last_started_at"),
        F.avg("duration_seconds").alias("mean_duration_seconds"))
