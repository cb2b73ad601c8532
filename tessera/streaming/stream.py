"""Structured Streaming forms of the monitoring jobs.

Sources are file streams over parquet; sinks are parquet with a checkpoint in
the shared checkpoint folder. ``run_available`` drives a query with
``trigger(availableNow=True)``, which processes what is there and then flushes
what the watermark has closed.

A backlog is read as one micro-batch unless ``max_files`` says otherwise: the
watermark then moves after all of it, so the answer does not depend on the
order of the files. With ``max_files`` the files must come in event-time order
within the watermark delay; rows that the watermark drops are counted over all
micro-batches, and a run that dropped any raises unless the caller accepts them.
``backlog`` reads a backlog of any size in bounded micro-batches ordered by time.

Each run has a checkpoint and an output of its own. A run that must resume
names a ``resume`` key; the folder then depends on that key, the source and the
query's configuration, never on the name alone.

``withWatermark`` needs TIMESTAMP (not TIMESTAMP_NTZ): event time is cast
with the session zone pinned to UTC.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState

from ..config import DEFAULT, Config
from ..operators.activity import fold_hits
from ..session import scratch_path

EVENTS_SCHEMA = ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                 "value DOUBLE, props STRING")


def _stream_path(path: str) -> str:
    """The file source lists directories; a single parquet file is addressed
    by a one-file glob (its last character in brackets)."""
    if path.endswith(".parquet"):
        return f"{path[:-1]}[{path[-1]}]"
    return path


class LateRows(RuntimeError):
    """The watermark dropped rows of a run that had to be complete."""


def event_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Events as a stream, event time ``ts`` cast to TIMESTAMP (UTC)."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(_stream_path(path)).withColumn("ts", F.col("ts").cast("timestamp"))


def _location(spark: SparkSession, name: str, source: str, resume: str | None = None) -> tuple[str, str]:
    tag = uuid.uuid4().hex if resume is None else hashlib.md5(f"{source}\n{resume}".encode()).hexdigest()
    base = scratch_path(spark, f"streams/{name}-{tag}")
    return f"{base}/checkpoint", f"{base}/output"


class Progress(StreamingQueryListener):
    """Sums over all micro-batches of the queries started while it listens (a query's own
    ``recentProgress`` keeps the last ones only): rows that the watermark has dropped,
    and the largest number of rows in state."""

    def __init__(self, spark: SparkSession):
        self.streams, self.ended = spark.streams, threading.Event()
        self.dropped = self.most_state = self.batches = 0

    def __enter__(self) -> "Progress":
        self.streams.addListener(self)
        return self

    def __exit__(self, *error) -> None:
        self.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        self.run = event.runId

    def onQueryProgress(self, event) -> None:
        if event.progress.runId == self.run:
            ops = event.progress.stateOperators
            self.batches += 1
            self.dropped += sum(op.numRowsDroppedByWatermark for op in ops)
            self.most_state = max(self.most_state, sum(op.numRowsTotal for op in ops))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.ended.set()


def finish(start, allow_late: bool = False) -> Progress:
    """Run a query (``start`` starts it and returns it) to its end."""
    with Progress(SparkSession.getActiveSession()) as progress:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
        # events come in order, so all progress has been seen by the last one
        if not progress.ended.wait(120):
            raise RuntimeError("the end of the query was not reported: late rows are not counted in full")
    if progress.dropped and not allow_late:
        raise LateRows(f"{query.name or 'stream'}: {progress.dropped} rows came after the watermark; read the backlog "
                       "in order (backlog.run) or as one micro-batch, or raise the delay")
    return progress


def run_available(df: DataFrame, name: str, source: str, mode: str = "append",
                  partition_by: list[str] | None = None, resume: str | None = None,
                  allow_late: bool = False) -> DataFrame:
    """Run a streaming frame to completion on what is available; return the
    sink as a batch DataFrame. With ``resume`` (name the configuration and the
    model in it) a rerun goes on from its checkpoint and adds nothing twice."""
    spark = df.sparkSession
    ckpt, out = _location(spark, name, source, resume)
    w = df.writeStream.format("parquet").option("checkpointLocation", ckpt).outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    finish(lambda: w.trigger(availableNow=True).start(out), allow_late)
    return spark.read.schema(df.schema).parquet(out)


# --- X1: tumbling hourly volume --------------------------------------------------

def hourly_volume(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """X1 (A2 as a stream): count per closed hour window, append mode."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "count"))


# --- X2: sliding 7-day category counts feeding drift --------------------------------

def sliding_category_counts(events: DataFrame, feature: str = "event_type",
                            delay: str = "1 day") -> DataFrame:
    """Counts per (7-day window sliding by 1 day, category)."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.window("ts", "7 days", "1 day").alias("w"), F.col(feature).alias("category"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "category", "count"))


# --- X3: session activity per user ----------------------------------------------------

def user_sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Session windows per user (events closer than ``gap``)."""
    return (events.withWatermark("ts", delay)
            .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
            .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))
            .select("user_id", F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "events", "value"))


# --- X4: fixed-window rate flagging (window opens at the first hit) -------------------

RATE_OUT = "event_id BIGINT, user_id BIGINT, ts_us BIGINT, window_start_us BIGINT, hits INT"
RATE_STATE = "window_start_us BIGINT, hits INT, ts_us ARRAY<BIGINT>, ids ARRAY<BIGINT>"


def _rate_fn(window_s: int, timeout: bool):
    span = window_s * 1_000_000  # microseconds

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, hits, ts, ids = state.get if state.exists else (None, 0, [], [])
        parts = [] if state.hasTimedOut else [(p["ts_us"].to_numpy(), p["event_id"].to_numpy()) for p in pdfs]
        ts = np.concatenate([np.asarray(ts, np.int64), *[p[0] for p in parts]])
        ids = np.concatenate([np.asarray(ids, np.int64), *[p[1] for p in parts]])
        order = np.lexsort((ids, ts))
        ts, ids = ts[order], ids[order]
        # Hits up to the watermark are complete: Spark lets no earlier one in.
        wm = state.getCurrentWatermarkMs() if timeout else None
        n = int(np.searchsorted(ts, wm * 1000, side="right")) if timeout else len(ts)
        starts, counts, start, hits = fold_hits(ts[:n], span, start, hits)
        if n:
            yield pd.DataFrame({"event_id": ids[:n], "user_id": key[0], "ts_us": ts[:n],
                                "window_start_us": starts, "hits": counts})
        if not timeout:
            state.update((start, hits, [], []))
            return
        if n == len(ts) and (start is None or start + span <= wm * 1000):
            state.remove()  # nothing waits and the window is over
            return
        state.update((start, hits, ts[n:].tolist(), ids[n:].tolist()))
        due = ts[n] if n < len(ts) else start + span
        state.setTimeoutTimestamp(max(int(due) // 1000 - 1, wm + 1))
    return fn


def rate_flags(events: DataFrame, cfg: Config = DEFAULT, limit: int | None = None,
               window_s: int | None = None, late_delay: str | None = "default") -> DataFrame:
    """Per key a fixed window opens at the first hit and lasts
    ``window_s``; a hit is flagged when the count in its window exceeds
    ``limit``.

    Hits wait in the key's state until the watermark (``late_delay``, default
    ``cfg.rate_late_delay``) has passed them, and are then counted in
    (ts, event_id) order, however they were split into files, micro-batches and
    Arrow batches. The state holds the hits of the delay and one open window,
    and times out with it. With ``late_delay=None`` hits are counted as they
    arrive, in (ts, event_id) order inside a micro-batch, and the state keeps
    two numbers for every user ever seen."""
    lim = limit if limit is not None else cfg.rate_limit_per_minute
    win = window_s if window_s is not None else cfg.rate_window_seconds
    delay = cfg.rate_late_delay if late_delay == "default" else late_delay
    if delay is not None:
        events = events.withWatermark("ts", delay)
    return (events.select("event_id", "user_id", "ts", F.unix_micros("ts").alias("ts_us"))
            .groupBy("user_id")
            .applyInPandasWithState(_rate_fn(win, delay is not None), RATE_OUT, RATE_STATE,
                                    "append", "EventTimeTimeout" if delay else "NoTimeout")
            .select("event_id", "user_id", F.timestamp_micros("ts_us").alias("ts"),
                    F.timestamp_micros("window_start_us").alias("window_start"), "hits",
                    (F.col("hits") > lim).alias("flagged")))


# --- X5: late and duplicate events --------------------------------------------------

def deduplicated(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated ``event_id`` within the watermark; rows later than the
    watermark are dropped by the stateful operator."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


# --- X6: streaming scoring to the log ---------------------------------------------------

def scored_stream(model, stream: DataFrame, text_col: str, key_cols: list[str],
                  model_version: str, cfg: Config = DEFAULT, batch_id: str = "stream") -> DataFrame:
    """Every row-local model stage applies to a stream unchanged. The rows
    are prediction-log rows (S8), like those of a batch. Texts outside the
    admissible lengths are ``rejected_stream``'s."""
    from ..operators.model import log_rows, predict
    s = predict(model, stream.where(F.char_length(text_col).between(1, cfg.max_text_length)), text_col)
    return log_rows(s, text_col, key_cols, model_version, cfg.registry_name, cfg.as_of, batch_id)


def rejected_stream(stream: DataFrame, text_col: str, key_cols: list[str], cfg: Config = DEFAULT) -> DataFrame:
    """The quarantine side of X6/V12: keys and lengths of texts that are not scored."""
    n = F.char_length(text_col)
    return stream.where(~F.coalesce(n.between(1, cfg.max_text_length), F.lit(False))).select(
        *key_cols, n.alias("input_length"),
        F.when(n.isNull(), "null text").when(n < 1, "empty text").otherwise("text too long").alias("reason"))


# --- X2 (full): sliding-window drift computed per micro-batch ----------------------

def drift_on_closed_windows(events: DataFrame, reference_counts: DataFrame, features: list[str],
                            name: str, source: str, cfg: Config = DEFAULT,
                            delay: str = "1 day", resume: str | None = None,
                            allow_late: bool = False) -> tuple[DataFrame, DataFrame]:
    """X2 -> R1/R2/R4 in ``foreachBatch``.

    The stream counts (7-day window sliding by 1 day, feature, category); a
    window closes when the watermark passes its end, and its end is the
    report date (current window ``[d - 7 days, d)``, as in the batch job).
    Each micro-batch aligns its closed windows with the reference counts
    (``feature, category, ref_n``; written once, read by every batch), scores
    them and writes reports and alerts under ``batch=<epoch>`` with
    overwrite, so a replayed epoch rewrites rather than duplicates.
    Returns the reports and alerts written (no rows if no window closed).
    """
    from ..operators import alerts as AL
    from ..operators import drift as D
    from ..sources import views as V

    spark = events.sparkSession
    p = V.profile_from_predictions(V.predictions_from_events(events, cfg, extra=("event_type",)))
    long = D.stack_features(p, features, ["created_at"])
    win = f"{cfg.drift_window_days} days"
    counts = (long.withWatermark("created_at", delay)
              .groupBy(F.window("created_at", win, "1 day").alias("w"), "feature", "category")
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.to_date(F.col("w.end")).alias("report_date"), "feature", "category", "n"))
    ckpt, out_root = _location(spark, name, source, resume)
    ref_path = f"{out_root}/reference"
    reference_counts.select("feature", "category", "ref_n").write.mode("overwrite").parquet(ref_path)
    ref = spark.read.parquet(ref_path)
    reports_path, alerts_path = f"{out_root}/drift_reports", f"{out_root}/alerts"

    def scored(cur: DataFrame, dates: list) -> tuple[DataFrame, DataFrame]:
        # reference categories x closed windows of this batch
        ref_rows = ref.select(F.explode(F.array(*[F.lit(d) for d in dates])).alias("report_date"),
                              "feature", "category", "ref_n", F.lit(0).cast("bigint").alias("cur_n"))
        cur_rows = cur.select("report_date", "feature", "category",
                              F.lit(0).cast("bigint").alias("ref_n"), F.col("n").alias("cur_n"))
        aligned = (ref_rows.unionByName(cur_rows).groupBy("report_date", "feature", "category")
                   .agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n")))
        dist = D._distances(aligned, cfg.drift_threshold, ["report_date", "feature"])
        reports = D.reports_from_distances(dist, cfg)
        return reports, AL.alerts_from_reports(reports, cfg)

    def score(batch: DataFrame, epoch: int) -> None:
        cur = batch.where(F.col("report_date") >= F.lit(cfg.reference_end)).persist()
        try:
            dates = [r[0] for r in cur.select("report_date").distinct().collect()]  # windows closed in this batch
            if dates:
                reports, _ = scored(cur, dates)
                reports.write.mode("overwrite").parquet(f"{reports_path}/batch={epoch}")
                written = spark.read.schema(reports.schema).parquet(f"{reports_path}/batch={epoch}")
                AL.alerts_from_reports(written, cfg).write.mode("overwrite").parquet(f"{alerts_path}/batch={epoch}")
        finally:
            cur.unpersist()

    finish(lambda: counts.writeStream.outputMode("append").option("checkpointLocation", ckpt)
           .foreachBatch(score).trigger(availableNow=True).start(), allow_late)
    none = spark.createDataFrame([], "report_date date, feature string, category string, n bigint")
    shapes = scored(none, [cfg.reference_end])
    return tuple(_read_or_empty(spark, p, d.schema) for p, d in zip((reports_path, alerts_path), shapes))


def _read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """The sink folder, or an empty frame when no micro-batch has written it."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
