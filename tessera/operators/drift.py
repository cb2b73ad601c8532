"""Drift scoring.

The daily job of the reference compares a trailing window of the prediction
log with a reference profile. Here every report date is computed in one job:

1. the log is stacked to ``(day, feature, category)`` and counted per day
   (map-side combined, so output size is days x categories, not rows);
2. each day's counts are expanded to the report dates whose window covers
   it (``sequence`` + ``explode``; no range join), the reference counts to
   every report date;
3. one ``groupBy(report_date, feature, category)`` aligns reference and
   current categories (the full outer union of N1 without a join);
4. shares, total-variation distance, Jensen-Shannon divergence and PSI are
   sums over that small table.
"""

from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.common import date_lit, det_id
from ..functions.text import as_category
from ..session import cut_lineage

EXCLUDED = ("created_at", "timestamp")
PSI_EPS = 1e-4


def comparable_features(reference: DataFrame, current: DataFrame) -> list[str]:
    """P5: columns in both frames, minus timestamps, in reference order."""
    cur = set(current.columns)
    return [c for c in reference.columns if c in cur and c not in EXCLUDED]


def stack_features(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Long form ``(*keep, feature, category)``; values as text."""
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), as_category(f).alias("category"))
                    for f in features])
    return df.select(*keep, F.explode(arr).alias("_fc")).select(*keep, "_fc.feature", "_fc.category")


def _report_dates(first: date, last: date) -> Column:
    return F.sequence(date_lit(first), date_lit(last))


def aligned_counts(daily: DataFrame, key, ref_end: date, first: date, last: date,
                   window_days: int) -> DataFrame:
    """``(report_date, <key...>, ref_n, cur_n)`` for every report date, in one pass.

    ``daily`` has ``day``, the key columns and ``n``. The current window of
    report date d is ``[d - window_days, d)``; the reference is every day
    before ``ref_end``. Each daily row is exploded to the ``window_days`` report
    dates it serves, the summed reference to all of them, then one aggregate
    sums both sides.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lo = first - timedelta(days=window_days)
    # One scan: a daily row counts for the reference (no day) and for its own
    # day; the reference is summed to one row a category before it is exploded.
    use = F.array_compact(F.array(
        F.when(F.col("day") < date_lit(ref_end), F.struct(F.lit(None).cast("date").alias("day"), F.lit(True).alias("ref"))),
        F.when((F.col("day") >= date_lit(lo)) & (F.col("day") < date_lit(last)),
               F.struct(F.col("day"), F.lit(False).alias("ref")))))
    sums = (daily.select(F.explode(use).alias("u"), *keys, "n")
            .groupBy(F.col("u.day").alias("day"), F.col("u.ref").alias("ref"), *keys).agg(F.sum("n").alias("n")))
    served = F.sequence(F.greatest(F.date_add("day", 1), date_lit(first)),
                        F.least(F.date_add("day", window_days), date_lit(last)))
    x = sums.select(F.explode(F.when(F.col("ref"), _report_dates(first, last)).otherwise(served)).alias("report_date"),
                    "ref", *keys, "n")
    return (x.groupBy("report_date", *keys)
            .agg(F.sum(F.when(F.col("ref"), F.col("n")).otherwise(0)).cast("bigint").alias("ref_n"),
                 F.sum(F.when(~F.col("ref"), F.col("n")).otherwise(0)).cast("bigint").alias("cur_n")))


def _distances(aligned: DataFrame, threshold: float, group: list[str]) -> DataFrame:
    w = Window.partitionBy(*group)
    a = (aligned.withColumn("ref_tot", F.sum("ref_n").over(w))
         .withColumn("cur_tot", F.sum("cur_n").over(w))
         .where(F.col("cur_tot") > 0)
         .withColumn("p", F.try_divide(F.col("ref_n").cast("double"), F.col("ref_tot")))
         .withColumn("q", F.try_divide(F.col("cur_n").cast("double"), F.col("cur_tot"))))
    m = (F.col("p") + F.col("q")) / 2
    kl_p = F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(0.0)
    kl_q = F.when(F.col("q") > 0, F.col("q") * F.log(F.col("q") / m)).otherwise(0.0)
    # Homogeneity of the two samples over the categories of either.
    gap = (F.col("ref_n") * F.sqrt(F.col("cur_tot") / F.col("ref_tot"))
           - F.col("cur_n") * F.sqrt(F.col("ref_tot") / F.col("cur_tot")))
    chi = F.when(F.col("ref_tot") > 0, gap * gap / (F.col("ref_n") + F.col("cur_n")))
    pe, qe = F.greatest("p", F.lit(PSI_EPS)), F.greatest("q", F.lit(PSI_EPS))
    return (a.groupBy(*group)
            .agg((F.sum(F.abs(F.col("p") - F.col("q"))) / 2).alias("distance"),
                 (F.sum(kl_p + kl_q) / 2).alias("js_divergence"),
                 F.sum((qe - pe) * F.log(qe / pe)).alias("psi"),
                 F.sum(chi).alias("chi_square"),
                 F.first("ref_tot").alias("reference_size"),
                 F.first("cur_tot").alias("current_size"))
            .withColumn("drifted", F.col("distance") > F.lit(threshold)))


def daily_category_counts(profile: DataFrame, features: list[str], day_col: str = "day") -> DataFrame:
    long = stack_features(profile, features, [day_col])
    return (long.groupBy(F.col(day_col).alias("day"), "feature", "category")
            .agg(F.count(F.lit(1)).alias("n")))


def feature_distances(profile: DataFrame, features: list[str], cfg: Config = DEFAULT,
                      first: date | None = None, last: date | None = None) -> DataFrame:
    """R1 for every report date: one row per (report_date, feature)."""
    first = first or cfg.reference_end
    last = last or cfg.as_of.date()
    daily = daily_category_counts(profile, features)
    al = aligned_counts(daily, ["feature", "category"], cfg.reference_end, first, last,
                        cfg.drift_window_days)
    return _distances(al, cfg.drift_threshold, ["report_date", "feature"])


def reports_from_distances(dist: DataFrame, cfg: Config = DEFAULT, mode: str = "fallback",
                           prediction_feature: str = "predicted_sentiment") -> DataFrame:
    """One drift report row per report date.

    score = share of drifted features. ``mode="fallback"`` flags dataset
    drift when score > threshold; ``mode="preset"`` when score > 0 (the two
    rules of the reference).
    """
    drifted = F.sum(F.col("drifted").cast("int"))
    n = F.count(F.lit(1))
    details = F.to_json(F.map_from_entries(F.collect_list(F.struct(
        "feature", F.struct("distance", F.col("drifted").alias("drift_detected"))))))
    r = dist.groupBy("report_date").agg(
        drifted.alias("features_drifted"),
        F.greatest(n, F.lit(1)).alias("total_features"),
        F.max(F.when(F.col("feature") == prediction_feature, F.col("drifted"))).alias("_pd"),
        F.max("reference_size").alias("reference_size"),
        F.max("current_size").alias("current_size"),
        details.alias("details"))
    # A report without a reference is an error, whatever date it is for.
    sized = F.when(F.coalesce("reference_size", F.lit(0)) > 0, F.col("features_drifted")).otherwise(
        F.raise_error(F.lit("Reference dataset is empty.")).cast("bigint"))
    r = r.withColumn("features_drifted", sized)
    score = F.col("features_drifted") / F.col("total_features")
    dd = score > F.lit(cfg.drift_threshold) if mode == "fallback" else score > F.lit(0.0)
    return r.select(
        det_id(F.lit("drift"), F.col("report_date")).alias("id"),
        "report_date",
        dd.alias("dataset_drift_detected"),
        score.alias("drift_score"),
        F.col("features_drifted").cast("int").alias("features_drifted"),
        F.col("total_features").cast("int").alias("total_features"),
        F.coalesce(F.col("_pd"), F.lit(False)).alias("prediction_drift_detected"),
        F.col("reference_size").cast("int").alias("reference_size"),
        F.col("current_size").cast("int").alias("current_size"),
        F.concat(F.lit("drift_reports/report_date="), F.col("report_date").cast("string"))
         .alias("report_path"),
        "details",
        F.col("report_date").cast("timestamp_ntz").alias("created_at"))


def drift_reports(profile: DataFrame, features: list[str], cfg: Config = DEFAULT,
                  mode: str = "fallback") -> DataFrame:
    """The daily drift run backfilled for every report date at once."""
    return reports_from_distances(feature_distances(profile, features, cfg), cfg, mode)


def ks_backfill(df: DataFrame, value_col: str, day_col: str = "day", cfg: Config = DEFAULT,
                first: date | None = None, last: date | None = None, partitions: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per report date, of values of any kind.

    D = max over distinct values of |F_ref(x) - F_cur(x)|, from cumulative counts. The log
    is counted by (day, value), the reference by value alone, and the counts are dealt by
    ranges of the value, of about equally many counts each. A row is sent once, whatever
    the number of report dates: a task goes through its range in order, adds up the
    counts of each day, and takes the window of a report date as the difference of two running
    sums over the days. What lies before a range comes from totals by (range, day).
    Nulls are one value, before all others.
    """
    first = first or cfg.reference_end
    last = last or cfg.as_of.date()
    lo, days = first - timedelta(days=cfg.drift_window_days), (last - first).days + cfg.drift_window_days
    day = F.date_diff(F.col(day_col), date_lit(lo))
    served = (day >= 0) & (day < days)
    # slot 0 is the reference, slot d + 1 the d-th day that some report date's window has
    use = F.array_compact(F.array(F.when(F.col(day_col) < date_lit(cfg.reference_end), F.lit(0)), F.when(served, day + 1)))
    counts = (df.select(F.col(value_col).alias("value"), F.explode(use).alias("slot"))
              .groupBy("value", "slot").agg(F.count(F.lit(1)).alias("n")))
    dealt = counts.repartitionByRange(partitions, "value") if partitions else counts.repartitionByRange("value")
    dealt = cut_lineage(dealt.withColumn("_pid", F.spark_partition_id()), "ks-counts")
    sums = dealt.groupBy("_pid", "slot").agg(F.sum("n").alias("n"))  # one row a range and day
    totals = dict(sums.groupBy("slot").agg(F.sum("n").alias("n")).collect())  # one row a day
    if not totals.get(0):
        raise ValueError("Reference dataset is empty.")
    before = Window.partitionBy("slot").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slots = F.explode(F.array(*[F.lit(s) for s in sorted(totals)])).alias("slot")
    grid = sums.select("_pid").distinct().select("_pid", slots).join(sums, ["_pid", "slot"], "left")
    carry = grid.select("_pid", F.lit(0).alias("kind"), F.lit(None).cast(dealt.schema["value"].dataType).alias("value"), "slot",
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    rows = dealt.select("_pid", F.lit(1).alias("kind"), "value", "slot", "n").unionByName(carry)
    rows = rows.repartition("_pid").sortWithinPartitions("_pid", "kind", F.col("value").asc_nulls_first())
    gaps = rows.mapInArrow(_ks_gaps(totals, days, cfg.drift_window_days), "date int, gap double")
    sizes = _window_sums(np.array([[totals.get(i, 0) for i in range(days + 1)]], np.float64), cfg.drift_window_days)[0]
    sizes = [(first + timedelta(days=i), totals[0], int(n)) for i, n in enumerate(sizes) if n]
    sizes = df.sparkSession.createDataFrame(sizes, "report_date date, reference_size long, current_size long")  # a row a date
    found = gaps.groupBy("date").agg(F.max("gap").alias("ks_statistic")).withColumn(
        "report_date", F.date_add(date_lit(first), F.col("date")))
    return found.join(F.broadcast(sizes), "report_date").select(
        "report_date", "ks_statistic", "reference_size", "current_size")


def _window_sums(slots: np.ndarray, window: int) -> np.ndarray:
    """Counts by (row, slot) -> counts of the window of each report date: the ``window``
    days before it. The first date's window is days 0 to ``window - 1``."""
    upto = np.concatenate([np.zeros((len(slots), 1)), np.cumsum(slots[:, 1:], axis=1)], axis=1)
    return upto[:, window:] - upto[:, :upto.shape[1] - window]


def _ks_gaps(totals: dict, days: int, window: int, block: int = 1024):
    """Rows of a range in order of the value -> greatest gap of each report date."""
    size = np.array([totals.get(i, 0) for i in range(days + 1)], np.float64)
    current = _window_sums(size[None], window)[0]

    def best(slots, base):
        """Gaps at the values whose counts by slot are ``slots``, after those of ``base``."""
        upto = base + np.cumsum(slots, axis=0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gap = np.abs(upto[:, :1] / size[0] - _window_sums(upto, window) / current)
        return np.nanmax(np.where(np.isfinite(gap), gap, 0.0), axis=0), upto[-1]

    def rows(batches):
        pid, value, base, held, found = None, object(), None, [], np.zeros(len(current))

        def close():
            nonlocal held, base, found
            if held:
                gap, base = best(np.array(held), base)
                found, held = np.maximum(found, gap), []

        for batch in batches:
            for p, kind, v, slot, n in zip(*[batch.column(c).to_pylist() for c in ("_pid", "kind", "value", "slot", "n")]):
                if p != pid:
                    close()
                    pid, value, base = p, object(), np.zeros(days + 1)
                if not kind:  # what lies before the range
                    base[slot] = n
                    continue
                if v != value:
                    if len(held) >= block:
                        close()
                    value = v
                    held.append(np.zeros(days + 1))
                held[-1][slot] += n
        close()
        at = np.flatnonzero(current > 0)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], names=["date", "gap"])
    return rows


def require_rows(reference: DataFrame, current: DataFrame) -> None:
    """R2's precondition: both sides have a row."""
    for side, df in (("Reference", reference), ("Current", current)):
        if df.limit(1).count() == 0:
            raise ValueError(f"{side} dataset is empty.")


def detect_drift(reference: DataFrame, current: DataFrame, cfg: Config = DEFAULT,
                 features: list[str] | None = None, mode: str = "fallback"):
    """R1/R2 for two frames (the reference's single-run form).

    Returns ``(distances, report)``; both are one-shot DataFrames tagged
    with ``report_date`` = the date of ``cfg.as_of``.
    """
    feats = features or comparable_features(reference, current)
    if not feats:
        raise ValueError("No comparable features between reference and current data.")
    require_rows(reference, current)
    rd = cfg.as_of.date()
    r = stack_features(reference, feats, []).withColumn("_side", F.lit(0))
    c = stack_features(current, feats, []).withColumn("_side", F.lit(1))
    al = (r.unionByName(c).groupBy("feature", "category")
          .agg(F.sum((F.col("_side") == 0).cast("long")).alias("ref_n"),
               F.sum((F.col("_side") == 1).cast("long")).alias("cur_n"))
          .withColumn("report_date", date_lit(rd)))
    dist = _distances(al, cfg.drift_threshold, ["report_date", "feature"])
    return dist, reports_from_distances(dist, cfg, mode)
