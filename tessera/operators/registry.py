"""Experiment and registry ledgers.

The registry's mutable stages become a pure function of the ordered version
history of each model: Production F1 is the running maximum of F1 over
earlier versions that carry metrics, so the promotion decision of every
version is a windowed comparison (a segmented scan over ranges of (model, version)).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import Ranged, neighbours, running_max_before

# Fixed metric keys (must equal the reference's).
TAG_KEYS = ("f1_macro", "accuracy", "precision_macro", "recall_macro")
# Leaderboard columns and the metric each reads (0 when absent).
ROW_METRICS = (("f1", "f1_macro"), ("accuracy", "accuracy"), ("precision", "precision_macro"),
               ("recall", "recall_macro"), ("latency", "inference_latency_ms"),
               ("duration", "training_time"))


def is_better(new_f1: Column, current_f1: Column, current_has_metrics: Column) -> Column:
    """K8 gate: promote when there are no current metrics, else strictly greater F1."""
    return (~F.coalesce(current_has_metrics, F.lit(False))) | (
        F.coalesce(new_f1, F.lit(0.0)) > F.coalesce(current_f1, F.lit(0.0)))


def promotion_ledger(versions: DataFrame) -> DataFrame:
    """Decision and final stage of every registered version.

    Input: ``name, version, has_metrics, f1_macro`` (+ any columns).
    ``promoted`` = no earlier version has metrics, or F1 > the running max of
    F1 over earlier versions with metrics. The last promoted version of a
    model is Production, earlier promoted ones Archived, the rest Staging.
    """
    val = F.when(F.col("has_metrics"), F.coalesce(F.col("f1_macro"), F.lit(0.0)))
    r = running_max_before(Ranged.of(versions, ["name"], ["version"]), val, "_prod_f1").rows
    promoted = F.col("_prod_f1").isNull() | (F.coalesce(F.col("f1_macro"), F.lit(0.0)) > F.col("_prod_f1"))
    r = r.withColumn("promoted", promoted)
    last = (r.where("promoted").groupBy("name").agg(F.max("version").alias("_last_prod")))
    r = r.join(last, "name", "left")
    stage = (F.when(F.col("version") == F.col("_last_prod"), "Production")
             .when(F.col("promoted"), "Archived").otherwise("Staging"))
    return r.select(
        *[c for c in versions.columns],
        "promoted",
        F.coalesce(F.col("_prod_f1"), F.lit(0.0)).alias("old_f1"),
        F.coalesce(F.col("f1_macro"), F.lit(0.0)).alias("new_f1"),
        F.when(F.col("promoted"), "Production").otherwise("Staging").alias("decision_stage"),
        stage.alias("stage"))


def current_versions(ledger: DataFrame) -> DataFrame:
    """Newest version per (model, stage); Production has at most one."""
    return (ledger.groupBy("name", "stage")
            .agg(F.max_by(F.struct("version", "run_id"), "version").alias("v"))
            .select("name", "stage", "v.version", "v.run_id"))


def production(ledger: DataFrame, name: str) -> tuple[str | None, float | None]:
    """A1: version and F1 of the newest Production version of ``name``, if any."""
    row = (ledger.where((F.col("name") == name) & (F.col("stage") == "Production"))
           .agg(F.max_by(F.struct("version", "new_f1"), "version").alias("v")).first()["v"])
    return (None, None) if row is None else (str(row["version"]), row["new_f1"])


def deployment_history(ledger: DataFrame) -> DataFrame:
    """Promoted versions with deployed/replaced times and the active flag."""
    p = (ledger.where("promoted")
         .select("name", "version", "run_id", "new_f1", "accuracy",
                 F.col("registered_at").alias("deployed_at")))
    n = neighbours(Ranged.of(p, ["name"], ["version"]), ["deployed_at"]).rows
    return n.select(F.col("name").alias("model_name"), F.col("version").alias("model_version"),
                    F.col("run_id"), F.col("new_f1").alias("f1_score"), "accuracy",
                    "deployed_at", F.col("next_deployed_at").alias("replaced_at"),
                    F.col("next_deployed_at").isNull().alias("is_active"))


def version_metrics(versions: DataFrame, runs: DataFrame) -> DataFrame:
    """Metric tags as floats; when a version has none of the four
    tags, the metrics of its run (left join on run id)."""
    tags = F.map_filter("tags", lambda k, v: k.isin(*TAG_KEYS))
    rm = runs.select(F.col("run_id").alias("_rid"), F.col("metrics").alias("_run_metrics"))
    j = versions.join(rm, versions["run_id"] == rm["_rid"], "left").drop("_rid")
    as_float = F.transform_values(tags, lambda k, v: v.try_cast("double"))
    m = F.when(F.size(tags) > 0, as_float).otherwise(F.col("_run_metrics"))
    return j.withColumn("metrics", m).drop("_run_metrics")


def metric_row(metrics: Column) -> list[Column]:
    """The leaderboard's metric columns with 0 defaults."""
    return [F.coalesce(F.try_element_at(metrics, F.lit(k)), F.lit(0.0)).alias(name)
            for name, k in ROW_METRICS]


def experiment_runs(runs: DataFrame, experiments: DataFrame | None = None,
                    per_experiment: int = 50) -> DataFrame:
    """Each experiment's newest ``per_experiment`` runs.

    ``row_number() <= k`` is planned with WindowGroupLimit, which keeps k
    rows per experiment before and after the shuffle (skew-safe).
    """
    r = runs
    if experiments is not None:
        r = r.join(experiments, "experiment")
    w = Window.partitionBy("experiment").orderBy(F.col("start_time").desc(), F.col("run_id"))
    top = r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_experiment)
    return top.select(
        "run_id",
        F.coalesce(F.col("run_name_tag"), F.substring("run_id", 1, 8)).alias("run_name"),
        "experiment", "status", "start_time", *metric_row(F.col("metrics")))


def leaderboard(rows: DataFrame, key: str = "f1", ascending: bool = False) -> DataFrame:
    """T5: runs ordered by any column, either direction; ties by run id."""
    c = F.col(key).asc() if ascending else F.col(key).desc()
    return rows.orderBy(c, F.col("run_id"))


def best_candidate(candidates: DataFrame, group: str = "experiment") -> DataFrame:
    """Per group the max ``f1_macro`` (missing = 0); the first listed
    candidate (lowest ``position``) wins ties; also echoes the count."""
    f1 = F.coalesce(F.try_element_at(F.col("metrics"), F.lit("f1_macro")), F.lit(0.0))
    c = candidates.withColumn("_f1", f1)
    order = F.struct(F.col("_f1"), (-F.col("position")).alias("_p"))
    return c.groupBy(group).agg(
        F.max_by(F.struct("run_id", "_f1"), order).alias("w"),
        F.count(F.lit(1)).alias("n_candidates")).select(
        group, F.col("w.run_id").alias("winner_run_id"), F.col("w._f1").alias("winner_f1"),
        "n_candidates")


def first_with_prefix(candidates: DataFrame, prefix: str, group: str = "experiment",
                      type_col: str = "model_type", value_col: str = "f1") -> DataFrame:
    """per group, the value of the first candidate whose type starts with ``prefix``."""
    c = candidates.where(F.col(type_col).startswith(prefix))
    return c.groupBy(group).agg(F.min_by(value_col, "position").alias(f"{prefix}_{value_col}"))


def candidate_comparison(candidates: DataFrame, group: str = "experiment") -> DataFrame:
    """The candidates as they were compared, one row each, winner marked."""
    best = best_candidate(candidates, group).select(F.col(group).alias("_g"), "winner_run_id")
    m = F.col("metrics")
    return (candidates.join(best, candidates[group] == best["_g"])
            .select(group, "run_id", F.try_element_at(m, F.lit("f1_macro")).alias("f1_macro"),
                    F.try_element_at(m, F.lit("accuracy")).alias("accuracy"),
                    (F.col("run_id") == F.col("winner_run_id")).alias("is_winner")))


def pipeline_summary(candidates: DataFrame, ledger: DataFrame, group: str = "experiment") -> DataFrame:
    """winner's type, the first candidate's F1 of each model family
    (null without one) and the registry's decision on the winner."""
    f1 = F.coalesce(F.try_element_at(F.col("metrics"), F.lit("f1_macro")), F.lit(0.0))
    c = candidates.withColumn("f1", f1)
    best = F.max_by(F.struct("model_type", "run_id"), F.struct("f1", (-F.col("position")).alias("p")))
    w = c.groupBy(group).agg(best.alias("w")).select(group, F.col("w.model_type").alias("winner"), F.col("w.run_id").alias("_run"))
    for prefix in ("baseline", "distilbert"):
        w = w.join(first_with_prefix(c, prefix, group), group, "left")
    decided = ledger.select(F.col("name").alias("_n"), F.col("run_id").alias("_r"), "promoted")
    j = w.join(decided, (w[group] == decided["_n"]) & (w["_run"] == decided["_r"]), "left")
    return j.select(group, "winner", "baseline_f1", F.col("distilbert_f1").alias("transformer_f1"), "promoted")
