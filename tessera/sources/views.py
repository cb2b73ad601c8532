"""Derived views over the test tables (FIXTURES.md, "Views to derive").

Each view is a lazy DataFrame over a parquet scan, so filters and column
pruning of the queries above reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.common import det_id
from ..operators.ordered import exact_rank
from .tables import Tables


def reviews(t: Tables) -> DataFrame:
    """documents joined with labels; ``label = quality``."""
    return (t.documents.select("doc_id", "text")
            .join(t.labels.select("doc_id", F.col("quality").alias("label")), "doc_id"))


def truth_pred(t: Tables) -> DataFrame:
    """Truth (labels) joined with a prediction made from another table
    (documents: long texts count as good) on the document."""
    truth = t.labels.select("doc_id", F.col("quality").alias("y_true"))
    pred = t.documents.select("doc_id", (F.col("n_chars") > 1000).cast("int").alias("y_pred"))
    return truth.join(pred, "doc_id")


def predictions(t: Tables, cfg: Config = DEFAULT, extra: tuple[str, ...] = ()) -> DataFrame:
    """The prediction log derived from ``events`` (with a planted drift)."""
    return predictions_from_events(t.events, cfg, extra)


def predictions_from_events(e: DataFrame, cfg: Config = DEFAULT,
                            extra: tuple[str, ...] = ()) -> DataFrame:
    """Row-local derivation, so it applies to a batch or a stream of events."""
    k = F.col("event_id") * F.lit(7919)
    return e.select(
        F.col("event_id").alias("id"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("input_text_hash"),
        (F.floor("value") + 1).cast("int").alias("input_length"),
        F.when(k % 100 < F.lit(40) + F.dayofmonth("ts"), F.lit("positive"))
         .otherwise(F.lit("negative")).alias("predicted_sentiment"),
        ((k % 5000 + 5000).cast("decimal(10,0)") / F.lit(10000))
        .cast("decimal(5,4)").alias("confidence"),
        (F.col("user_id") % 3 + 1).cast("string").alias("model_version"),
        F.lit(cfg.registry_name).alias("model_name"),
        F.round("value").cast("int").alias("latency_ms"),
        F.col("ts").alias("created_at"),
        *[F.col(c) for c in extra],
    )


PROFILE_FEATURES = ("predicted_sentiment", "confidence_bucket", "model_version",
                    "length_bucket", "event_type")


def profile(t: Tables, cfg: Config = DEFAULT) -> DataFrame:
    """Five categorical features per prediction, as text, with its day."""
    return profile_from_predictions(predictions(t, cfg, extra=("event_type",)))


def profile_from_predictions(p: DataFrame) -> DataFrame:
    """Row-local: the five profile features of prediction rows (batch or stream)."""
    return p.select(
        "id", "created_at", F.to_date("created_at").alias("day"),
        "predicted_sentiment",
        F.floor(F.col("confidence") * 10).cast("int").cast("string").alias("confidence_bucket"),
        "model_version",
        F.least(F.floor(F.col("input_length") / 50), F.lit(4)).cast("bigint").cast("string")
         .alias("length_bucket"),
        "event_type",
    )


def run_events(t: Tables) -> DataFrame:
    """Append-only run lifecycle events: view = start, purchase/error = finish."""
    e = t.events.where(F.col("event_type").isin("view", "purchase", "error"))
    return e.select(
        "event_id",
        (F.col("user_id") % 2).cast("string").alias("dag_id"),
        F.col("user_id").cast("string").alias("run_id"),
        F.when(F.col("event_type") == "view", "start")
         .when(F.col("event_type") == "purchase", "success")
         .otherwise("failed").alias("kind"),
        F.col("ts").alias("evt_at"),
        F.col("props").alias("metrics"),
    )


def runs(t: Tables) -> DataFrame:
    """Experiment runs derived from ``part``; metrics as MAP<STRING,DOUBLE>."""
    p = t.part
    f1 = (F.col("p_partkey") * 7919 % 1000) / F.lit(1000.0)
    acc = F.col("p_size") / F.lit(50.0)
    return p.select(
        F.col("p_type").alias("experiment"),
        F.md5(F.col("p_partkey").cast("string")).alias("run_id"),
        F.col("p_partkey").alias("position"),
        F.lit(None).cast("string").alias("run_name_tag"),
        F.lit("FINISHED").alias("status"),
        (F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")
         + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("p_partkey").cast("decimal(18,6)")))
        .alias("start_time"),
        F.create_map(F.lit("f1_macro"), f1, F.lit("accuracy"), acc).alias("metrics"),
    )


def model_versions(t: Tables, cfg: Config = DEFAULT) -> DataFrame:
    """Registered versions: runs numbered by p_partkey within experiment.

    The numbering is an exact row_number computed with bucketed offsets so a
    hot experiment does not land in one task (see ``exact_rank``).
    """
    r = runs(t).withColumn("_bucket", F.floor(F.col("position") / 4096))
    v = exact_rank(r, ["experiment"], ["position"], "_bucket", "version")
    return v.select(
        F.col("experiment").alias("name"),
        F.col("version").cast("bigint").alias("version"),
        "run_id",
        F.col("start_time").alias("registered_at"),
        F.lit(True).alias("has_metrics"),
        F.col("metrics")["f1_macro"].alias("f1_macro"),
        F.col("metrics")["accuracy"].alias("accuracy"),
        # Registry tags as text; every fifth run registered without tags so
        # the lookup falls back to the run's metrics (J6), which differ.
        F.when(F.col("position") % 5 == 0, F.create_map().cast("map<string,string>"))
         .otherwise(F.create_map(F.lit("f1_macro"), (F.col("metrics")["f1_macro"] / 2).cast("string"),
                                 F.lit("accuracy"), (F.col("metrics")["accuracy"] / 4).cast("string")))
         .alias("tags"),
    )


def logits(t: Tables) -> DataFrame:
    """Class scores: all components of the embedding."""
    return t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("scores"))


def scoring_input(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", "text")


def drift_report_id(report_date_col) -> F.Column:
    return det_id(F.lit("drift"), report_date_col)
