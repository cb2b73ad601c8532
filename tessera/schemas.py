"""Schemas of the persistent log tables and the constraint operator (V9).

Parquet does not enforce NOT NULL / CHECK / VARCHAR(n) / NUMERIC(p,s), so
``check_constraints`` evaluates them as one projection: each row gets the
array of violated rules, then ``split_valid`` routes rows to ``valid`` or to
a quarantine frame carrying the reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREDICTIONS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("input_text_hash", T.StringType(), False),
    T.StructField("input_length", T.IntegerType(), False),
    T.StructField("predicted_sentiment", T.StringType(), False),
    T.StructField("confidence", T.DecimalType(5, 4), False),
    T.StructField("model_version", T.StringType(), False),
    T.StructField("model_name", T.StringType(), False),
    T.StructField("latency_ms", T.IntegerType(), False),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

DRIFT_REPORTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("report_date", T.DateType(), False),
    T.StructField("dataset_drift_detected", T.BooleanType(), False),
    T.StructField("drift_score", T.DecimalType(5, 4), False),
    T.StructField("features_drifted", T.IntegerType(), False),
    T.StructField("total_features", T.IntegerType(), False),
    T.StructField("prediction_drift_detected", T.BooleanType(), False),
    T.StructField("reference_size", T.IntegerType(), False),
    T.StructField("current_size", T.IntegerType(), False),
    T.StructField("report_path", T.StringType(), True),
    T.StructField("details", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

ALERTS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("alert_type", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("message", T.StringType(), False),
    T.StructField("is_resolved", T.BooleanType(), True),
    T.StructField("resolved_at", T.TimestampNTZType(), True),
    T.StructField("metadata", T.StringType(), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
])

RUN_HISTORY = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("dag_id", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("started_at", T.TimestampNTZType(), False),
    T.StructField("completed_at", T.TimestampNTZType(), True),
    T.StructField("duration_seconds", T.IntegerType(), True),
    T.StructField("metrics", T.StringType(), True),
])

# Fixed values of the CHECK constraints.
ALERT_TYPES = ("drift_warning", "drift_critical", "model_degradation", "latency_spike",
               "pipeline_failure")
SEVERITIES = ("info", "warning", "critical")
RUN_STATUSES = ("running", "success", "failed")

# (column, rule) pairs: "notnull", ("varchar", n), ("numeric", p, s), ("in", values)
RULES = {
    "predictions": [
        ("id", "notnull"), ("input_text_hash", "notnull"), ("input_text_hash", ("varchar", 64)),
        ("input_length", "notnull"), ("predicted_sentiment", "notnull"),
        ("predicted_sentiment", ("varchar", 10)), ("confidence", "notnull"),
        ("confidence", ("numeric", 5, 4)), ("model_version", "notnull"),
        ("model_version", ("varchar", 100)), ("model_name", "notnull"),
        ("model_name", ("varchar", 100)), ("latency_ms", "notnull"),
    ],
    "alerts": [
        ("alert_type", "notnull"), ("alert_type", ("varchar", 30)),
        ("alert_type", ("in", ALERT_TYPES)), ("severity", "notnull"),
        ("severity", ("varchar", 10)), ("severity", ("in", SEVERITIES)), ("message", "notnull"),
    ],
    "drift_reports": [
        ("report_date", "notnull"), ("dataset_drift_detected", "notnull"), ("drift_score", "notnull"),
        ("drift_score", ("numeric", 5, 4)), ("features_drifted", "notnull"), ("total_features", "notnull"),
        ("prediction_drift_detected", "notnull"), ("reference_size", "notnull"), ("current_size", "notnull"),
        ("report_path", ("varchar", 500)),
    ],
    "model_deployments": [
        ("model_name", "notnull"), ("model_name", ("varchar", 100)), ("model_version", "notnull"),
        ("model_version", ("varchar", 50)), ("run_id", "notnull"), ("run_id", ("varchar", 50)),
        ("f1_score", "notnull"), ("f1_score", ("numeric", 5, 4)), ("accuracy", "notnull"), ("accuracy", ("numeric", 5, 4)),
    ],
    "pipeline_runs": [
        ("dag_id", "notnull"), ("dag_id", ("varchar", 100)), ("run_id", "notnull"),
        ("run_id", ("varchar", 100)), ("status", "notnull"), ("status", ("varchar", 20)),
        ("status", ("in", RUN_STATUSES)), ("started_at", "notnull"),
    ],
}


def _violation(col: str, rule) -> tuple[str, Column]:
    c = F.col(col)
    if rule == "notnull":
        return f"{col}:not_null", c.isNull()
    kind = rule[0]
    if kind == "varchar":
        return f"{col}:varchar({rule[1]})", F.char_length(c.cast("string")) > rule[1]
    if kind == "numeric":
        p, s = rule[1], rule[2]
        # NUMERIC(p,s) rounds to s places and must then fit p-s integer digits.
        lim = 10 ** (p - s)
        r = F.round(c.cast("double"), s)
        return f"{col}:numeric({p},{s})", (F.abs(r) >= F.lit(float(lim)))
    if kind == "in":
        return f"{col}:check", ~c.isin(*rule[1])
    raise ValueError(rule)


def check_constraints(df: DataFrame, table: str) -> DataFrame:
    """Add ``violations ARRAY<STRING>`` (empty when the row is valid). A column that is
    not there is null in every row: it breaks its NOT NULL rule and no other."""
    absent = {c for c, _ in RULES[table]} - set(df.columns)
    checks = [(f"{c}:not_null", F.lit(True)) if c in absent else _violation(c, r)
              for c, r in RULES[table] if c not in absent or r == "notnull"]
    arr = F.array(*[F.when(cond, F.lit(name)) for name, cond in checks])
    return df.withColumn("violations", F.array_compact(arr))


def split_valid(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that pass every constraint, and the quarantined rest with reasons."""
    checked = check_constraints(df, table)
    ok = F.size("violations") == 0
    return checked.where(ok).drop("violations"), checked.where(~ok)
