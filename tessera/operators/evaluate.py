"""Classification metrics (A8-A12, K7) from one grouped count.

Truth and prediction are joined on a key (rows have no position in Spark),
counted once per (truth, prediction) cell with map-side combine, and every
metric is arithmetic over that table of at most four rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.common import safe_div

LABELS = (0, 1)
TARGET_NAMES = ("negative", "positive")


def cells(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row: tn, fp, fn, tp counts (labels fixed to [0, 1])."""
    g = df.groupBy(F.col(y_true).alias("t"), F.col(y_pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))

    def cell(t, p):
        return F.coalesce(F.sum(F.when((F.col("t") == t) & (F.col("p") == p), F.col("n"))), F.lit(0))
    return g.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
                 cell(1, 1).alias("tp"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
                 F.coalesce(F.sum(F.when(F.col("t") == F.col("p"), F.col("n"))), F.lit(0)).alias("correct"),
                 # labels present in truth or prediction (for the macro average)
                 F.coalesce(F.sum(F.when((F.col("t") == 0) | (F.col("p") == 0), F.col("n"))), F.lit(0))
                 .alias("_seen0"),
                 F.coalesce(F.sum(F.when((F.col("t") == 1) | (F.col("p") == 1), F.col("n"))), F.lit(0))
                 .alias("_seen1"))


def _per_class(c: DataFrame) -> DataFrame:
    """Per-class precision/recall/F1/support columns on the one-row cell frame."""
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    stats = {0: (tn, fn + tn, fp + tn), 1: (tp, fp + tp, fn + tp)}  # (hit, predicted, true)
    cols = []
    for lab, name in zip(LABELS, TARGET_NAMES):
        hit, pred, true = stats[lab]
        cols += [safe_div(hit, pred).alias(f"precision_{name}"),
                 safe_div(hit, true).alias(f"recall_{name}"),
                 safe_div(2 * hit, pred + true).alias(f"f1_{name}"),
                 true.alias(f"support_{name}")]
    return c.select("*", *cols)


def evaluate(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row with accuracy, macro and per-class metrics and the
    confusion counts. The macro mean is over classes present in truth or
    prediction (no ``labels=`` argument in the reference's macro call)."""
    c = _per_class(cells(df, y_true, y_pred))
    present = [F.col("_seen0") > 0, F.col("_seen1") > 0]
    n_present = sum(p.cast("int") for p in present)

    def macro(metric):
        s = sum(F.when(p, F.col(f"{metric}_{nm}")).otherwise(0.0)
                for p, nm in zip(present, TARGET_NAMES))
        return safe_div(s, n_present)
    return c.select(
        safe_div(F.col("correct"), F.col("total")).alias("accuracy"),
        macro("precision").alias("precision_macro"), macro("recall").alias("recall_macro"),
        macro("f1").alias("f1_macro"),
        *[F.col(f"{m}_{nm}") for nm in TARGET_NAMES for m in ("precision", "recall", "f1", "support")],
        F.col("tn").alias("cm_tn"), F.col("fp").alias("cm_fp"), F.col("fn").alias("cm_fn"),
        F.col("tp").alias("cm_tp"))


def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """2x2 matrix in long form ``(true_label, pred_label, count)``, zeros kept."""
    c = cells(df, y_true, y_pred)
    arr = F.array(*[F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("pred_label"),
                             F.col(n).alias("count"))
                    for (t, p), n in (((0, 0), "tn"), ((0, 1), "fp"), ((1, 0), "fn"), ((1, 1), "tp"))])
    return c.select(F.explode(arr).alias("x")).select("x.*")


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per class, accuracy, macro and support-weighted averages
    (labels fixed to [0, 1], zero division gives 0)."""
    c = _per_class(cells(df, y_true, y_pred))
    neg, pos = TARGET_NAMES
    sup = F.col(f"support_{neg}") + F.col(f"support_{pos}")

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("bigint").alias("support"))

    def avg(m):
        return (F.col(f"{m}_{neg}") + F.col(f"{m}_{pos}")) / 2

    def wavg(m):
        return safe_div(F.col(f"{m}_{neg}") * F.col(f"support_{neg}")
                        + F.col(f"{m}_{pos}") * F.col(f"support_{pos}"), sup)
    acc = safe_div(F.col("correct"), F.col("total"))
    rows = F.array(
        *[row(nm, F.col(f"precision_{nm}"), F.col(f"recall_{nm}"), F.col(f"f1_{nm}"),
              F.col(f"support_{nm}")) for nm in TARGET_NAMES],
        row("accuracy", acc, acc, acc, sup),
        row("macro avg", avg("precision"), avg("recall"), avg("f1"), sup),
        row("weighted avg", wavg("precision"), wavg("recall"), wavg("f1"), sup))
    return c.select(F.explode(rows).alias("r")).select("r.*")


def report_json(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", digits: int = 6) -> DataFrame:
    """The report as one sorted-key JSON document, metrics to ``digits`` places."""
    rep = classification_report(df, y_true, y_pred)
    rep = rep.withColumns({c: F.round(c, digits) for c in ("precision", "recall", "f1_score")})
    m = F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        "label", F.struct("f1_score", "precision", "recall", "support")))))
    return rep.agg(F.to_json(m).alias("report"))
