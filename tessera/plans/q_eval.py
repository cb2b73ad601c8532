"""Evaluation, scoring-math and JSON queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions import jsonx as J
from ..functions import mathx as MX
from ..operators import evaluate as EV
from ..sources import views as V
from .catalog import register
from .oracle_views import V_LOGITS, V_TRUTH_PRED, with_views

CFG = DEFAULT

_CELLS = with_views(V_TRUTH_PRED) + """, c AS (
  SELECT sum(CASE WHEN y_true = 0 AND y_pred = 0 THEN 1 ELSE 0 END) AS tn,
         sum(CASE WHEN y_true = 0 AND y_pred = 1 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN y_true = 1 AND y_pred = 0 THEN 1 ELSE 0 END) AS fn,
         sum(CASE WHEN y_true = 1 AND y_pred = 1 THEN 1 ELSE 0 END) AS tp,
         count(*) AS total, sum(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END) AS correct,
         count(*) FILTER (WHERE y_true = 0 OR y_pred = 0) > 0 AS seen0,
         count(*) FILTER (WHERE y_true = 1 OR y_pred = 1) > 0 AS seen1
  FROM truth_pred),
k AS (
  SELECT *,
    coalesce(tn / nullif(tn + fn, 0), 0) AS pn, coalesce(tn / nullif(tn + fp, 0), 0) AS rn,
    coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS fneg, tn + fp AS sneg,
    coalesce(tp / nullif(tp + fp, 0), 0) AS pp, coalesce(tp / nullif(tp + fn, 0), 0) AS rp,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS fpos, tp + fn AS spos,
    CAST(seen0 AS INTEGER) + CAST(seen1 AS INTEGER) AS npres
  FROM c)
"""


@register("evaluation_metrics", _CELLS + """
SELECT coalesce(correct / nullif(total, 0), 0) AS accuracy,
       coalesce(((CASE WHEN seen0 THEN pn ELSE 0 END) + (CASE WHEN seen1 THEN pp ELSE 0 END)) / nullif(npres, 0), 0) AS precision_macro,
       coalesce(((CASE WHEN seen0 THEN rn ELSE 0 END) + (CASE WHEN seen1 THEN rp ELSE 0 END)) / nullif(npres, 0), 0) AS recall_macro,
       coalesce(((CASE WHEN seen0 THEN fneg ELSE 0 END) + (CASE WHEN seen1 THEN fpos ELSE 0 END)) / nullif(npres, 0), 0) AS f1_macro,
       pn AS precision_negative, rn AS recall_negative, fneg AS f1_negative, sneg AS support_negative,
       pp AS precision_positive, rp AS recall_positive, fpos AS f1_positive, spos AS support_positive,
       tn AS cm_tn, fp AS cm_fp, fn AS cm_fn, tp AS cm_tp
FROM k""", "accuracy:dbl precision_macro:dbl recall_macro:dbl f1_macro:dbl precision_negative:dbl "
           "recall_negative:dbl f1_negative:dbl support_negative:int precision_positive:dbl "
           "recall_positive:dbl f1_positive:dbl support_positive:int cm_tn:int cm_fp:int cm_fn:int cm_tp:int")
def evaluation_metrics(t):
    """Quality labels vs (1 - toxic) as predictions."""
    return EV.evaluate(V.truth_pred(t))


@register("confusion_matrix", _CELLS + """
SELECT 0 AS true_label, 0 AS pred_label, tn AS count FROM c UNION ALL
SELECT 0, 1, fp FROM c UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""",
          "true_label:int pred_label:int count:int")
def confusion_matrix(t):
    """2x2 confusion matrix in long form, zero cells kept."""
    return EV.confusion_matrix(V.truth_pred(t))


@register("classification_report", _CELLS + """
SELECT 'negative' AS label, pn AS precision, rn AS recall, fneg AS f1_score, sneg AS support FROM k UNION ALL
SELECT 'positive', pp, rp, fpos, spos FROM k UNION ALL
SELECT 'accuracy', correct / total, correct / total, correct / total, sneg + spos FROM k UNION ALL
SELECT 'macro avg', (pn + pp) / 2, (rn + rp) / 2, (fneg + fpos) / 2, sneg + spos FROM k UNION ALL
SELECT 'weighted avg', coalesce((pn * sneg + pp * spos) / nullif(sneg + spos, 0), 0),
       coalesce((rn * sneg + rp * spos) / nullif(sneg + spos, 0), 0),
       coalesce((fneg * sneg + fpos * spos) / nullif(sneg + spos, 0), 0), sneg + spos FROM k""",
          "label:str precision:dbl recall:dbl f1_score:dbl support:int")
def classification_report(t):
    """Per-class, accuracy, macro and weighted rows."""
    return EV.classification_report(V.truth_pred(t))


@register("classification_report_json", _CELLS + """, rep AS (
SELECT 'accuracy' AS label, correct / total AS f, correct / total AS p, correct / total AS r, sneg + spos AS s FROM k UNION ALL
SELECT 'macro avg', (fneg + fpos) / 2, (pn + pp) / 2, (rn + rp) / 2, sneg + spos FROM k UNION ALL
SELECT 'negative', fneg, pn, rn, sneg FROM k UNION ALL
SELECT 'positive', fpos, pp, rp, spos FROM k UNION ALL
SELECT 'weighted avg', coalesce((fneg * sneg + fpos * spos) / nullif(sneg + spos, 0), 0),
       coalesce((pn * sneg + pp * spos) / nullif(sneg + spos, 0), 0),
       coalesce((rn * sneg + rp * spos) / nullif(sneg + spos, 0), 0), sneg + spos FROM k)
SELECT '{' || string_agg('"' || label || '":{"f1_score":' || CAST(round(f, 6) AS DOUBLE) || ',"precision":' || CAST(round(p, 6) AS DOUBLE)
       || ',"recall":' || CAST(round(r, 6) AS DOUBLE) || ',"support":' || CAST(s AS BIGINT) || '}', ',' ORDER BY label) || '}' AS report
FROM rep""", "report:str")
def classification_report_json(t):
    """The report as one sorted-key JSON document, to 6 places."""
    return EV.report_json(V.truth_pred(t))


@register("softmax_argmax", with_views(V_LOGITS) + """
, m AS (SELECT vec_id, s, list_max(s) AS top, list_position(s, list_max(s)) - 1 AS i FROM logits)
SELECT vec_id, i AS pred_class, 1.0 / list_sum(list_transform(s, lambda x: exp(x - top))) AS confidence,
       CASE i WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' ELSE CAST(i AS VARCHAR) END AS sentiment
FROM m""", "vec_id:int pred_class:int confidence:dbl sentiment:str")
def softmax_argmax(t):
    """Softmax over all 64 scores, winning class (first wins ties)."""
    lg = V.logits(t)
    idx, prob = MX.softmax_argmax("scores")
    return lg.select("vec_id", idx.alias("pred_class"), prob.alias("confidence"),
                     F.when(idx == 0, "negative").when(idx == 1, "positive")
                      .otherwise(idx.cast("string")).alias("sentiment"))


@register("numeric_props", """
SELECT event_id, k AS key, CAST(json_extract(props, '$."' || k || '"') AS DOUBLE) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)
WHERE json_type(props, '$."' || k || '"') IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'INTEGER', 'HUGEINT')""",
          "event_id:int key:str value:dbl")
def numeric_props(t):
    """Numeric entries of each event's JSON props (booleans, text, nested dropped)."""
    return J.numeric_metrics(t.events, "props", ["event_id"])


@register("json_rejects", """
SELECT doc_id, CASE WHEN json_valid(text) THEN 'not an object' ELSE 'not JSON' END AS reason FROM documents
WHERE text IS NOT NULL AND (NOT json_valid(text) OR json_type(CASE WHEN json_valid(text) THEN text END) <> 'OBJECT')""",
          "doc_id:int reason:str")
def json_rejects(t):
    """J3/J4 quarantine: texts that are no JSON object, with the reason."""
    return J.json_rejects(t.documents, "text", ["doc_id"])


@register("flattened_props", """
WITH e AS (
  SELECT event_id, k AS key, json_extract(props, '$."' || k || '"') AS v,
         json_type(props, '$."' || k || '"') AS ty
  FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events))
SELECT event_id, key,
       CASE WHEN ty IN ('BOOLEAN', 'BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') THEN v ->> '$'
            ELSE CAST(v AS VARCHAR) END AS value,
       ty IN ('BOOLEAN', 'BIGINT', 'UBIGINT', 'DOUBLE', 'VARCHAR') AS is_scalar
FROM e""", "event_id:int key:str value:str is_scalar:bool")
def flattened_props(t):
    """Event props flattened to text parameters: scalars as their text,
    lists, objects and nulls as JSON text."""
    return J.flatten_params(t.events, "props", ["event_id"])
