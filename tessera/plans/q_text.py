"""Text, validation and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import spread
from ..functions import text as X
from ..operators import sample as S
from ..operators import validate as VA
from ..schemas import check_constraints
from ..sources import views as V
from .catalog import register
from .oracle_views import (V_PREDICTIONS, V_REVIEWS, sql_blank, sql_clean_text, sql_md5_order,
                           with_views)

CFG = DEFAULT


@register("clean_documents", f"""
SELECT doc_id, {sql_clean_text('text')} AS text_clean,
       length({sql_clean_text('text')}) AS n_clean,
       sha256(text) AS text_hash, length(text) AS n_chars
FROM documents""", "doc_id:int text_clean:str n_clean:int text_hash:str n_chars:int")
def clean_documents(t):
    """clean_text over every document, with raw hash and length."""
    d = spread(t.documents.select("doc_id", "text"), "doc_id").withColumn("text_clean", X.clean_text("text"))
    return d.select("doc_id", "text_clean", F.char_length("text_clean").alias("n_clean"),
                              X.sha256_hex("text").alias("text_hash"),
                              X.char_length("text").alias("n_chars"))


@register("clean_conversations", f"""
SELECT conv_id, turn, {sql_clean_text('text')} AS text_clean FROM conversations""",
          "conv_id:int turn:int text_clean:str")
def clean_conversations(t):
    """F7 over every conversation turn (the scoring input)."""
    return t.conversations.select("conv_id", "turn", X.clean_text("text").alias("text_clean"))


@register("clean_pages")
def clean_pages(t):
    """F1 + F7 on raw web pages: entity unescape needs the Arrow UDF branch
    (no DuckDB equivalent), so this one is checked rows-only and in pytest."""
    return t.pages.select("page_id", X.clean_text("html").alias("text_clean"))


@register("text_fingerprints", """
SELECT conv_id, turn, sha256(text) AS text_hash, length(text) AS n_chars,
       substr(text, 1, 8) AS text_prefix,
       format('{:.4f}', length(text) / 1000.0) AS kchars
FROM conversations""", "conv_id:int turn:int text_hash:str n_chars:int text_prefix:str kchars:str")
def text_fingerprints(t):
    """Hash, code-point length, 8-char prefix, fixed-decimal format."""
    c = t.conversations
    return c.select("conv_id", "turn", X.sha256_hex("text").alias("text_hash"),
                    X.char_length("text").alias("n_chars"), X.prefix("text", 8).alias("text_prefix"),
                    X.format_score(X.char_length("text") / F.lit(1000.0)).alias("kchars"))


@register("admissible_requests", """
SELECT conv_id, turn, length(text) AS n_chars,
       coalesce(text IS NOT NULL AND length(text) BETWEEN 1 AND 5000, FALSE) AS admissible
FROM conversations""", "conv_id:int turn:int n_chars:int admissible:bool")
def admissible_requests(t):
    """Request admissibility (1..5000 characters)."""
    a = VA.admissibility(t.conversations, "text", CFG.max_text_length)
    return a.select("conv_id", "turn", "n_chars", "admissible")


_PROFILE_SQL = """
, d AS (SELECT text, label FROM {src}),
m AS (
  SELECT count(*) AS row_count,
         sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) + sum(CASE WHEN label IS NULL THEN 1 ELSE 0 END) AS null_count,
         sum(CASE WHEN {blank} THEN 1 ELSE 0 END) AS empty_text_count,
         count(DISTINCT label) AS n_labels,
         sum(CASE WHEN label IS NOT NULL AND label NOT IN (0, 1) THEN 1 ELSE 0 END) AS nb,
         min(length(coalesce(text, 'None'))) AS len_min,
         max(length(coalesce(text, 'None'))) AS len_max,
         avg(length(coalesce(text, 'None'))) AS len_mean,
         median(length(coalesce(text, 'None'))) AS len_median
  FROM d),
g AS (SELECT count(*) AS n FROM d GROUP BY text, label),
dup AS (SELECT coalesce(sum(n - 1), 0) AS duplicate_count FROM g),
c AS (SELECT label, count(*) AS n FROM d WHERE label IS NOT NULL GROUP BY label),
r AS (SELECT max(n) / sum(n) AS max_class_ratio FROM c)
SELECT row_count, coalesce(null_count, 0) AS null_count, coalesce(empty_text_count, 0) AS empty_text_count,
       duplicate_count, n_labels, coalesce(nb, 0) = 0 AS labels_binary,
       coalesce(max_class_ratio, 0) AS max_class_ratio,
       coalesce(max_class_ratio, 0) > 0.6 AS imbalanced,
       len_min, len_max, len_mean, len_median
FROM m, dup, r"""
_PROFILE_SPEC = ("row_count:int null_count:int empty_text_count:int duplicate_count:int n_labels:int "
                 "labels_binary:bool max_class_ratio:dbl imbalanced:bool len_min:dbl len_max:dbl "
                 "len_mean:dbl len_median:dbl")


@register("validation_profile",
          with_views(V_REVIEWS) + _PROFILE_SQL.format(src="reviews", blank=sql_blank("text"))
          .replace("\n, d AS", ", d AS", 1), _PROFILE_SPEC)
def validation_profile(t):
    """One-pass validation profile of the labelled reviews."""
    return VA.profile(V.reviews(t)).select(*VA.PROFILE_FIGURES)


@register("validation_profile_clean",
          with_views(V_REVIEWS) + _PROFILE_SQL.format(
              src=f"(SELECT {sql_clean_text('text')} AS text, label FROM reviews)",
              blank=sql_blank("text")).replace("\n, d AS", ", d AS", 1), _PROFILE_SPEC)
def validation_profile_clean(t):
    """V11 after cleaning: a row that cleans to empty text would fail the gate."""
    r = V.reviews(t).select(X.clean_text("text").alias("text"), "label")
    return VA.profile(r).select(*VA.PROFILE_FIGURES)


@register("validation_quarantine", f"""
WITH d AS (SELECT d.doc_id, d.text, CASE WHEN l.quality = 1 AND l.toxic = 1 THEN 2 ELSE l.quality END AS label
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, CASE WHEN label IS NULL THEN 'null label' ELSE 'label not 0 or 1' END AS reason
FROM d WHERE label IS NULL OR label NOT IN (0, 1)""", "doc_id:int reason:str")
def validation_quarantine(t):
    """V11 quarantine: documents without a label, or with one outside 0/1
    (good and toxic counts as 2 here)."""
    lab = F.when((F.col("quality") == 1) & (F.col("toxic") == 1), 2).otherwise(F.col("quality"))
    d = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", lab.alias("label")), "doc_id", "left")
    _, bad = VA.quarantine(d)
    return bad.select("doc_id", F.explode("reasons").alias("reason"))


@register("class_distribution", with_views(V_REVIEWS) + """
SELECT label, count(*) AS count, count(*) / sum(count(*)) OVER () AS ratio
FROM reviews WHERE label IS NOT NULL GROUP BY label""", "label:int count:int ratio:dbl")
def class_distribution(t):
    """Count and share per label."""
    return VA.class_distribution(V.reviews(t))


@register("prediction_constraints", with_views(V_PREDICTIONS) + """
SELECT count(*) AS total_rows,
       sum(CASE WHEN input_text_hash IS NULL OR length(input_text_hash) > 64
                  OR predicted_sentiment IS NULL OR length(predicted_sentiment) > 10
                  OR confidence IS NULL OR abs(round(CAST(confidence AS DOUBLE), 4)) >= 10
                  OR model_version IS NULL OR length(model_version) > 100
                  OR model_name IS NULL OR length(model_name) > 100
                  OR latency_ms IS NULL OR input_length IS NULL OR id IS NULL
                THEN 1 ELSE 0 END) AS quarantined_rows
FROM predictions""", "total_rows:int quarantined_rows:int")
def prediction_constraints(t):
    """V9: NOT NULL / VARCHAR / NUMERIC rules of the prediction log."""
    c = check_constraints(V.predictions(t), "predictions")
    return c.agg(F.count(F.lit(1)).alias("total_rows"),
                 F.sum((F.size("violations") > 0).cast("int")).alias("quarantined_rows"))


# V9 on rows that break rules: log rows of each table filled from other tables
# without care for types and lengths. One line a column: (table's column, SQL).
_CARELESS = {
    "predictions": ("events", {
        "id": "CAST(event_id AS STRING)", "input_text_hash": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE props END",
        "input_length": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id END",
        "predicted_sentiment": "concat(event_type, '-', CAST(user_id AS STRING))", "confidence": "value / 10",
        "model_version": "CASE WHEN user_id % 9 = 0 THEN NULL ELSE '1' END", "model_name": "repeat(event_type, CAST(user_id % 40 AS INT))",
        "latency_ms": "CASE WHEN user_id % 11 = 0 THEN NULL ELSE event_id END"}),
    "alerts": ("events", {
        "alert_type": "CASE event_type WHEN 'error' THEN 'pipeline_failure' WHEN 'click' THEN NULL ELSE repeat(event_type, CAST(user_id % 9 AS INT)) END",
        "severity": "CASE user_id % 4 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'loud' ELSE event_type || '-alert' END",
        "message": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END"}),
    "drift_reports": ("lineitem", {
        "report_date": "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_shipdate END", "dataset_drift_detected": "l_discount > 0.05",
        "drift_score": "l_quantity / 4", "features_drifted": "CASE WHEN l_linenumber = 2 THEN NULL ELSE l_linenumber END",
        "total_features": "l_linenumber", "prediction_drift_detected": "CASE WHEN l_tax > 0.07 THEN NULL ELSE l_tax > 0.02 END",
        "reference_size": "l_partkey", "current_size": "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_suppkey END",
        "report_path": "repeat(l_returnflag, CAST(l_quantity * 12 AS INT))"}),
    "model_deployments": ("part", {
        "model_name": "repeat(p_name, CAST(p_size % 20 AS INT))", "model_version": "repeat(p_brand, CAST(p_size % 9 AS INT))",
        "run_id": "CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE repeat(p_brand, CAST(p_partkey % 8 AS INT)) END",
        "f1_score": "p_retailprice / 100", "accuracy": "CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size / 4.0 END"}),
    "pipeline_runs": ("conversations", {
        "dag_id": "CASE WHEN turn = 0 THEN NULL ELSE text END", "run_id": "CASE WHEN conv_id % 4 = 0 THEN NULL ELSE role END",
        "status": "CASE WHEN conv_id % 3 = 0 THEN 'failed' WHEN conv_id % 3 = 1 THEN role ELSE text END",
        "started_at": "CASE WHEN turn % 2 = 0 THEN NULL ELSE conv_id END"}),
}


def _violation_sql() -> str:
    """The rules restated: a condition for each, counted over each table."""
    from ..schemas import RULES
    parts = []
    for table, (source, cols) in _CARELESS.items():
        inner = ", ".join(f"{e.replace('AS STRING', 'AS VARCHAR')} AS {c}" for c, e in cols.items())
        for col, rule in RULES[table]:
            if rule == "notnull":
                name, cond = "not_null", f"{col} IS NULL"
            elif rule[0] == "varchar":
                name, cond = f"varchar({rule[1]})", f"length({col}) > {rule[1]}"
            elif rule[0] == "numeric":
                name, cond = f"numeric({rule[1]},{rule[2]})", f"abs(round(CAST({col} AS DOUBLE), {rule[2]})) >= {10 ** (rule[1] - rule[2])}"
            else:
                name, cond = "check", f"{col} NOT IN ({', '.join(repr(v) for v in rule[1])})"
            parts.append(f"SELECT '{table}' AS log_table, '{col}:{name}' AS violation, count(*) AS n_rows "
                         f"FROM (SELECT {inner} FROM {source}) WHERE {cond}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE n_rows > 0"


@register("constraint_violations", _violation_sql(), "log_table:str violation:str n_rows:int")
def constraint_violations(t):
    """V9: broken rules of all five log tables, on rows that break them."""
    out = None
    for table, (source, cols) in _CARELESS.items():
        rows = getattr(t, source).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()])
        bad = check_constraints(rows, table).select(F.lit(table).alias("log_table"), F.explode("violations").alias("violation"))
        out = bad if out is None else out.unionByName(bad)
    return out.groupBy("log_table", "violation").agg(F.count(F.lit(1)).alias("n_rows"))


def _split_sql() -> str:
    h = sql_md5_order("doc_id", CFG.seed)
    return with_views(V_REVIEWS) + f"""
, r AS (
  SELECT doc_id, label,
         row_number() OVER (PARTITION BY label ORDER BY {h}, doc_id) AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM reviews)
SELECT doc_id, label,
       CASE WHEN rk <= round(n * {CFG.test_size}) THEN 'test'
            WHEN rk <= round(n * {CFG.test_size}) + round(n * {CFG.val_size}) THEN 'val'
            ELSE 'train' END AS split
FROM r""".replace("\n, r AS", ", r AS", 1)


@register("stratified_split", _split_sql(), "doc_id:int label:int split:str")
def stratified_split(t):
    """Exact seeded stratified 80/10/10 split of the reviews."""
    return S.stratified_split(V.reviews(t), "doc_id", "label", CFG).select("doc_id", "label", "split")


def _cap_sql(max_samples: int) -> str:
    h = sql_md5_order("doc_id", CFG.seed)
    return with_views(V_REVIEWS) + f"""
, r AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {h}, doc_id) AS rk,
         count(*) OVER () AS total, count(DISTINCT label) OVER () AS k
  FROM reviews)
SELECT doc_id, label FROM r
WHERE total <= {max_samples} OR rk <= greatest(1, {max_samples} // k)""".replace("\n, r AS", ", r AS", 1)


@register("balanced_cap", _cap_sql(200), "doc_id:int label:int")
def balanced_cap(t):
    """L1: at most max_samples // n_classes rows per class (max_samples=200)."""
    return S.balanced_cap(V.reviews(t), "doc_id", "label", 200, CFG).select("doc_id", "label")


# Keys that repeat and are null, labels that are null: requests of users, a row an event.
_REQUESTS = """requests AS (
  SELECT CASE WHEN user_id % 10 = 0 THEN NULL ELSE user_id END AS user_key,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS label, CAST(ts AS DATE) AS day
  FROM events)"""
_PLACE = f"md5(concat_ws(':', '{CFG.seed}', CAST(user_key AS VARCHAR))), user_key"


def _requests(t):
    e = t.events
    return e.select(F.when(e.user_id % 10 != 0, e.user_id).alias("user_key"), F.when(e.event_type != "error", e.event_type).alias("label"),
                    F.to_date("ts").alias("day"))


@register("stratified_split_ties", f"""
WITH {_REQUESTS}, r AS (
  SELECT user_key, label, row_number() OVER (PARTITION BY label ORDER BY {_PLACE}) AS rk,
         count(*) OVER (PARTITION BY label) AS n FROM requests)
SELECT user_key, label, CASE WHEN rk <= round(n * {CFG.test_size}) THEN 'test'
    WHEN rk <= round(n * {CFG.test_size}) + round(n * {CFG.val_size}) THEN 'val' ELSE 'train' END AS split FROM r""",
          "user_key:int label:str split:str")
def stratified_split_ties(t):
    """W1/L2 where keys repeat or are null and labels are null: quotas stay exact."""
    return S.stratified_split(_requests(t), "user_key", "label", CFG).select("user_key", "label", "split")


@register("balanced_cap_ties", f"""
WITH {_REQUESTS}, r AS (
  SELECT user_key, label, row_number() OVER (PARTITION BY label ORDER BY {_PLACE}) AS rk,
         count(DISTINCT label) OVER () AS k FROM requests)
SELECT user_key, label FROM r WHERE label IS NOT NULL AND rk <= 777 // k""", "user_key:int label:str")
def balanced_cap_ties(t):
    """W1/L1 on the same rows: null labels are in no class (max_samples=777)."""
    return S.balanced_cap(_requests(t), "user_key", "label", 777, CFG).select("user_key", "label")


def _prop_sql(cap: int) -> str:
    h = sql_md5_order("doc_id", CFG.seed)
    hc = sql_md5_order("doc_id", CFG.seed, "cap")
    return with_views(V_REVIEWS) + f"""
, r AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {h}, doc_id) AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM reviews),
s AS (
  SELECT doc_id, label,
         CASE WHEN rk <= round(n * {CFG.test_size}) THEN 'test'
              WHEN rk <= round(n * {CFG.test_size}) + round(n * {CFG.val_size}) THEN 'val'
              ELSE 'train' END AS split
  FROM r),
z AS (SELECT split, count(*) AS n, sum(count(*)) OVER () AS tot FROM s GROUP BY split),
q1 AS (SELECT split, n, tot, greatest(2, floor({cap} * n / tot)) AS sq FROM z),
q2 AS (SELECT split, n, tot,
              CASE WHEN split = 'test'
                   THEN greatest(2, {cap} - sum(CASE WHEN split <> 'test' THEN sq ELSE 0 END) OVER ())
                   ELSE sq END AS quota FROM q1),
q AS (SELECT split, CASE WHEN tot <= {cap} THEN n ELSE least(quota, n) END AS quota FROM q2),
k AS (SELECT doc_id, label, split, row_number() OVER (PARTITION BY split ORDER BY {hc}, doc_id) AS rk FROM s)
SELECT k.doc_id, k.label, k.split FROM k JOIN q ON k.split = q.split WHERE k.rk <= q.quota
""".replace("\n, r AS", ", r AS", 1)


@register("proportional_cap", _prop_sql(100), "doc_id:int label:int split:str")
def proportional_cap(t):
    """L3: the split capped to 100 rows in proportion (test takes the rest)."""
    s = S.stratified_split(V.reviews(t), "doc_id", "label", CFG)
    return S.proportional_cap(s, "doc_id", CFG, max_total=100).select("doc_id", "label", "split")


def _refprof_sql() -> str:
    base = _split_sql().replace("SELECT doc_id, label,\n       CASE", "SELECT doc_id, label, text,\n       CASE", 1)
    base = base.replace("SELECT doc_id, label,\n         row_number()", "SELECT doc_id, label, text,\n         row_number()", 1)
    body = base[base.index(", r AS"):]
    head = base[:base.index(", r AS")]
    return head + body.replace("\nSELECT doc_id, label, text,\n       CASE", ", sp AS (SELECT doc_id, label, text,\n       CASE", 1) + f""")
SELECT doc_id,
       CASE WHEN label = 0 THEN 'negative' WHEN label = 1 THEN 'positive' ELSE CAST(label AS VARCHAR) END AS predicted_sentiment,
       length({sql_clean_text('text')}) AS input_length
FROM sp WHERE split = 'train'"""


@register("reference_profile", _refprof_sql(), "doc_id:int predicted_sentiment:str input_length:int")
def reference_profile(t):
    """Train split as (predicted_sentiment, input_length of cleaned text)."""
    r = V.reviews(t)
    s = S.stratified_split(r, "doc_id", "label", CFG).where(F.col("split") == "train")
    return s.select("doc_id",
                    F.when(F.col("label") == 0, "negative").when(F.col("label") == 1, "positive")
                     .otherwise(F.col("label").cast("string")).alias("predicted_sentiment"),
                    F.char_length(X.clean_text("text")).alias("input_length"))
