"""Model training and batch scoring queries (K1-K8, A15, W4, S8); rows-only.

Training is iterative (L-BFGS), so these are checked by row count and by the
pytest cases of the reference (separable corpus, accuracy >= 0.7).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..operators import model as MD
from ..operators import sample as S
from ..operators import validate as VA
from ..sources import views as V
from .catalog import register
from .oracle_views import V_REVIEWS, sql_clean_text, with_views

CFG = DEFAULT


def _candidates(t):
    """Both candidates, fitted on this folder's labelled reviews."""
    splits = S.stratified_split(V.reviews(t), "doc_id", "label", CFG)
    return MD.train_and_evaluate(splits, CFG)


def _candidate_frame(t, cands):
    rows = [(c.model_type, i, c.run_id, float(c.metrics["accuracy"]), float(c.metrics["f1_macro"]),
             float(c.metrics["precision_macro"]), float(c.metrics["recall_macro"]),
             int(c.metrics["n_features"]), int(c.metrics["validation_rows"]),
             c.metrics.get("iterations"), c.metrics.get("converged"))
            for i, c in enumerate(cands)]
    return t.spark.createDataFrame(
        rows, "model_type string, position int, run_id string, accuracy double, f1_macro double, "
              "precision_macro double, recall_macro double, n_features int, validation_rows int, "
              "iterations int, converged boolean")


@register("train_candidates")
def train_candidates(t):
    """Both candidates' test metrics; the winner is the max
    F1 with the first listed winning ties."""
    cands = _candidates(t)
    df = _candidate_frame(t, cands)
    # Two rows: the winner flag is a window over the whole (tiny) frame.
    w = Window.partitionBy()
    order = F.struct("f1_macro", (-F.col("position")).alias("p"))
    return df.withColumn("is_winner", F.col("model_type") == F.max_by("model_type", order).over(w))


@register("batch_scoring")
def batch_scoring(t):
    """Score every admissible conversation turn with the
    winning model and derive the prediction-log rows."""
    cands = _candidates(t)
    best = max(enumerate(cands), key=lambda ic: (ic[1].metrics["f1_macro"], -ic[0]))[1]
    src = VA.admissibility(t.conversations, "text", CFG.max_text_length).where("admissible")
    scored = MD.predict(best.model, src, "text")
    return MD.log_rows(scored, "text", ["conv_id", "turn"], "1", CFG.registry_name,
                       datetime(2024, 1, 31), "batch-2024-01-31")


@register("scoring_rejects", f"""
SELECT doc_id, length(text) AS input_length,
       CASE WHEN text IS NULL THEN 'null text' WHEN length(text) < 1 THEN 'empty text' ELSE 'text too long' END AS reason
FROM documents WHERE NOT coalesce(length(text) BETWEEN 1 AND {CFG.max_text_length}, FALSE)""",
          "doc_id:int input_length:int reason:str")
def scoring_rejects(t):
    """The quarantine side of scoring, over every document."""
    from ..streaming import stream as ST
    return ST.rejected_stream(t.documents, "text", ["doc_id"], CFG)


@register("scoring_rejects_turns", f"""
SELECT conv_id, turn, length(text) AS input_length,
       CASE WHEN text IS NULL THEN 'null text' WHEN length(text) < 1 THEN 'empty text' ELSE 'text too long' END AS reason
FROM conversations WHERE NOT coalesce(length(text) BETWEEN 1 AND {CFG.max_text_length}, FALSE)""",
          "conv_id:int turn:int input_length:int reason:str")
def scoring_rejects_turns(t):
    """The turns that batch and stream scoring leave out."""
    from ..streaming import stream as ST
    return ST.rejected_stream(t.conversations, "text", ["conv_id", "turn"], CFG)


# The multinomial naive Bayes candidate has a closed form: class shares and smoothed term
# shares of the training documents, over the vocabulary of the most frequent terms.
_BAYES = with_views(V_REVIEWS) + f""",
g AS (SELECT doc_id, label, regexp_extract_all({sql_clean_text('text')}, '[a-z0-9]{{2,}}') AS t FROM reviews),
gr AS (SELECT label, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM g),
st AS (SELECT term, count(*) AS tf, sum(label) AS tf1 FROM gr GROUP BY term),
voc AS (SELECT * FROM st ORDER BY tf DESC, term LIMIT {CFG.tfidf_max_features}),
size AS (SELECT count(*) AS v, sum(tf - tf1) AS n0, sum(tf1) AS n1 FROM voc),
prior AS (SELECT ln((sum(label) + 1.0) / (count(*) + 2)) - ln((sum(1 - label) + 1.0) / (count(*) + 2)) AS p FROM reviews),
theta AS (SELECT term, ln((tf1 + 1.0) / (n1 + v)) - ln((tf - tf1 + 1.0) / (n0 + v)) AS w FROM voc, size),
c AS (SELECT conv_id, turn, text, regexp_extract_all({sql_clean_text('text')}, '[a-z0-9]{{2,}}') AS t
      FROM conversations WHERE length(text) BETWEEN 1 AND {CFG.max_text_length}),
cg AS (SELECT conv_id, turn, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM c),
z AS (SELECT conv_id, turn, sum(w) AS s FROM cg JOIN theta USING (term) GROUP BY ALL),
x AS (SELECT c.conv_id, c.turn, c.text, coalesce(z.s, 0) + p AS s FROM c LEFT JOIN z USING (conv_id, turn), prior)
SELECT conv_id, turn, sha256(text) AS input_text_hash, length(text) AS input_length,
  CASE WHEN s > 0 THEN 'positive' ELSE 'negative' END AS predicted_sentiment, round(1 / (1 + exp(-abs(s))), 3) AS confidence
FROM x"""
_BAYES_SPEC = "conv_id:int turn:int input_text_hash:str input_length:int predicted_sentiment:str confidence:dbl"


def _bayes(t):
    return MD.fit_candidates(V.reviews(t), CFG, only=("naive_bayes_counts",))["naive_bayes_counts"][0]


def _shown(rows):
    return rows.select("conv_id", "turn", "input_text_hash", "input_length", "predicted_sentiment",
                       F.round(F.col("confidence").cast("double"), 3).alias("confidence"))


@register("batch_scoring_bayes", _BAYES, _BAYES_SPEC)
def batch_scoring_bayes(t):
    """The naive Bayes candidate, fitted on all reviews, scores every
    admissible turn (confidence to three places)."""
    turns = VA.admissibility(t.conversations, "text", CFG.max_text_length).where("admissible")
    scored = MD.predict(_bayes(t), turns, "text", digits=8)
    return _shown(scored.withColumns({"input_text_hash": F.sha2("text", 256), "input_length": F.char_length("text")}))


@register("stream_scoring_bayes", _BAYES, _BAYES_SPEC)
def stream_scoring_bayes(t):
    """The same model over the turns as a file stream."""
    from ..streaming import stream as ST
    path = f"{t.root}/conversations.parquet"
    src = (t.spark.readStream.schema("conv_id BIGINT, turn BIGINT, role STRING, text STRING").parquet(ST._stream_path(path)))
    src = src.where(F.char_length("text").between(1, CFG.max_text_length))
    scored = MD.predict(_bayes(t), src, "text", digits=8)
    scored = scored.withColumns({"input_text_hash": F.sha2("text", 256), "input_length": F.char_length("text")})
    return _shown(ST.run_available(scored.drop("text", "role"), "scoring-bayes", path))


@register("stream_scoring")
def stream_scoring(t):
    """Conversation turns read as a file stream, scored by the winning
    model (row-local stages only) and appended to a parquet prediction log."""
    from ..streaming import stream as ST
    cands = _candidates(t)
    best = max(enumerate(cands), key=lambda ic: (ic[1].metrics["f1_macro"], -ic[0]))[1]
    path = f"{t.root}/conversations.parquet"
    src = (t.spark.readStream.schema("conv_id BIGINT, turn BIGINT, role STRING, text STRING")
           .parquet(ST._stream_path(path)))
    scored = ST.scored_stream(best.model, src, "text", ["conv_id", "turn"], "1", CFG)
    return ST.run_available(scored, f"scoring-{best.run_id[:8]}", path)
