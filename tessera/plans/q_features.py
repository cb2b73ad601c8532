"""Term statistics, vocabulary and TF-IDF queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.common import spread
from ..functions.text import clean_text
from ..operators import features as FE
from ..operators import sample as S
from ..sources import views as V
from ..session import cut_lineage
from .catalog import register
from .oracle_views import V_REVIEWS, sql_clean_text, sql_md5_order, with_views

CFG = DEFAULT


def _grams_sql(src: str, key: str) -> str:
    return f"""g AS (SELECT {key}, regexp_extract_all({sql_clean_text('text')}, '[a-z0-9]{{2,}}') AS t FROM {src}),
gr AS (SELECT {key}, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
       FROM g),
dt AS (SELECT {key}, term, count(*) AS tf FROM gr GROUP BY ALL)"""


def _cleaned(docs):
    return spread(docs, "doc_id").withColumn("text", clean_text("text"))


def _counts(t):
    return FE.term_counts(_cleaned(t.documents.select("doc_id", "text")), "text", CFG.ngram_max)


@register("term_stats", "WITH " + _grams_sql("documents", "doc_id") + """
SELECT term, sum(tf) AS tf, count(*) AS df FROM dt GROUP BY term""", "term:str tf:int df:int")
def term_stats(t):
    """Corpus and document frequency of every 1-2-gram."""
    return _counts(t)


@register("vocabulary", "WITH " + _grams_sql("documents", "doc_id") + f"""
SELECT term, sum(tf) AS tf, count(*) AS df FROM dt GROUP BY term
ORDER BY tf DESC, term LIMIT {CFG.tfidf_max_features}""", "term:str tf:int df:int")
def vocabulary(t):
    """Top 50,000 n-grams by corpus count (ties by term)."""
    return FE.vocabulary(_counts(t), CFG.tfidf_max_features)


def _split_cte() -> str:
    h = sql_md5_order("doc_id", CFG.seed)
    return f"""r AS (
  SELECT doc_id, label, text,
         row_number() OVER (PARTITION BY label ORDER BY {h}, doc_id) AS rk,
         count(*) OVER (PARTITION BY label) AS n
  FROM reviews),
sp AS (SELECT doc_id, label, text,
       CASE WHEN rk <= round(n * {CFG.test_size}) THEN 'test'
            WHEN rk <= round(n * {CFG.test_size}) + round(n * {CFG.val_size}) THEN 'val'
            ELSE 'train' END AS split FROM r)"""


@register("tfidf_weights", with_views(V_REVIEWS) + ", " + _split_cte() + ",\n"
          + _grams_sql("sp", "doc_id, split") + f""",
st AS (SELECT term, sum(tf) AS tf, count(*) AS df FROM dt WHERE split = 'train' GROUP BY term),
voc AS (SELECT term, df FROM st ORDER BY tf DESC, term LIMIT {CFG.tfidf_max_features}),
nd AS (SELECT count(*) AS n FROM sp WHERE split = 'train'),
idf AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM voc, nd),
w AS (SELECT dt.doc_id, dt.term, dt.tf * idf.idf AS w FROM dt JOIN idf ON dt.term = idf.term
      WHERE dt.split = 'test')
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w""",
          "doc_id:int term:str weight:dbl")
def tfidf_weights(t):
    """K1: TF-IDF weights of the test split, vocabulary and idf fitted on train.

    Both branches (train fit, test weights) read the split, so it is written
    once to the shared checkpoint folder instead of ranked twice."""
    s = cut_lineage(S.stratified_split(V.reviews(t), "doc_id", "label", CFG)
                    .select("doc_id", "split", "text"), "tfidf_split")
    s = _cleaned(s)
    idf, _ = FE.fit_vocabulary(s.where(F.col("split") == "train"), "text", CFG)
    return FE.tfidf_weights(s.where(F.col("split") == "test"), "text", "doc_id", idf, CFG.ngram_max)
