"""Term statistics, vocabulary and TF-IDF.

Terms are counted inside each row's own task: a task tokenises the cleaned texts of an
Arrow batch and adds up its terms, so what is shuffled is a row for each different term of
a batch of documents, not for each term of a document. The partial counts meet in one
``groupBy(term)`` with map-side combine. The vocabulary is bounded by ``max_features`` and
is the only thing broadcast. TF-IDF rows are weighted and normalised in the row's task.

Weighting (the public default of the reference's vectoriser): smoothed idf
``ln((1 + n) / (1 + df)) + 1`` fitted on the training documents, raw term
counts times idf, then L2-normalised per document.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..config import DEFAULT, Config
from ..functions.text import TOKEN_RE, clean_text, ngrams, tokens
from ..session import cut_lineage
from .ordered import top_k

TOKEN = re.compile(TOKEN_RE)
IN_TOKEN = np.array([chr(b).encode("latin-1") in b"abcdefghijklmnopqrstuvwxyz0123456789" for b in range(256)])
BATCH_BYTES = 1 << 18  # cleaned text whose terms a task adds up at a time
BATCH_TERMS = 1 << 17  # counted terms sent on at a time


def with_grams(df: DataFrame, text_col: str, out: str = "grams", n_max: int = 2) -> DataFrame:
    """Clean ``text_col`` and add its n-grams as ``out``, as native expressions (a model's
    feature stages, also on streams).

    Each intermediate (cleaned text, tokens) is projected as a column first:
    a lambda referencing an expression re-evaluates it per element.
    """
    c = df.withColumn("_clean", clean_text(text_col))
    c = c.withColumn("_tok", tokens("_clean"))
    return c.withColumn(out, ngrams("_tok", n_max)).drop("_tok", "_clean")


def _grams(text: str, n_max: int) -> list[str]:
    """F14/F15 of a cleaned text, as ``functions.text.tokens`` and ``ngrams``."""
    tok = TOKEN.findall(text)
    return tok + [" ".join(tok[i:i + n]) for n in range(2, n_max + 1) for i in range(len(tok) - n + 1)]


def _pieces(batch: pa.RecordBatch, column: str, size: int):
    """Slices of a batch with about ``size`` bytes of ``column`` (one row at least)."""
    lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    group = (np.cumsum(lens) - lens) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield batch.slice(lo, hi - lo)


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """F14 of a column of texts: all tokens in order, and the row that each is of. Tokens are
    ASCII, so the bytes of the UTF-8 texts tell them apart."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    first, size = at[0], at[-1] - at[0]
    if not size:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    at = at - first
    word = IN_TOKEN[np.frombuffer(data, np.uint8)[first:first + size]]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edges = at[(at > 0) & (at < size)]  # a text's first byte begins a token, its last one ends it
    starts[edges] = word[edges]
    ends[edges - 1] = word[edges - 1]
    lo, hi = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = hi - lo >= 2
    lo, hi = lo[long], hi[long]
    if not len(lo):
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    cuts = np.stack([lo, hi], axis=1).ravel() + first  # tokens, and what is between them
    pieces = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), data)
    return pieces.take(pa.array(np.arange(0, len(cuts) - 1, 2))), np.searchsorted(at, lo, side="right") - 1


def count_terms(texts: pa.Array, n_max: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different 1- to ``n_max``-grams of a column of cleaned texts, their occurrences and
    the number of texts that have them. Tokens and n-grams are numbered, and counted as
    numbers; an n-gram is a pair of an (n-1)-gram and a token."""
    tokens, row = _tokens(texts)
    coded = tokens.dictionary_encode()
    words, ids = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    terms, gram = words, ids
    out = []
    for n in range(1, n_max + 1):
        if n > 1:
            gram = gram[:len(row) - n + 1]  # by the place of the first token
            whole = row[n - 1:] == row[:len(gram)]
            pair = gram * len(words) + ids[n - 1:]
            coded = pa.array(pair[whole]).dictionary_encode()
            pairs = coded.dictionary.to_numpy()
            terms = pc.binary_join_element_wise(terms.take(pa.array(pairs // max(len(words), 1))),
                                                words.take(pa.array(pairs % max(len(words), 1))),
                                                pa.scalar(" ", pa.large_string()))
            gram = np.full(len(whole), -1, np.int64)
            gram[whole] = coded.indices.to_numpy()
        at = gram >= 0
        once = pc.unique(pa.array(row[:len(gram)][at] * len(terms) + gram[at])).to_numpy()
        out.append((terms, np.bincount(gram[at], minlength=len(terms)), np.bincount(once % max(len(terms), 1), minlength=len(terms))))
    terms, tf, df = zip(*out)
    return pa.concat_arrays(terms), np.concatenate(tf), np.concatenate(df)


def term_counts(cleaned: DataFrame, text_col: str, n_max: int = 2) -> DataFrame:
    """Corpus count ``tf`` and document count ``df`` per term of cleaned texts."""
    def count(batches):
        for whole in batches:
            for batch in _pieces(whole, "text", BATCH_BYTES):
                terms, tf, df = count_terms(batch.column("text"), n_max)
                for lo in range(0, len(terms), BATCH_TERMS):
                    part = slice(lo, lo + BATCH_TERMS)
                    yield pa.RecordBatch.from_arrays(
                        [terms.slice(lo, BATCH_TERMS).cast(pa.string()), pa.array(tf[part], pa.int64()),
                         pa.array(df[part], pa.int64())], names=["term", "tf", "df"])
            whole = batch = terms = tf = df = None  # else kept while the next batch is read

    parts = cleaned.select(F.col(text_col).alias("text")).mapInArrow(count, "term string, tf long, df long")
    return parts.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def vocabulary(stats: DataFrame, max_features: int, min_df: int = 1) -> DataFrame:
    """The ``max_features`` terms with the highest corpus count; ties by term.

    One plan at every size: the statistics are written once to the shared
    folder, then ``ordered.top_k`` buckets the terms by (count, first two
    characters) and ranks only the buckets that reach rank k, each in its own
    task (``orderBy().limit(k)`` would merge every partition's k rows in one).
    """
    s = stats.where(F.col("df") >= min_df) if min_df > 1 else stats
    s = cut_lineage(s, "term_stats").withColumn("_neg_tf", -F.col("tf"))
    top = top_k(s, max_features, ["_neg_tf", "term"], ["_neg_tf", F.substring("term", 1, 2)], "_rank")
    return top.drop("_neg_tf", "_rank")


def idf_table(stats_vocab: DataFrame, n_docs: Column | int) -> DataFrame:
    """``(term, idf)`` with smoothed idf ``ln((1+n)/(1+df)) + 1``."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return stats_vocab.select("term", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf_weights(cleaned: DataFrame, text_col: str, key: str, idf: DataFrame, n_max: int = 2) -> DataFrame:
    """K1: ``(key, term, weight)`` of cleaned texts; terms outside the vocabulary drop out.

    The idf table has at most ``max_features`` rows: the tasks get it whole, and weight and
    normalise each document where it is, without a shuffle.
    """
    shared = cleaned.sparkSession.sparkContext.broadcast({r["term"]: r["idf"] for r in idf.collect()})

    def weigh(batches):
        known = shared.value
        for whole in batches:
            for batch in _pieces(whole, "_text", BATCH_BYTES):
                row, term, weight = [], [], []
                for i, text in enumerate(batch.column("_text").to_pylist()):
                    w = {t: n * known[t] for t, n in Counter(_grams(text or "", n_max)).items() if t in known}
                    norm = math.sqrt(sum(x * x for x in w.values()))
                    row += [i] * len(w)
                    term += w
                    weight += [x / norm for x in w.values()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(term, pa.string()),
                                                  pa.array(weight, pa.float64())], names=[key, "term", "weight"])

    rows = cleaned.select(F.col(key), F.col(text_col).alias("_text"))
    schema = StructType([rows.schema[key], StructField("term", StringType()), StructField("weight", DoubleType())])
    return rows.mapInArrow(weigh, schema)


def fit_vocabulary(cleaned: DataFrame, text_col: str, cfg: Config = DEFAULT):
    """Fit on the cleaned training documents: returns ``(idf_df, n_docs)``.

    ``idf_df`` is the vocabulary with its idf, ordered by corpus count.
    """
    vocab = vocabulary(term_counts(cleaned, text_col, cfg.ngram_max), cfg.tfidf_max_features, cfg.min_df)
    n_docs = cleaned.count()
    return idf_table(vocab, n_docs), n_docs
