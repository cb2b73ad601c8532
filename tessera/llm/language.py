"""Operator 3: language identification with averaged hashed subword embeddings.

Model. A text is lower-cased; every character that is not a letter becomes a
word border. Each run of 2, 3 and 4 characters that holds a letter is hashed to
one of ``2**BITS`` buckets. The text's vector is the mean of its buckets'
embeddings, and a linear softmax over it gives the languages. Both layers are
trained together by stochastic gradient descent in numpy.

Calibration. Every fifth row of the sample does not train the layers; on these one
temperature is fitted by likelihood (one row more counted as wrong). The rejection score
is a text's familiarity: the mean log frequency of its buckets in the sample (all
languages with equal weight), less its mean over the sample's rows, each judged by all
others, and in units of their spread for as many runs. A text is rejected if its
familiarity is below the threshold. That lies half as far again from the mean
as the value that ``REJECT_RATE`` of those rows are below, so fewer than that share of
texts like the training rows are rejected, but not below the familiarity that 95 % of
unseen languages have: for every language, its rows judged by the other languages. A text
half in one learned language and half in another is as familiar as either.

The sample is bounded in rows: ``PER_LANG`` a language, ``SAMPLE_ROWS`` in all, fewer if their
buckets are more than ``SAMPLE_BUCKETS`` in all (one a language at least); the same rows for the same
table (lowest hash). Sampled rows are read whole: a task turns a text into its buckets and
their counts. Every language with a labelled text that has a letter is learned.
Prediction reads every whole text. As the mean and the linear layer commute,
workers get one table ``buckets x languages`` (``2**BITS`` rows).

A null text, or one without a letter, is ``und`` with score 0 and rejected. Rows
with a null or blank lang, or a null doc_id, train nothing. If no row is labelled every
text is ``und``. Equal scores go to the language that sorts first. Very long texts are
read whole; repeated rows train once and are predicted each.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, free_name, slices, small_batches, table

BITS = 16
DIM = 16
ORDERS = (2, 3, 4)
PER_LANG = 600
SAMPLE_ROWS = 6000  # over all languages
SAMPLE_BUCKETS = 24_000_000  # different buckets of a row, summed over the rows: 150 MB
MAX_LANGS = 1000
EPOCHS = 6
RATE = 0.8
REJECT_RATE = 0.001
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[c for c in range(0x110000) if chr(c).isalpha()]] = True
    return out


def features(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket of the run that starts at each position (``2**BITS`` where there is
    none), for each order; offsets of the texts; whether a text has a letter."""
    low = [t.lower() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    cp = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[cp]
    sums = np.concatenate([[0], np.cumsum(letter)])
    has = sums[offsets[1:]] > sums[offsets[:-1]]
    c = np.where(letter, cp, 1).astype(np.uint32)
    n = len(c)
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n)  # characters to the text's end
    out = []
    for order in ORDERS:
        h = np.full(max(n - order + 1, 0), order, np.uint32)
        for k in range(order):
            h = h * np.uint32(0x01000193) ^ c[k:k + len(h)]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        at = np.full(n, 1 << BITS, np.int32)
        at[:len(h)] = h >> np.uint32(32 - BITS)
        some = sums[np.minimum(np.arange(n) + order, n)] > sums[:-1]
        at[(left < order) | ~some] = 1 << BITS
        out.append(at)
    return out, offsets, has


def text_sums(orders: list[np.ndarray], offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``weights[bucket]`` over each text and the number of its runs.
    ``weights`` has a zero row at the end for positions without a run."""
    n, width = len(offsets) - 1, weights.shape[1]
    sums, counts = np.zeros((n, width)), np.zeros(n, np.int64)
    step = max(1, (1 << 22) // width)
    for at in orders:
        some = np.concatenate([[0], np.cumsum(at < (1 << BITS))])
        counts += some[offsets[1:]] - some[offsets[:-1]]
        for lo in range(0, len(at), step):
            hi = min(lo + step, len(at))
            first = int(np.searchsorted(offsets, lo, side="right")) - 1
            last = int(np.searchsorted(offsets, hi, side="left"))
            rows = np.arange(first, last)
            rows = rows[offsets[rows + 1] > offsets[rows]]  # empty texts have no positions
            begin = np.maximum(offsets[rows], lo) - lo
            sums[rows] += np.add.reduceat(weights[at[lo:hi]], begin, axis=0)
    return sums, counts


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Bag:
    """Different buckets of a text and how often each occurs."""

    ids: np.ndarray
    counts: np.ndarray

    @staticmethod
    def of(text: str) -> "Bag":
        orders, _, _ = features([text])
        ids = np.concatenate(orders)
        ids, counts = np.unique(ids[ids < (1 << BITS)], return_counts=True)
        return Bag(ids.astype(np.uint16), counts.astype(np.uint32))


def bag_means(bags: list[Bag], table: np.ndarray) -> np.ndarray:
    """Mean of ``table[bucket]`` over the runs of each bag."""
    return np.array([b.counts @ table[b.ids] / max(int(b.counts.sum()), 1) for b in bags])


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # (2**BITS + 1) x (languages + 1): embeddings times softmax layer, log frequency
    bias: np.ndarray
    temperature: float = 1.0
    usual: float = 0.0  # mean log frequency of calibration rows
    spread: tuple[float, float] = (1.0, 0.0)  # variance of it: a + b / runs
    threshold: float = -np.inf

    def familiarity(self, mean: np.ndarray, runs: np.ndarray) -> np.ndarray:
        return (mean - self.usual) / np.sqrt(self.spread[0] + self.spread[1] / np.maximum(runs, 1))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected."""
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        orders, offsets, has = features(texts)
        sums, runs = text_sums(orders, offsets, self.weights)
        means = sums / np.maximum(runs, 1)[:, None]
        p = softmax((means[:, :-1] + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(has, p.max(axis=1), 0.0)
        lang = [self.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has.tolist())]
        return lang, score, ~has | (self.familiarity(means[:, -1], runs) < self.threshold)


def _bucket_counts(bags: list[Bag], y: np.ndarray, k: int) -> np.ndarray:
    """Runs of every bucket in the rows of each language, smoothed."""
    out = np.full((k, 1 << BITS), 0.5)
    for b, lang in zip(bags, y):
        out[lang, b.ids] += b.counts
    return out


def _without(bag: Bag, lang: int, own: np.ndarray, totals: np.ndarray) -> float:
    """Mean log frequency of a training row's buckets in all other rows."""
    n = bag.counts.sum()
    share = own[:, bag.ids] / totals[:, None]
    share[lang] = (own[lang, bag.ids] - bag.counts) / (totals[lang] - n)
    return float(bag.counts @ np.log(share.mean(axis=0)) / n)


def train(bags: list[Bag], langs: list[str], seed: int = 7) -> Model:
    """Fit on the bags of labelled texts; every fifth row of a language calibrates."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros(((1 << BITS) + 1, 1), np.float32), np.zeros(0))
    rng = np.random.default_rng(seed)
    y = np.searchsorted(names, langs)
    rank = np.zeros(len(y), np.int64)
    for k in range(len(names)):
        rank[y == k] = np.arange((y == k).sum())
    held = rank % 5 == 4
    use = np.flatnonzero(~held & np.array([len(b.ids) > 0 for b in bags], bool))
    emb = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM))
    out, bias = np.zeros((DIM, len(names))), np.zeros(len(names))
    batch, steps = 32, max(1, EPOCHS * -(-len(use) // 32))
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(use), max(1, -(-len(use) // batch))):
            if not len(rows):
                continue
            rate = RATE * (1 - step / steps)
            step += 1
            lens = np.array([len(bags[r].ids) for r in rows])
            flat, row = np.concatenate([bags[r].ids for r in rows]), np.repeat(np.arange(len(rows)), lens)
            share = np.concatenate([bags[r].counts / bags[r].counts.sum() for r in rows])[:, None]
            hidden = np.add.reduceat(share * emb[flat], np.cumsum(lens) - lens, axis=0)
            g = softmax(hidden @ out + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            back = g @ out.T
            out -= rate * hidden.T @ g / len(rows) * DIM
            bias -= rate * g.mean(axis=0)
            np.subtract.at(emb, flat, rate * DIM * share * back[row])
    some = np.flatnonzero([len(b.ids) > 0 for b in bags])
    own = _bucket_counts([bags[r] for r in some], y[some], len(names))
    often = np.log((own / own.sum(axis=1, keepdims=True)).mean(axis=0))
    weights = np.concatenate([emb @ out, often[:, None]], axis=1)
    model = Model(names, np.concatenate([weights, np.zeros((1, len(names) + 1))]).astype(np.float32), bias)
    cal = np.flatnonzero(held & np.array([len(b.ids) > 0 for b in bags], bool))
    if len(cal):
        means = bag_means([bags[i] for i in cal], model.weights[:, :-1])
        model.temperature = _temperature(means + bias, y[cal])
    if len(some):
        _set_threshold(model, [bags[i] for i in some], y[some], own)
    return model


def _temperature(z: np.ndarray, y: np.ndarray) -> float:
    # One row more is counted as wrong, so that rows which are all right still have a best temperature.
    wrong = 1 / (len(y) + 2)

    def loss(t):
        p = np.log(np.maximum(softmax(z / t), 1e-300))
        return -((1 - wrong) * p[np.arange(len(y)), y] + wrong * p.mean(axis=1)).mean()

    grid = np.geomspace(0.005, 100, 120)
    return float(grid[int(np.argmin([loss(t) for t in grid]))])


def _set_threshold(model: Model, bags: list[Bag], y: np.ndarray, own: np.ndarray) -> None:
    """Usual familiarity and rejection threshold: every row is judged by the counts of
    all others, and by those of the other languages."""
    totals = own.sum(axis=1)
    runs = np.array([b.counts.sum() for b in bags], float)
    seen = np.array([_without(b, k, own, totals) for b, k in zip(bags, y)])
    model.usual = float(seen.mean())
    square = (seen - model.usual) ** 2
    # variance a + b / runs by least squares, neither below zero
    a, b = np.linalg.lstsq(np.stack([np.ones(len(runs)), 1 / runs], axis=1), square, rcond=None)[0]
    a, b = (square.mean(), 0.0) if b < 0 else (0.0, (square * runs).mean()) if a < 0 else (a, b)
    model.spread = (float(max(a, 1e-6)), float(max(b, 1e-6)))
    known = float(np.quantile(model.familiarity(seen, runs), REJECT_RATE))
    model.threshold = 1.5 * min(known, 0.0)
    if len(model.langs) > 1:
        unseen = []
        for k in range(len(model.langs)):
            mine = np.flatnonzero(y == k)
            others = np.delete(own, k, axis=0)
            without = np.log((others / others.sum(axis=1, keepdims=True)).mean(axis=0))
            unseen.append(model.familiarity(bag_means([bags[i] for i in mine], without), runs[mine]))
        model.threshold = max(model.threshold, min(known, float(np.quantile(np.concatenate(unseen), 0.95))))


def fold(doc_id) -> F.Column:
    """crc32 of the doc_id as text, mod 4."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _bags(batches):
    """Rows ``lang, h, text`` -> ``lang, h, ids, counts`` of the whole text."""
    for whole in batches:
        for batch in slices(whole, "text"):
            bags = [Bag.of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("h"), pa.array([b.ids.tobytes() for b in bags], pa.binary()),
                 pa.array([b.counts.tobytes() for b in bags], pa.binary())], names=["lang", "h", "ids", "counts"])


def sample(docs: DataFrame) -> tuple[list[Bag], list[str]]:
    """The training rows: of each language the ``PER_LANG`` rows of lowest hash.

    Languages are counted first. A language's share of rows wanted gives a bound
    on the hash, so that about ``PER_LANG`` rows of it are read (its row of
    lowest hash in any case) and no language is sorted anywhere.
    """
    rows = documents(docs, "lang").where(
        (fold(F.col("doc_id")) != 2) & (F.trim("lang") != "") & F.col("text").rlike(r"\p{L}")).select(
        "text", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id", "text").alias("h"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("h").alias("least")).limit(MAX_LANGS + 1).collect()
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not counts:
        return [], []
    per_lang = max(1, min(PER_LANG, SAMPLE_ROWS // len(counts)))
    share = lambda n: min(1.0, (per_lang + 50) / n)
    bounds = [(r["lang"], max(r["least"], min((1 << 63) - 1, int(share(r["n"]) * (1 << 64)) - (1 << 63)))) for r in counts]
    bounds = docs.sparkSession.createDataFrame(bounds, "l string, bound long")  # a row a language
    few = rows.join(F.broadcast(bounds), F.col("lang") == F.col("l")).where(F.col("h") <= F.col("bound"))
    few = few.select("lang", "h", "text").dropDuplicates(["lang", "h"])  # repeated rows once
    few = cut(few.mapInArrow(_bags, "lang string, h long, ids binary, counts binary"), "language-sample")
    # The rows of lowest hash of each language, until its share of the buckets is used up.
    order = Window.partitionBy("lang").orderBy("h")
    few = few.withColumn("rank", F.row_number().over(order)).withColumn(
        "before", F.coalesce(F.sum(F.length("ids") / 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    few = few.where((F.col("rank") <= per_lang) & (F.col("before") < SAMPLE_BUCKETS / len(counts)))
    got = sorted(few.select("lang", "h", "ids", "counts").collect(), key=lambda r: (r["lang"], r["h"]))
    return [Bag(np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["counts"], np.uint32)) for r in got], [r["lang"] for r in got]


def fit(docs: DataFrame) -> Model:
    return train(*sample(docs))


def classify(df: DataFrame, model: Model, out: str = "language") -> DataFrame:
    """``df`` with a struct ``out`` (lang, score, rejected) from its ``text``."""
    if free_name(df, out) != out:
        raise ValueError(f"the input has a column {out}; name another")
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages

    def predict(batches):
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
        for whole in batches:
            for batch in slices(whole, "text"):
                lang, score, rejected = shared.value.predict([t or "" for t in batch.column("text").to_pylist()])
                got = pa.StructArray.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], fields=list(kind))
                yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, out])

    from pyspark.sql import types as T
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StructType([
        T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType())]))])
    return df.mapInArrow(predict, schema)


def accepted(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without the rows that the model trained on them rejects."""
    out = free_name(docs, "language")
    return classify(docs, fit(docs), out).where(~F.col(out)["rejected"]).drop(out)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = classify(documents(docs), fit(docs))
    return got.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"),
                      F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
                      F.col("language.rejected").alias("rejected"))
