"""Training, evaluation and scoring with Spark ML.

Features: the vocabulary and idf are fitted as DataFrame aggregates
(``features.fit_vocabulary``); the fitted vocabulary (at most
``max_features`` terms, the model's own size) builds a
``CountVectorizerModel``, the ``+1`` smoothed idf is applied with
``ElementwiseProduct`` (Spark's ``IDF`` has no ``+1``), then ``Normalizer``.
All stages are row-local, so transforming a batch or a stream never shuffles.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions.common import det_id
from ..functions.text import clean_text
from ..functions.mathx import argmax, round_half_even
from ..session import cut_lineage
from ..sources.publish import names, put_new
from . import evaluate as EV
from .features import fit_vocabulary, with_grams

# Label texts.
LABELS = {0: "negative", 1: "positive"}


@dataclass
class Candidate:
    model_type: str
    run_id: str
    model: PipelineModel
    metrics: dict


def _feature_stages(vocab: list[str], idf: list[float]) -> list:
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="grams", outputCol="tf")
    scale = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="tf", outputCol="tfidf")
    norm = Normalizer(p=2.0, inputCol="tfidf", outputCol="features")
    return [cv, scale, norm]


def fit_candidates(train: DataFrame, cfg: Config = DEFAULT, key: str = "doc_id",
                   label: str = "label", only: tuple[str, ...] | None = None) -> dict[str, tuple[PipelineModel, float]]:
    """K2/K4: fit the TF-IDF + logistic regression baseline and a second
    candidate (multinomial naive Bayes on term counts) on ``train``.

    ``regParam = 1 / (C * n_train)`` is the reference's ``C`` rewritten for
    Spark's mean-loss objective; standardization is a config choice (README).
    """
    g = with_grams(train, "text", "grams", cfg.ngram_max).withColumn("label_d", F.col(label).cast("double"))
    idf_df, n = fit_vocabulary(train.select(clean_text("text").alias("clean")), "clean", cfg)
    rows = idf_df.collect()  # bounded by max_features: this is the model itself
    vocab = [r["term"] for r in rows]
    idf = [float(r["idf"]) for r in rows]
    # Feature stages are built once for both classifiers (moving the vocabulary to the JVM is a
    # one-time driver cost per model, independent of the data size).
    feat_model = Pipeline(stages=_feature_stages(vocab, idf)).fit(g)
    counter, *weigh = feat_model.stages
    # Only term counts are kept, never n-grams (many times the text), and only for the
    # logistic regression, which reads them twice and then keeps its own blocks. Naive
    # Bayes alone reads its rows once.
    tf = counter.transform(g).select("tf", "label_d")
    wanted = [x for x in ("baseline_tfidf_logreg", "naive_bayes_counts") if only is None or x in only]
    kept = "baseline_tfidf_logreg" in wanted
    if kept:
        tf.persist()
    out = {}
    lr = LogisticRegression(featuresCol="features", labelCol="label_d",
                            regParam=1.0 / (cfg.logreg_C * max(n, 1)), elasticNetParam=0.0,
                            maxIter=cfg.logreg_max_iter, standardization=cfg.logreg_standardize)
    nb = NaiveBayes(featuresCol="tf", labelCol="label_d", modelType="multinomial", smoothing=1.0)
    for name in wanted:
        t0 = time.time()
        if name == "baseline_tfidf_logreg":
            fitted = lr.fit(PipelineModel(stages=weigh).transform(tf).select("features", "label_d"))
        else:
            fitted = nb.fit(tf)
        out[name] = (PipelineModel(stages=feat_model.stages + [fitted]), time.time() - t0)
    if kept:
        tf.unpersist()
    return out


def _predict_grams(model: PipelineModel, g: DataFrame, digits: int = 4) -> DataFrame:
    p = model.transform(g).withColumn("_prob", vector_to_array("probability"))
    idx = argmax("_prob")
    return (p.withColumn("pred_class", idx)
            .withColumn("confidence", round_half_even(F.element_at("_prob", idx + 1), digits))
            .withColumn("predicted_sentiment",
                        F.when(idx == 0, LABELS[0]).when(idx == 1, LABELS[1])
                         .otherwise(idx.cast("string")))
            .drop("grams", "tf", "tfidf", "features", "rawPrediction", "probability", "_prob",
                  "prediction"))


def predict(model: PipelineModel, df: DataFrame, text_col: str = "text", digits: int = 4) -> DataFrame:
    """Winning class, its probability (4 places) and label text."""
    return _predict_grams(model, with_grams(df, text_col, "grams"), digits)


def evaluate_model(model: PipelineModel, test: DataFrame, label: str = "label") -> dict:
    """K7: metrics dict of a model on a labelled frame."""
    p = predict(model, test).select(F.col(label).alias("y_true"), F.col("pred_class").alias("y_pred"))
    return EV.evaluate(p).first().asDict()


def data_version(splits: DataFrame) -> str:
    """Fingerprint of a labelled split table: its rows in any order."""
    row = splits.agg(F.count(F.lit(1)).alias("n"),
                     F.sum(F.xxhash64(*sorted(splits.columns)).cast("decimal(38,0)")).alias("h")).first()
    return f"{row['n']}-{row['h']}"


def train_and_evaluate(splits: DataFrame, cfg: Config = DEFAULT, attempt: str = "") -> list[Candidate]:
    """K3: fit both candidates on train, evaluate on test; metrics include the
    training time, feature count, validation size, and for the logistic
    regression its iterations and whether it converged within the limit.

    A run id names the candidate, the data, the configuration and the attempt,
    so a retrained model never takes another one's name.

    The split table is the one intermediate read by fitting, validation and
    both evaluations, so it is written once to the shared checkpoint folder.
    """
    splits = cut_lineage(splits, "splits")
    train = splits.where(F.col("split") == "train")
    test = with_grams(splits.where(F.col("split") == "test").select("label", "text"), "text", "grams")
    n_val = splits.where(F.col("split") == "val").count()
    version = data_version(splits)
    out = []
    for mtype, (model, secs) in fit_candidates(train, cfg).items():
        p = _predict_grams(model, test).select(F.col("label").alias("y_true"),
                                               F.col("pred_class").alias("y_pred"))
        m = EV.evaluate(p).first().asDict()
        m.update(training_time=secs, n_features=len(model.stages[0].vocabulary),
                 validation_rows=n_val)
        solver = model.stages[-1]
        if getattr(solver, "hasSummary", False):
            m["iterations"] = int(solver.summary.totalIterations)
            m["converged"] = m["iterations"] < cfg.logreg_max_iter
        run_id = hashlib.sha256(f"{mtype}|{cfg!r}|{version}|{attempt}".encode()).hexdigest()[:32]
        out.append(Candidate(mtype, run_id, model, m))
    return out


def log_rows(scored: DataFrame, raw_text_col: str, key_cols: list[str],
             model_version: str | None, model_name: str, scored_at, batch_id: str) -> DataFrame:
    """Prediction-log rows of a scored batch.

    Hash and length are of the raw text; a null version logs as ``unknown``.
    Per-request latency does not exist for a batch: ``latency_ms`` is 0 and
    ``batch_id``/``scored_at`` identify the run.
    """
    return scored.select(
        det_id(F.lit(batch_id), *key_cols).alias("id"),
        *key_cols,
        F.sha2(F.col(raw_text_col), 256).alias("input_text_hash"),
        F.char_length(raw_text_col).cast("int").alias("input_length"),
        "predicted_sentiment",
        F.col("confidence").cast("decimal(5,4)").alias("confidence"),
        F.coalesce(F.lit(model_version), F.lit("unknown")).alias("model_version"),
        F.lit(model_name).alias("model_name"),
        F.lit(0).alias("latency_ms"),
        F.lit(scored_at).cast("timestamp_ntz").alias("created_at"),
        F.lit(batch_id).alias("batch_id"))


def _marker(models_root: str, run_id: str) -> str:
    return f"{models_root.rstrip('/')}/complete/{run_id}"


def saved_model(spark: SparkSession, models_root: str, run_id: str) -> str | None:
    """Folder of the run's complete model; None if no save has ended."""
    if run_id not in names(spark, f"{models_root.rstrip('/')}/complete"):
        return None
    folder = spark.read.text(_marker(models_root, run_id), wholetext=True).first().value
    return f"{models_root.rstrip('/')}/{folder}"


def save_model(model: PipelineModel, models_root: str, run_id: str) -> str:
    """Save a run's model once; returns its folder. The model is written to a folder of
    this attempt, and a marker that names the folder comes last, so a save that was
    stopped half-way is not there for readers and the retry makes a new one. A model
    that is marked is that run's (same data, configuration and attempt) and stays."""
    spark = SparkSession.getActiveSession()
    if (path := saved_model(spark, models_root, run_id)) is None:
        folder = f"{run_id}-{uuid.uuid4().hex}"
        model.write().save(f"{models_root.rstrip('/')}/{folder}")
        put_new(spark, _marker(models_root, run_id), folder)  # false if another attempt was first
        path = saved_model(spark, models_root, run_id)
    return path


def load_model(spark: SparkSession, models_root: str, run_id: str) -> PipelineModel:
    path = saved_model(spark, models_root, run_id)
    if path is None:
        raise LookupError(f"no complete model of run {run_id} under {models_root}")
    return PipelineModel.load(path)


def load_production(ledger: DataFrame, models_root: str, name: str) -> tuple[str, PipelineModel]:
    """The newest Production version of ``name`` (at most one row, by
    construction of the ledger) and its saved model; an error when none."""
    row = (ledger.where((F.col("name") == name) & (F.col("stage") == "Production"))
           .agg(F.max_by(F.struct("version", "run_id"), "version").alias("v")).first()["v"])
    if row is None:
        raise LookupError(f"No Production version for model '{name}'.")
    return str(row["version"]), load_model(ledger.sparkSession, models_root, row["run_id"])
