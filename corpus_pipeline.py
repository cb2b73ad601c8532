"""Training-data pipeline: five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, language, mixing, substring_dedup, word_table
from tessera.llm.common import cut, free_name, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification does not reject."""
    return language.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return jaccard_join.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of repeated strings; n_chars follows the text."""
    out = substring_dedup.remove_repeats(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each draw of a document: every document at least once, small
    sources up to ``mixing.MAX_EPOCHS`` times on average."""
    out = free_name(docs, "draw")
    return mixing.mix(docs, out=out).drop(out)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every row."""
    return word_table.digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("bpe", encode_bpe),
]

# Language identification, suffix sorting and BPE have no SQL form; the tests
# run the stages against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
