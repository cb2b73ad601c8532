"""Dataset sources and sinks.

Writes go to versioned folders; ``latest`` is resolved at read time as the
greatest version instead of writing the data a second time.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import utc_stamp  # noqa: F401  (D2, re-exported)

SPLITS = ("train", "val", "test")


class MissingSplitsError(FileNotFoundError):
    pass


def normalize_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``sentence``->``text`` only if ``text`` is absent, ``sentiment``->
    ``label`` only if ``label`` is absent; keep only (text, label) present
    (plus the ``keep`` key columns)."""
    cols = set(df.columns)
    if "sentence" in cols and "text" not in cols:
        df = df.withColumnRenamed("sentence", "text")
    if "label" not in cols and "sentiment" in cols:
        df = df.withColumnRenamed("sentiment", "label")
    return df.select(*keep, *[c for c in ("text", "label") if c in df.columns])


def union_splits(frames: list[DataFrame]) -> DataFrame:
    """All upstream splits as one dataset (by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def utc_version(now: datetime | None = None) -> str:
    """``YYYYMMDDTHHMMSSZ``."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def write_versioned(df: DataFrame, root: str, name: str, version: str | None = None) -> str:
    """S3: write ``{root}/{name}/version=<stamp>``; returns the path."""
    v = version or utc_version()
    path = f"{root.rstrip('/')}/{name}/version={v}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_latest(spark: SparkSession, root: str, name: str) -> DataFrame:
    """S3: the greatest version (partition discovery on ``version``)."""
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}")
    # Folder names only: the version is a partition column, no data file is read.
    latest = max(p.rsplit("version=", 1)[1].split("/", 1)[0] for p in df.inputFiles())
    return df.where(F.col("version") == latest).drop("version")


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """One folder per split (``partitionBy``), overwritten."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def load_splits(spark: SparkSession, path: str, expected=SPLITS, split_col: str = "split") -> DataFrame:
    """Read the split table; every missing split is named in the error."""
    df = spark.read.parquet(path)
    present = {r[0] for r in df.select(split_col).distinct().collect()}  # at most a few names
    missing = [s for s in expected if s not in present]
    if missing:
        raise MissingSplitsError(f"Missing preprocessed splits: {missing}")
    return df


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows to a table (failures surface, unlike the reference's swallowed
    insert errors). Jobs publish their logs with ``publish`` instead (S8-S10)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_json_report(df: DataFrame, path: str, col: str = "report") -> None:
    """One JSON document per row as text."""
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
