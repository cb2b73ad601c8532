"""Parquet table access with the schemas asserted at read time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Columns (and types) the operators rely on; extra columns are allowed.
REQUIRED = {
    "events": {"event_id": T.LongType(), "ts": T.TimestampNTZType(), "user_id": T.LongType(),
               "event_type": T.StringType(), "value": T.DoubleType(), "props": T.StringType()},
    "documents": {"doc_id": T.LongType(), "text": T.StringType()},
    "labels": {"doc_id": T.LongType(), "quality": T.IntegerType(), "toxic": T.IntegerType()},
    "part": {"p_partkey": T.LongType(), "p_type": T.StringType(), "p_size": T.IntegerType()},
    "embeddings": {"vec_id": T.LongType(), "embedding": T.ArrayType(T.FloatType())},
    "conversations": {"conv_id": T.LongType(), "turn": T.LongType(), "text": T.StringType()},
    "pages": {"page_id": T.LongType(), "html": T.StringType()},
}


class SchemaError(ValueError):
    pass


class Tables:
    """Lazy parquet tables under one folder (``{root}/{name}.parquet``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            check_schema(df, REQUIRED.get(name, {}), name)
            self._cache[name] = df
        return self._cache[name]


def check_schema(df: DataFrame, required: dict, name: str = "table") -> None:
    fields = {f.name: f.dataType for f in df.schema.fields}
    missing = sorted(set(required) - set(fields))
    if missing:
        raise SchemaError(f"{name}: missing required columns {missing}")
    wrong = sorted(c for c, t in required.items() if fields[c] != t)
    if wrong:
        raise SchemaError(f"{name}: unexpected types for {wrong}")
