"""Registry of the checked queries: Spark callables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir)`` returns the canonical DataFrame;
``ORACLE[name]`` is the equivalent DuckDB SQL over the raw parquet views.
Operators without an SQL restatement register no oracle (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources.tables import Tables
from .canonical import canon, sql_canon

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, spec: str | None = None):
    def deco(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return canon(fn(Tables(spark, sf_dir)))
        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql_canon(sql, spec) if spec else sql
        return fn
    return deco


# Importing the modules fills the registry.
from . import q_drift, q_eval, q_features, q_ledgers, q_model, q_monitoring, q_stream, q_text  # noqa: E402,F401
