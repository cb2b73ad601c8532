"""Canonical output form shared by the Spark queries and their SQL oracles.

Both engines end every checked query with the same projection: integers as
BIGINT, decimals and floats as DOUBLE rounded to 6 places, timestamps as
``YYYY-MM-DD HH:MM:SS.ffffff`` text and dates as ``YYYY-MM-DD`` text, so a
value hash compares like with like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def canon(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), DIGITS)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


_SQL = {
    "int": "CAST({c} AS BIGINT)",
    "dbl": "round(CAST({c} AS DOUBLE), %d)" % DIGITS,
    "ts": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
    "date": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
    "str": "CAST({c} AS VARCHAR)",
    "bool": "CAST({c} AS BOOLEAN)",
}


def sql_canon(inner: str, spec: str) -> str:
    """Wrap DuckDB SQL ``inner`` in the canonical projection.

    ``spec`` lists ``name:kind`` pairs (kinds: int dbl ts date str bool).
    """
    parts = []
    for item in spec.split():
        name, kind = item.split(":")
        parts.append(_SQL[kind].format(c=f'q."{name}"') + f' AS "{name}"')
    return f"SELECT {', '.join(parts)} FROM (\n{inner}\n) AS q"
