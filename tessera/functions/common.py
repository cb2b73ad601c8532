"""Small column helpers shared by the operators."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal (no session-zone shift)."""
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def date_lit(value: date) -> Column:
    return F.expr(f"DATE '{value.isoformat()}'")


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` with 0 for a zero or null denominator (ANSI-safe)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def det_id(*parts: Column | str) -> Column:
    """Deterministic row id: sha256 of the parts joined by ':'.

    Replaces database-generated UUIDs; stable across recomputation and task
    retries, unlike ``uuid()``.
    """
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.sha2(F.concat_ws(":", *[c.cast("string") for c in cols]), 256)


def one_row(*frames):
    """Frames of one row each, side by side, without a join."""
    cols = [c for f in frames for c in f.columns]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def spread(scan, key: str):
    """A table as read, dealt by ``key`` to the cluster's cores if its files give fewer
    tasks than that (a few large files), as it is otherwise. For CPU-heavy row work."""
    if scan.isStreaming:
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan
