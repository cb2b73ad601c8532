"""Math helpers (M1-M3) as higher-order array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def _with(values: Column, other: Column) -> Column:
    """``other``, evaluated once a row, next to every value. (A lambda that names it
    would evaluate it again for every element.)"""
    return F.array_repeat(other, F.size(values))


def softmax(scores: str | Column) -> Column:
    """Softmax of a score array, max subtracted first for stability."""
    s = _c(scores)
    e = F.zip_with(s, _with(s, F.array_max(s)), lambda x, m: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.zip_with(e, _with(s, total), lambda x, t: x / t)


def argmax(values: str | Column) -> Column:
    """0-based index of the largest value; the first wins ties."""
    v = _c(values)
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")


def softmax_argmax(scores: str | Column) -> tuple[Column, Column]:
    """M1: (winning class, its softmax probability). The winner's exponential is 1, so
    its share is one over the sum; one pass over the scores."""
    s = _c(scores)
    e = F.zip_with(s, _with(s, F.array_max(s)), lambda x, m: F.exp(x - m))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return argmax(s), F.when(F.size(s) > 0, 1.0 / total)


def round_half_even(x: str | Column, digits: int = 4) -> Column:
    """M3: Python-style rounding (half to even) for reported confidences."""
    return F.bround(_c(x), digits)
