"""Ordered operators over keys of any size, by a segmented scan.

A window ``partitionBy(key)`` brings all rows of a key into one task. Here rows are dealt
by ranges of (key, order), so that a key with many rows lies in several consecutive
partitions, and written once with the number of their partition. Windows then run inside
(partition, key). What crosses a partition's border is carried by a summary of one row a
partition: its first and its last key, and what the operator needs of them. The summary
grows with the number of partitions, not with rows, keys or time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


@dataclass
class Ranged:
    """Rows by ranges of (``keys``, ``order``), with ``_pid``, their partition. Rows that are
    equal in all of these lie in one partition."""

    rows: DataFrame
    keys: list[str]
    order: list[str]

    @staticmethod
    def of(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> "Ranged":
        by = [*keys, *order]
        dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
        return Ranged(cut_lineage(dealt.withColumn("_pid", F.spark_partition_id()), "ranged"), keys, order)

    def with_rows(self, rows: DataFrame) -> "Ranged":
        """The same ranges with other columns."""
        return Ranged(rows, self.keys, self.order)

    def window(self):
        return Window.partitionBy("_pid", *self.keys).orderBy(*self.order)

    def _key(self) -> Column:
        return F.struct(*[F.col(c) for c in self.keys])

    def ends(self, **values: Column) -> DataFrame:
        """One row a partition: ``_pid, _first, _last`` (its least and greatest key) and for
        each aggregate ``name`` of a key's rows there ``first_<name>``, ``last_<name>``."""
        parts = self.rows.groupBy("_pid", self._key().alias("_k")).agg(F.count(F.lit(1)), *[v.alias(n) for n, v in values.items()])
        return parts.groupBy("_pid").agg(
            F.min("_k").alias("_first"), F.max("_k").alias("_last"),
            *[F.min_by(n, "_k").alias(f"first_{n}") for n in values], *[F.max_by(n, "_k").alias(f"last_{n}") for n in values])

    def carried(self, carry: DataFrame) -> DataFrame:
        """``rows`` with the columns of ``carry`` (one row a partition, with ``_pid``)."""
        return self.rows.join(F.broadcast(carry), "_pid", "left")

    def starts_here(self) -> Column:
        return self._key() == F.col("_first")


def running_max_before(r: Ranged, value: Column, out: str) -> Ranged:
    """``max(value) over (partition by keys order by order rows unbounded preceding and 1
    preceding)``. Null values are ignored, as in SQL; null when no earlier value exists."""
    d = r.with_rows(r.rows.withColumn("_v", value))
    ends = d.ends(v=F.max("_v"))
    p = Window.orderBy("_pid")  # one row a partition
    # the last key's maximum so far, over the partitions that end with it
    so_far = F.max("last_v").over(Window.partitionBy("_last").orderBy("_pid"))
    carry = ends.withColumn("_so_far", so_far).select(
        "_pid", "_first", F.when(F.lag("_last").over(p) == F.col("_first"), F.lag("_so_far").over(p)).alias("_carry"))
    inner = F.max("_v").over(d.window().rowsBetween(Window.unboundedPreceding, -1))
    both = F.greatest(inner, F.when(d.starts_here(), F.col("_carry")))  # of those that are not null
    return r.with_rows(d.carried(carry).withColumn(out, both).drop("_v", "_first", "_carry"))


def neighbours(r: Ranged, columns: list[str]) -> Ranged:
    """Previous and next row of each row within its key (``lag``/``lead``): adds
    ``prev_<c>`` and ``next_<c>`` for every ``c`` of ``columns``."""
    row, place = F.struct(*[F.col(c) for c in columns]), F.struct(*[F.col(c) for c in r.order])
    ends = r.ends(head=F.min_by(row, place), tail=F.max_by(row, place))
    p = Window.orderBy("_pid")  # one row a partition
    carry = ends.select(
        "_pid", "_first", "_last",
        F.when(F.lag("_last").over(p) == F.col("_first"), F.lag("last_tail").over(p)).alias("_before"),
        F.when(F.lead("_first").over(p) == F.col("_last"), F.lead("first_head").over(p)).alias("_after"))
    w = r.window()
    # A struct is never null here, so lag and lead are null exactly at a partition's border.
    prev = F.coalesce(F.lag(row).over(w), F.when(r.starts_here(), F.col("_before")))
    next_ = F.coalesce(F.lead(row).over(w), F.when(r._key() == F.col("_last"), F.col("_after")))
    d = r.carried(carry).withColumn("_prev", prev).withColumn("_next", next_)
    d = d.withColumns({f"prev_{c}": F.col("_prev")[c] for c in columns} | {f"next_{c}": F.col("_next")[c] for c in columns})
    return r.with_rows(d.drop("_prev", "_next", "_before", "_after", "_first", "_last"))
