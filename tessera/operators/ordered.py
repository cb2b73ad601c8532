"""Ranks without ranking a whole key in one task: bucketed row numbers, quota cutoffs
and global top-k. (Lag, lead and running maxima are in ``segments``.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def exact_rank(df: DataFrame, part_cols: list[str], order_cols: list[str],
               bucket_col: str, out: str) -> DataFrame:
    """``row_number() over (partition by part order by order_cols)``, exactly.

    ``bucket_col`` must be non-decreasing along ``order_cols`` (for example
    a prefix of the ordering hash). Rank = rows of the key in earlier
    buckets + row number inside ``(key, bucket)``; the offsets table has one
    row per (key, bucket).
    """
    counts = df.groupBy(*part_cols, bucket_col).agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*part_cols).orderBy(bucket_col)
         .rowsBetween(Window.unboundedPreceding, -1))
    offs = counts.select(*[F.col(c).alias(f"_k_{c}") for c in part_cols],
                         F.col(bucket_col).alias("_k_bucket"),
                         F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    cond = df[bucket_col].eqNullSafe(offs["_k_bucket"])
    for c in part_cols:
        cond = cond & df[c].eqNullSafe(offs[f"_k_{c}"])
    wr = Window.partitionBy(*part_cols, bucket_col).orderBy(*order_cols)
    return (df.join(offs, cond).withColumn(out, F.col("_off") + F.row_number().over(wr))
            .drop("_off", "_k_bucket", *[f"_k_{c}" for c in part_cols]))


def _boundary(counts: DataFrame, by: list[str], carried: list[str]) -> DataFrame:
    """The group of ``counts`` (``_part, _i, _need, by, _n`` and ``carried``) in which
    row ``_need`` of class and quota falls, with the number of its rows wanted."""
    before = Window.partitionBy("_part", "_i").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    off = F.coalesce(F.sum("_n").over(before), F.lit(0))
    return (counts.withColumn("_off", off).where((F.col("_need") > F.col("_off")) & (F.col("_need") <= F.col("_off") + F.col("_n")))
            .select("_part", "_i", *carried, *by, (F.col("_need") - F.col("_off")).alias("_need"), "_n"))


def _counted(rows: DataFrame, edge: DataFrame, at: list[str], by: list[str]) -> DataFrame:
    """Rows of the edge's groups (equal in class and ``at``), counted by ``by``."""
    e = edge.select(F.col("_part").alias("_p2"), "_i", F.col("_need"), *[F.col(c).alias(f"{c}2") for c in at])
    cond = F.col("_part").eqNullSafe(F.col("_p2"))
    for c in at:
        cond = cond & F.col(c).eqNullSafe(F.col(f"{c}2"))
    keys = ["_part", "_i", "_need", *dict.fromkeys([*at, *by])]
    return rows.join(e, cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def rank_cutoffs(rows: DataFrame, quotas: list[Column], total_col: str = "_total", prefix: int = 4) -> DataFrame:
    """The row of rank ``quota`` in ``row_number() over (partition by _part
    order by _h, _key, _row)``, for each quota, without ranking a class.

    ``rows``: class ``_part``, hex hash ``_h``, ``_key`` and ``_row``, a struct of hashes
    over all columns whose first field is a long: only rows that are equal in every column
    have equal ``(_h, _key, _row)``. Rows are counted by hash prefix; the running count says
    in which bucket a quota falls. That bucket's rows are counted by ``(_h, _key)``, and
    where a quota falls inside rows of one key, these are counted by prefix of the row
    hash and then by row hash. All are counts combined on the map side: no task sees
    a class, or all rows of a key.

    ``quotas`` are expressions over ``total_col``, the class's row count. Returns
    a row for each class and quota (number ``_i``) of at least 1: ``_part, _i, _h, _key,
    _row, _take, _n``: ``_take`` of the ``_n`` rows equal to this one are inside, all rows before
    it too. ``_row`` is null where all rows of ``_key`` are inside. A quota beyond the
    class gives its last row. Nulls are a class, and a key, of their own.
    """
    d = rows.withColumn("_b", F.substring("_h", 1, prefix))
    counts = d.groupBy("_part", "_b").agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy("_part")).alias(total_col)
    wanted = F.posexplode(F.array(*[F.least(q.cast("long"), F.col(total_col)) for q in quotas])).alias("_i", "_need")
    buckets = counts.select("_part", "_b", "_n", total).select("_part", "_b", "_n", wanted)
    edge = _boundary(buckets, ["_b"], [])
    edge = cut_lineage(_boundary(_counted(d, edge, ["_b"], ["_h", "_key"]), ["_h", "_key"], []), "quota-keys")
    none = F.lit(None).cast(d.schema["_row"].dataType)
    found = edge.select("_part", "_i", "_h", "_key", none.alias("_row"), F.col("_need").alias("_take"), "_n")
    split = edge.where("_need < _n")
    if not split.limit(1).count():  # every quota ends with the last row of a key
        return found
    d = d.withColumn("_rb", F.shiftright(F.col("_row").getField(d.schema["_row"].dataType.names[0]), 48))
    at = ["_h", "_key"]
    edge = _boundary(_counted(d, split, at, ["_rb"]), ["_rb"], at)
    at = [*at, "_rb"]
    edge = _boundary(_counted(d, edge, at, ["_row"]), ["_row"], ["_h", "_key"])
    return cut_lineage(found.where("_take = _n").unionByName(
        edge.select("_part", "_i", "_h", "_key", "_row", F.col("_need").alias("_take"), "_n")), "quota-rows")


def top_k(df: DataFrame, k: int, order_cols: list, bucket_cols: list, out: str = "rank") -> DataFrame:
    """Exact global top-``k`` with its rank, without funnelling into one task.

    ``order_cols`` are ascending sort columns (negate a column for
    descending) that totally order the rows; ``bucket_cols`` are two coarse,
    order-preserving prefixes of them. A count per first prefix, and inside it
    per second, gives each bucket's offset; buckets starting at or beyond
    ``k`` are dropped before any ranking, and the rest are ranked inside
    ``bucket`` windows in parallel. Only the counts of the first prefix (for a
    vocabulary: the distinct term counts) are ordered in one window. At most ``k`` buckets
    begin before rank ``k``, so they are broadcast and no other row is shuffled.
    """
    first, second = (F.col(c) if isinstance(c, str) else c for c in bucket_cols)
    d = df.withColumn("_b1", first).withColumn("_b2", second)
    counts = d.groupBy("_b1", "_b2").agg(F.count(F.lit(1)).alias("_n"))
    outer = counts.groupBy("_b1").agg(F.sum("_n").alias("_n1"))
    w1 = Window.orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
    outer = (outer.select(F.col("_b1").alias("_k1"), F.coalesce(F.sum("_n1").over(w1), F.lit(0)).alias("_off1"))
             .where(F.col("_off1") < k))
    w2 = Window.partitionBy("_b1").orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)
    offs = (counts.join(F.broadcast(outer), counts["_b1"].eqNullSafe(outer["_k1"]))
            .select("_k1", F.col("_b2").alias("_k2"),
                    (F.col("_off1") + F.coalesce(F.sum("_n").over(w2), F.lit(0))).alias("_off"))
            .where(F.col("_off") < k))
    j = d.join(F.broadcast(offs), d["_b1"].eqNullSafe(offs["_k1"]) & d["_b2"].eqNullSafe(offs["_k2"]))
    wr = Window.partitionBy("_b1", "_b2").orderBy(*order_cols)
    r = j.withColumn(out, F.col("_off") + F.row_number().over(wr))
    return r.where(F.col(out) <= k).drop("_off", "_k1", "_k2", "_b1", "_b2")
