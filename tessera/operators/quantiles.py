"""Exact interpolated quantiles by distributed selection.

``percentile`` keeps a map of all distinct values and their counts in one task. Here
values are counted (combined on the map side), the counts are dealt by ranges of the
value, of about equally many values each, and written once. The totals of the ranges, one
row a task, say in which range each wanted rank lies, and only those ranges are
read again and summed up in order, each in its own task. A value is one row there however
often it occurs, so no value is a hot one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def quantiles(df: DataFrame, value: Column, qs: dict[str, float], weight: Column | None = None) -> DataFrame:
    """One row: for each name the quantile of ``value`` by linear interpolation between
    the rows of rank ``floor`` and ``ceil`` of ``q * (rows - 1)``, as double (null
    without a row). A row counts ``weight`` times; null values do not count."""
    n = F.count(F.lit(1)) if weight is None else F.sum("w")
    counts = df.select(value.cast("double").alias("v"), *([] if weight is None else [weight.alias("w")])).where("v is not null")
    counts = counts.groupBy("v").agg(n.cast("long").alias("n")).where("n > 0")
    ranged = cut_lineage(counts.repartitionByRange("v").withColumn("range", F.spark_partition_id()), "quantile-counts")
    totals = ranged.groupBy("range").agg(F.sum("n").alias("n"))
    place = Window.orderBy("range")  # one row a task
    totals = totals.select("range", "n", (F.sum("n").over(place) - F.col("n")).alias("before"),
                           F.sum("n").over(Window.partitionBy()).alias("rows"))
    place = lambda q: F.lit(q) * (F.col("rows") - 1)
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), f(place(q)).cast("long").alias("rank"),
                                (place(q) - F.floor(place(q))).alias("part"))
                       for name, q in qs.items() for side, f in (("low", F.floor), ("high", F.ceil))])
    targets = totals.select("range", "before", "n", F.explode(wanted).alias("t")).select("range", "before", "n", "t.*")
    targets = targets.where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))).drop("n")
    inside = ranged.join(F.broadcast(targets.select("range").distinct()), "range", "left_semi")  # two ranges a quantile
    upto = F.sum("n").over(Window.partitionBy("range").orderBy("v"))
    inside = inside.select(F.col("range").alias("r"), "v", (upto - F.col("n")).alias("first"), upto.alias("end"))
    rank = F.col("rank") - F.col("before")
    hit = inside.join(F.broadcast(targets), (F.col("r") == F.col("range")) & (F.col("first") <= rank) & (rank < F.col("end")))
    at = {(name, side): F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("v")))
          for name in qs for side in ("low", "high")}
    part = {name: F.max(F.when(F.col("name") == name, F.col("part"))) for name in qs}
    return hit.agg(*[(at[name, "low"] + (at[name, "high"] - at[name, "low"]) * part[name]).alias(name) for name in qs])
