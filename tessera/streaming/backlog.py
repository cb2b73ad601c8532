"""A backlog of event files in bounded micro-batches, in event-time order.

Files of a backlog come in any order and overlap in time. Read one by one, the
watermark runs ahead and drops what comes later; read as one micro-batch, the state
holds all of it. Here a delivery (the files that have come since the last one) is cut
into slices of consecutive time ranges of about ``slice_rows`` rows, and the streaming
query takes one slice after the other, in one checkpoint: its state holds a slice and the
watermark delay.

What is late does not depend on files or slices: a row of a delivery is late if its time
is not after the watermark that the earlier deliveries have left (their greatest time less
the delay). Late rows never reach the query; they are kept in a table of their own, which
``late_rows`` reads. All other rows are admitted, and a query that drops one of them all the same
is an error.

A delivery is read twice: once for the counts of its time buckets, which give the slices, and
once to write all slices, by one job that deals the rows by time range. A slice is
admitted by renaming its folder into the query's source.

Layout under ``root``: ``buckets/<n>``, ``deliveries/<n>.json`` (files, slices and watermark of
delivery n, put there once by ``sources.publish.put_new``), ``late/<n>``, ``sliced/<n>``,
``admitted/<n>-<slice>`` (the query's source), ``taken``, ``checkpoint`` and ``output``. A run
that was stopped goes on where it was: the delivery's plan is fixed, tables are written
as a whole, and the checkpoint knows which slices the query has taken.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.publish import _files, names, put_new
from .stream import finish

SLICE_ROWS = 50_000_000
BUCKET = "1 minute"
EPOCH = datetime(1970, 1, 1)


def _time(us: int) -> datetime:
    return EPOCH + timedelta(microseconds=us)


def source_files(spark: SparkSession, folder: str) -> list[str]:
    """Data files of a folder (names, in order)."""
    return [f"{folder}/{n}" for n in names(spark, folder) if n.endswith(".parquet") and n[0] not in "._"]


class Backlog:
    """Deliveries of ``schema`` files with event time ``ts`` (TIMESTAMP_NTZ), taken by one
    streaming query."""

    def __init__(self, spark: SparkSession, root: str, schema: str, delay: timedelta, ts: str = "ts",
                 slice_rows: int = SLICE_ROWS, bucket: str = BUCKET):
        self.spark, self.root, self.schema, self.ts = spark, root.rstrip("/"), schema, ts
        self.delay, self.slice_rows, self.bucket = delay, slice_rows, bucket

    def deliveries(self) -> list[dict]:
        folder = f"{self.root}/deliveries"
        found = [f"{folder}/{n}" for n in names(self.spark, folder) if n[0].isdigit()]
        rows = self.spark.read.text(found, wholetext=True).collect() if found else []
        return sorted((json.loads(r.value) for r in rows), key=lambda d: d["number"])

    def _rows(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files)

    def _bucket(self):
        return F.unix_micros(F.window(F.col(self.ts).cast("timestamp"), self.bucket)["start"]).alias("start")

    def _late(self, watermark: int | None):
        """Rows not after the watermark, and rows without a time."""
        ts = F.col(self.ts)
        late = F.lit(False) if watermark is None else ts <= F.lit(_time(watermark))
        return F.coalesce(late, F.lit(True)) | ts.isNull()

    def plan(self, files: list[str]) -> dict | None:
        """Fix the next delivery: those of ``files`` that no delivery has. A slice is a run of time
        buckets; its number is the rows before its first bucket by ``slice_rows``."""
        before = self.deliveries()
        files = sorted(set(files) - {f for d in before for f in d["files"]})
        if not files:
            return None
        number = len(before)
        watermark = max((d["greatest"] for d in before if d["greatest"] is not None), default=None)
        if watermark is not None:  # in milliseconds, as the engine counts
            watermark = (watermark // 1000) * 1000 - self.delay // timedelta(microseconds=1)
        greatest = F.max(F.unix_micros(F.col(self.ts).cast("timestamp")))
        counts = (self._rows(files).where(~self._late(watermark)).groupBy(self._bucket())
                  .agg(F.count(F.lit(1)).alias("n"), greatest.alias("greatest")))
        # one row a bucket of time in one window
        rows_before = F.sum("n").over(Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
        counts = counts.withColumn("slice", F.floor(F.coalesce(rows_before, F.lit(0)) / self.slice_rows).cast("int"))
        buckets = f"{self.root}/buckets/{number:06d}"
        counts.write.mode("overwrite").parquet(buckets)
        buckets = self.spark.read.parquet(buckets)
        slices = sorted(r.slice for r in buckets.select("slice").distinct().collect())
        plan = {"number": number, "files": files, "watermark": watermark, "slices": slices,
                "greatest": buckets.agg(F.max("greatest")).first()[0]}
        if not put_new(self.spark, f"{self.root}/deliveries/{number:06d}.json", json.dumps(plan)):
            raise RuntimeError("another run has planned a delivery of this backlog")
        return plan

    def _has(self, path: str) -> bool:
        fs, at = _files(self.spark, path)
        return fs.exists(at(path))

    def slice(self, plan: dict) -> None:
        """Write the late rows and all slices of a delivery, each table as a whole."""
        n, rows, late = f"{plan['number']:06d}", self._rows(plan["files"]), self._late(plan["watermark"])
        if not self._has(f"{self.root}/late/{n}/_SUCCESS"):
            rows.where(late).write.mode("overwrite").parquet(f"{self.root}/late/{n}")
        if not self._has(f"{self.root}/sliced/{n}/_SUCCESS"):
            buckets = self.spark.read.parquet(f"{self.root}/buckets/{n}").select("start", "slice")
            columns = rows.columns
            rows = rows.where(~late).withColumn("start", self._bucket()).join(buckets, "start").select(*columns, "slice")
            (rows.repartitionByRange(self.ts).write.mode("overwrite").partitionBy("slice").parquet(f"{self.root}/sliced/{n}"))

    def admit(self, plan: dict, i: int) -> None:
        source, target = f"{self.root}/sliced/{plan['number']:06d}/slice={i}", f"{self.root}/admitted/{plan['number']:06d}-{i:06d}"
        fs, at = _files(self.spark, target)
        fs.mkdirs(at(f"{self.root}/admitted"))
        if not fs.exists(at(target)) and not fs.rename(at(source), at(target)):
            raise OSError(f"could not admit {source}")

    def late_rows(self) -> DataFrame:
        """Late rows of all deliveries, with ``delivery``, their number."""
        found = names(self.spark, f"{self.root}/late")
        if not found:
            return self.spark.createDataFrame([], f"{self.schema}, delivery int")
        number = F.regexp_extract(F.input_file_name(), r"/late/(\d+)/", 1).cast("int")
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/late/{n}" for n in found]).withColumn("delivery", number)

    def run(self, files: list[str], query, mode: str = "append") -> tuple[DataFrame, list]:
        """Deliver ``files`` to ``query`` (a function of the streaming frame of events) and return
        its output so far, with the progress of each slice."""
        self.plan(files)
        output, schema, progress = f"{self.root}/output", None, []
        for plan in self.deliveries():
            taken = set(names(self.spark, f"{self.root}/taken"))
            open_ = [i for i in plan["slices"] if f"{plan['number']:06d}-{i:06d}" not in taken]
            if open_ or not self._has(f"{self.root}/late/{plan['number']:06d}/_SUCCESS"):
                self.slice(plan)
            for i in open_:
                self.admit(plan, i)
                stream = self.spark.readStream.schema(self.schema).parquet(f"{self.root}/admitted/*")
                out = query(stream.withColumn(self.ts, F.col(self.ts).cast("timestamp")))
                schema = out.schema
                writer = (out.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{self.root}/checkpoint")
                          .trigger(availableNow=True))
                progress.append(finish(lambda: writer.start(output)))  # noqa: B023  (runs at once)
                put_new(self.spark, f"{self.root}/taken/{plan['number']:06d}-{i:06d}", "")
        if schema is None:
            empty = self._rows(plan["files"]).limit(0) if self.deliveries() else self.spark.createDataFrame([], self.schema)
            schema = query(empty.withColumn(self.ts, F.col(self.ts).cast("timestamp"))).schema
        if not names(self.spark, output):
            return self.spark.createDataFrame([], schema), progress
        return self.spark.read.schema(schema).parquet(output), progress
