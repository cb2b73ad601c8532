"""Sessions (X3) and rate windows (X4) of whole tables, for users of any size.

The streaming forms keep a user's open session or window as one state; a user with most of
the rows is one task there. Over a table the rows are dealt by ranges of (user, time)
(``segments``), so such a user lies in many partitions, and what crosses a border is carried.

Sessions need the previous row and the latest session start, both segmented scans.

Rate windows are a chain: a window opens at the first hit after the last one has ended.
Inside a partition the chain is followed from a given start. For a user that lies in several
partitions each part (a segment) first lists every hit that the chain may enter it at
(those within one window of its first hit, and the next one), with the end of the last window
that it has when entered there; that end points to an entry of a later segment, the first
hit from it on. Pointer doubling over these entries (joins, as many rounds as the
logarithm of the number of partitions) marks those that the chain from the user's
first hit meets. Then every segment knows its entry, and the window that is open before
it with its hits so far, and all segments are counted at once.
"""

from __future__ import annotations

from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .segments import Ranged, neighbours, running_max_before


def sessions(events: DataFrame, gap: timedelta, partitions: int | None = None) -> DataFrame:
    """Sessions of ``event_id, user_id, ts, value`` rows: a row starts one if none of the
    user came less than ``gap`` before. Rows without a time are in none."""
    rows = events.select("event_id", "user_id", "ts", "value").where("ts is not null")
    r = neighbours(Ranged.of(rows, ["user_id"], ["ts", "event_id"], partitions), ["ts"])
    opens = F.when(F.col("prev_ts").isNull() | (F.col("ts") >= F.col("prev_ts") + F.lit(gap)), F.col("ts"))
    r = running_max_before(r, opens, "_open")
    d = r.rows.withColumn("session_start", F.coalesce(opens, F.col("_open")))
    return d.groupBy("user_id", "session_start").agg(  # combined on the map side
        (F.max("ts") + F.lit(gap)).alias("session_end"), F.count(F.lit(1)).alias("events"), F.sum("value").alias("value"))


def fold_hits(ts: np.ndarray, span: int, start: int | None, hits: int):
    """Window start and hit number of each of the sorted times ``ts``, going on
    from an open window (``start``, ``hits``). Jumps from window to window."""
    starts, counts = np.empty(len(ts), np.int64), np.empty(len(ts), np.int32)
    at = 0
    while at < len(ts):
        if start is None or ts[at] >= start + span:
            start, hits = int(ts[at]), 0
        end = int(np.searchsorted(ts, start + span, side="left"))
        starts[at:end] = start
        counts[at:end] = hits + np.arange(1, end - at + 1)  # rejected hits count too
        hits += end - at
        at = end
    return starts, counts, start, hits


def segment_entries(ts: np.ndarray, span: int):
    """Of a segment's sorted times: the possible entries, and for each the start of the
    last window and the number of hits in it."""
    n = len(ts)
    first = np.flatnonzero(np.concatenate([[True], ts[1:] != ts[:-1]]))
    jump = np.append(np.searchsorted(ts, ts + span, side="left"), n)  # to the next window's first hit
    last = np.arange(n + 1)
    while True:  # doubling: last follows jump to its end
        on = jump < n
        if not on.any():
            break
        last, jump = np.where(on, last[jump], last), np.where(on, jump[jump], jump)
    entry = first[:int(np.searchsorted(ts[first], ts[0] + span, side="left")) + 1]
    return ts[entry], ts[last[entry]], n - last[entry]


def _runs(batch: pa.RecordBatch):
    """``(segment, from, to)`` of the runs of equal (partition, user) in a batch."""
    ids, pid = batch.column("user_id"), np.asarray(batch.column("_pid"), np.int64)
    codes = np.asarray(ids.dictionary_encode().indices.fill_null(-1), np.int64)
    cuts = [0, *(np.flatnonzero((np.diff(codes) != 0) | (np.diff(pid) != 0)) + 1).tolist(), len(pid)]
    for lo, hi in zip(cuts, cuts[1:]):
        if hi > lo:
            yield (int(pid[lo]), ids[lo].as_py()), lo, hi


def _segments(batches):
    """``((partition, user), times)`` of sorted rows: all of a user's rows in a partition."""
    current, held = None, []
    for batch in batches:
        us = np.asarray(batch.column("us"), np.int64)
        for segment, lo, hi in _runs(batch):
            if held and segment != current:
                yield current, np.concatenate(held)
                held = []
            current = segment
            held.append(us[lo:hi])
    if held:
        yield current, np.concatenate(held)


def _entries(span: int, kind: pa.DataType):
    def rows(batches):
        for (pid, name), ts in _segments(batches):
            entry, start, tail = segment_entries(ts, span)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(entry), pid, np.int32)), pa.array([name] * len(entry), kind), pa.array(entry), pa.array(start),
                 pa.array(tail)], names=["_pid", "user_id", "entry", "start", "tail"])
    return rows


def _count(span: int):
    """Hits in order, with the window that is ``open`` where their segment begins and the
    number of its hits so far (``base``)."""
    def rows(batches):
        current, start, hits = None, None, 0
        for batch in batches:
            us = np.asarray(batch.column("us"), np.int64)
            starts, counts = np.empty(len(us), np.int64), np.empty(len(us), np.int32)
            for segment, lo, hi in _runs(batch):
                if segment != current:
                    current = segment
                    start, hits = batch.column("open")[lo].as_py(), batch.column("base")[lo].as_py() or 0
                starts[lo:hi], counts[lo:hi], start, hits = fold_hits(us[lo:hi], span, start, hits)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("event_id", "user_id", "us", "_pid")), pa.array(starts), pa.array(counts)],
                names=["event_id", "user_id", "us", "_pid", "start", "hits"])
    return rows


def _links(entries: DataFrame, span: int) -> DataFrame:
    """``user_id, entry, next``: the entry that the last window's end of each leads to."""
    ends = entries.select("user_id", "entry", (F.col("start") + span).alias("at"), F.lit(1).alias("kind"))
    marks = entries.select("user_id", "entry", F.col("entry").alias("at"), F.lit(0).alias("kind"))
    both = ends.unionByName(marks).withColumn("down", -F.col("at"))
    # Latest first: the nearest mark before an end, in this order, is the first entry from it on.
    r = running_max_before(Ranged.of(both, ["user_id"], ["down", "kind", "entry"]), F.when(F.col("kind") == 0, F.col("down")), "_m")
    return r.rows.where("kind = 1").select("user_id", "entry", (-F.col("_m")).alias("next"))


def _reached(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Entries on the chains from ``roots`` (``user_id, entry``), by pointer doubling."""
    reached, same = cut_lineage(roots, "reached"), lambda a, b: a.eqNullSafe(b)
    links = cut_lineage(links.where("next is not null"), "links")
    while links.limit(1).count():
        on = links.select(F.col("user_id").alias("u"), F.col("entry").alias("e"), F.col("next").alias("to"))
        more = reached.join(on, same(F.col("user_id"), F.col("u")) & (F.col("entry") == F.col("e"))).select("user_id", F.col("to").alias("entry"))
        reached = cut_lineage(reached.unionByName(more).distinct(), "reached")
        # an entry that leads to none has ended
        links = cut_lineage(links.join(on, same(F.col("user_id"), F.col("u")) & (F.col("next") == F.col("e"))).select(
            "user_id", "entry", F.col("to").alias("next")), "links")
    return reached


def rate_windows(events: DataFrame, limit: int, window: timedelta, partitions: int | None = None) -> DataFrame:
    """X4 over a table: ``event_id, user_id, ts, window_start, hits, flagged`` (and ``_pid``, the
    task that counted the hit) of ``event_id, user_id, ts`` rows, in (ts, event_id) order per
    user; a hit is flagged if it is more than the ``limit``-th of its window. Rows without a
    time are not hits."""
    span = window // timedelta(microseconds=1)
    hits = events.select("event_id", "user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).where("us is not null")
    r = Ranged.of(hits, ["user_id"], ["us", "event_id"], partitions)
    ends = r.ends()
    p = Window.orderBy("_pid")  # one row a partition
    borders = cut_lineage(ends.select("_pid", "_first", "_last", (F.lag("_last").over(p) == F.col("_first")).alias("goes_on"),
                                      (F.lead("_first").over(p) == F.col("_last")).alias("goes_out")), "borders")
    d = r.rows.join(F.broadcast(borders), "_pid")
    key = F.struct("user_id")
    spans = (F.coalesce("goes_on", F.lit(False)) & (key == F.col("_first"))) | (F.coalesce("goes_out", F.lit(False)) & (key == F.col("_last")))
    kind = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}[hits.schema["user_id"].dataType.simpleString()]
    user = hits.schema["user_id"].dataType.simpleString()
    order = ["_pid", "user_id", "us", "event_id"]
    # Parts of users that lie in several partitions; a part is read where it is, whole.
    parts = (d.where(spans).repartition("_pid").sortWithinPartitions(*order).select("_pid", "user_id", "us")
             .mapInArrow(_entries(span, kind), f"_pid int, user_id {user}, entry long, start long, tail long"))
    # A time that the last segment ends with is no entry of the next one.
    entries = cut_lineage(parts.groupBy("user_id", "entry").agg(F.min_by(F.struct("_pid", "start", "tail"), "_pid").alias("x"))
                          .select("user_id", "entry", "x.*"), "entries")
    first = entries.groupBy("user_id").agg(F.min("entry").alias("entry"))
    reached = _reached(_links(entries, span), first)
    # One row a segment: its entry on the chain, if any.
    same = lambda a, b: a.eqNullSafe(b)
    met = reached.select(F.col("user_id").alias("u"), F.col("entry").alias("e"))
    sizes = d.where(spans).groupBy("_pid", "user_id").agg(F.count(F.lit(1)).alias("n"))
    on_chain = entries.join(met, same(F.col("user_id"), F.col("u")) & (F.col("entry") == F.col("e"))).select(
        F.col("user_id").alias("u"), F.col("_pid").alias("_p"), "entry", "start", "tail")
    seg = sizes.join(on_chain, same(F.col("user_id"), F.col("u")) & (F.col("_pid") == F.col("_p")), "left").drop("u", "_p")
    w = Window.partitionBy("user_id").orderBy("_pid")  # segments of a user
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum("n").over(before), F.lit(0))
    seg = seg.withColumn("_upto", upto).withColumn("_from", F.when(F.col("entry").isNotNull(), F.col("_upto") + F.col("n") - F.col("tail")))
    carry = seg.select(F.col("_pid").alias("_p"), F.col("user_id").alias("u"), F.last("start", ignorenulls=True).over(before).alias("open"),
                       (F.col("_upto") - F.last("_from", ignorenulls=True).over(before)).alias("base"))
    d = r.rows.join(F.broadcast(carry), (F.col("_pid") == F.col("_p")) & same(F.col("user_id"), F.col("u")), "left")
    counted = d.repartition("_pid").sortWithinPartitions(*order).select("event_id", "user_id", "us", "_pid", "open", "base").mapInArrow(
        _count(span), f"event_id {hits.schema['event_id'].dataType.simpleString()}, user_id {user}, us long, _pid int, start long, hits int")
    return counted.select("event_id", "user_id", F.timestamp_micros("us").alias("ts"), F.timestamp_micros("start").alias("window_start"),
                          "hits", (F.col("hits") > limit).alias("flagged"), "_pid")
