"""Operator 11: exact top-k search by distributed histogram selection.

Vectors are made integers, ``floor(scale * x)``; the score of a query and a
candidate is their integer inner product.

1. Queries are dealt to tiles and candidates to stripes. A group is one tile
   against one stripe: it holds the tile and streams the stripe, and scores
   every pair of the two. Groups are what the cluster's tasks work on.
2. Each query has a range of scores that its k-th score lies in, at first the
   bound of Cauchy and Schwarz, cut into ``BINS`` equal bins. A round scores
   everything, counts the scores of each bin, adds the counts of all groups, and goes
   on with the one bin that holds the k-th score. A range of 2^13 scores is down to one
   value after two rounds, any range of longs after eight.
3. When the k-th score is known, a last pass filters: scores above it, and of those
   equal to it as many as are still wanted, by smallest vec_id. What is left, little
   more than k rows a query, is ranked.

A group reports a bin only if fewer than the wanted number of its own scores lie above
it: lower bins cannot hold the query's k-th score. The same holds for equal scores in the
last pass. So what leaves a group is bounded by k a query, however many candidates tie,
and nothing is lost.

Rows take part unless the vector is null or holds null or non-finite components. Zero
and empty vectors do. Vectors of different length are not compared. Repeated rows are
rows of their own: a query is compared with all rows but itself, and a repeated
query is answered once a row. Null vec_ids are no queries and, as
candidates, come after all others of the same score. Ties go to the smaller vec_id. A
query with fewer candidates than k returns all. Scores that a long cannot hold stop at
its ends, and equal ones there are ties. An empty table gives no rows; other columns of
the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, partitions, table

K = 20
SCALE = 64
BINS = 256
TILE, STRIPE = 8192, 8192  # queries held at a time, candidates streamed past them
CHUNK = 256  # candidates scored at a time
MOST = 2**63 - 1

KEY = ["query_id", "key"]


def scaled(scale: int):
    """``id, vector`` rows -> ``id, dim, norm, vector`` of those that take part: 16-bit
    integers if they fit, else doubles (both little-endian)."""
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                lists = part.column("vector")
                lens = np.asarray(lists.value_lengths().fill_null(0), np.int64)
                flat = lists.flatten()
                x = np.asarray(flat.cast(pa.float64()).fill_null(np.nan), np.float64)
                row = np.repeat(np.arange(len(lens)), lens)
                good = np.asarray(lists.is_valid())
                good &= np.bincount(row, ~np.isfinite(x), len(lens)) == 0
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.clip(np.floor(scale * x), -np.finfo(float).max, np.finfo(float).max) + 0.0
                    norm = np.sqrt(np.bincount(row, x * x, len(lens)))
                    narrow = np.bincount(row, ~(np.abs(x) < 2**15), len(lens)) == 0
                ends = np.cumsum(lens)
                keep = np.flatnonzero(good)
                data = [x[ends[i] - lens[i]:ends[i]].astype("<i2" if narrow[i] else "<f8").tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(keep)), pa.array(lens[keep], pa.int32()), pa.array(norm[keep]),
                     pa.array(data, pa.binary())], names=["id", "dim", "norm", "vector"])
    return rows


def matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    """Integer-valued doubles, a row a vector."""
    if all(len(v) == 2 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), dim).astype(np.float64)
    return np.array([np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8") for v in vectors], np.float64).reshape(len(vectors), dim)


class Tile:
    """The queries of a group, and their scores with candidates."""

    def __init__(self, dim: int, rows: list[pa.RecordBatch]):
        t = pa.Table.from_batches(rows)
        col = lambda n: t.column(n).combine_chunks()
        self.dim, self.x = dim, matrix(col("vector").to_pylist(), dim)
        self.ids, self.keys, self.copies, self.lo, self.hi, self.step, self.need = (
            np.asarray(col(n), np.int64) for n in ("id", "key", "copies", "lo", "hi", "step", "need"))
        self.norm = np.asarray(col("norm"))
        self.small = {np.float32: self.x.astype(np.float32)}

    def scores(self, x: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Exact scores (candidate, query): in single or double precision where
        no sum can leave the integers these hold, else in Python's integers."""
        with np.errstate(over="ignore", invalid="ignore"):
            bound = norm.max(initial=0) * self.norm.max(initial=0)
            if bound < 2**23:
                return x.astype(np.float32) @ self.small[np.float32].T
            if bound < 2**52:
                return x @ self.x.T
            s = np.empty((len(x), len(self.x)), np.int64)
            fits = (norm[:, None] * self.norm) < 2**52
            s[fits] = np.where(fits, x @ self.x.T, 0)[fits].astype(np.int64)
        whole = lambda v: [int(c) for c in v]
        for i in np.flatnonzero(~fits.all(axis=1)):
            a = whole(x[i])
            for j in np.flatnonzero(~fits[i]):
                s[i, j] = max(-MOST, min(MOST, sum(p * q for p, q in zip(a, whole(self.x[j])))))
        return s

    def hits(self, x, norm, keys, copies, ids, least):
        """Candidates, queries, scores and number of rows (the query's own row not
        counted) of pairs with scores from ``least`` to the query's ``hi``."""
        s = self.scores(x, norm)
        kind = s.dtype.type
        # bounds beyond the scores of this chunk may be rounded, which moves no score over them
        c, q = np.nonzero((s >= least.astype(kind)) & (s <= self.hi.astype(kind)))
        score = s[c, q].astype(np.int64)
        rows = copies[c] - ((keys[c] == self.keys[q]) & (ids[c] == self.ids[q]))
        some = rows > 0
        return c[some], q[some], score[some], rows[some]


class Histogram(Tile):
    """Counts of the bins of every query's range."""

    columns = "query_id long, key long, bin int, n long"

    def __init__(self, dim, rows):
        super().__init__(dim, rows)
        self.counts = np.zeros((len(self.keys), BINS), np.int64)
        self.first = np.zeros(len(self.keys), np.int64)  # lowest bin that is still wanted

    def add(self, x, norm, keys, copies, ids, unnamed):
        ids = np.where(unnamed, np.iinfo(np.int64).min, ids)
        c, q, score, rows = self.hits(x, norm, keys, copies, ids, self.lo + self.first * self.step)
        # unsigned, as a range may be wider than a long
        at = (score.view(np.uint64) - self.lo[q].view(np.uint64)) // self.step[q].view(np.uint64)
        np.add.at(self.counts, (q, at.astype(np.int64)), rows)
        above = self.counts[:, ::-1].cumsum(axis=1)
        enough = above >= self.need[:, None]
        self.first = np.where(enough.any(axis=1), BINS - 1 - enough.argmax(axis=1), 0)

    def result(self):
        q, b = np.nonzero((self.counts > 0) & (np.arange(BINS) >= self.first[:, None]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(self.ids[q]), pa.array(self.keys[q]), pa.array(b.astype(np.int32)), pa.array(self.counts[q, b])],
            names=["query_id", "key", "bin", "n"])


class Filter(Tile):
    """Candidates above the k-th score (``lo``), and as many of those equal to it as
    are wanted, by smallest vec_id."""

    columns = "query_id long, key long, times long, vec_id long, copies long, score long"

    def __init__(self, dim, rows):
        super().__init__(dim, rows)
        self.found = []
        self.ties = tuple(np.empty(0, np.int64) for _ in range(4))  # query, unnamed, id, rows

    def add(self, x, norm, keys, copies, ids, unnamed):
        known = np.where(unnamed, np.iinfo(np.int64).min, ids)
        c, q, score, rows = self.hits(x, norm, keys, copies, known, self.lo)
        above = score > self.lo[q]
        self.found.append((q[above], unnamed[c[above]], ids[c[above]], rows[above], score[above]))
        tie = (score == self.lo[q]) & (self.need[q] > 0)
        new = (q[tie], unnamed[c[tie]].astype(np.int64), ids[c[tie]], rows[tie])
        q, null, vec_id, rows = (np.concatenate(p) for p in zip(self.ties, new))
        order = np.lexsort((vec_id, null, q))
        q, null, vec_id, rows = q[order], null[order], vec_id[order], rows[order]
        begin = np.searchsorted(q, q)
        keep = np.arange(len(q)) - begin < self.need[q]
        self.ties = q[keep], null[keep], vec_id[keep], rows[keep]

    def result(self):
        q, null, vec_id, rows = self.ties
        for q, null, vec_id, rows, score in [*self.found, (q, null.astype(bool), vec_id, rows, self.lo[q])]:
            if len(q):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.ids[q]), pa.array(self.keys[q]), pa.array(self.copies[q]),
                     pa.array(vec_id, mask=np.asarray(null, bool)), pa.array(rows), pa.array(score)],
                    names=["query_id", "key", "times", "vec_id", "copies", "score"])


def _groups(kind):
    """Stream of sorted grid rows: a group's queries (kind 0) are held, its candidates
    (kind 1) pass by, ``CHUNK`` at a time."""
    def run(batches):
        current, held, tile = None, [], None
        for batch in batches:
            marks = np.stack([np.asarray(batch.column(c), np.int64) for c in ("dim", "tile", "stripe", "kind")])
            cuts = [0, *(np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                group, is_candidate = tuple(marks[:3, lo]), marks[3, lo]
                if group != current:
                    if tile is not None:
                        yield from tile.result()
                    current, held, tile = group, [], None
                if not is_candidate:
                    held.append(batch.slice(lo, hi - lo))
                    continue
                if tile is None and held:
                    tile, held = kind(int(group[0]), held), []
                for at in range(lo, hi if tile is not None else lo, CHUNK):
                    part = batch.slice(at, min(CHUNK, hi - at))
                    ids = part.column("id")
                    tile.add(matrix(part.column("vector").to_pylist(), tile.dim), np.asarray(part.column("norm")),
                             np.asarray(part.column("key"), np.int64), np.asarray(part.column("copies"), np.int64),
                             np.asarray(ids.fill_null(0), np.int64), ~np.asarray(ids.is_valid()))
        if tile is not None:
            yield from tile.result()
    return run


def _grid(state: DataFrame, candidates: DataFrame, dims: DataFrame, kind, spread: int) -> DataFrame:
    """Run ``kind`` on all groups of the queries of ``state``."""
    stripes = F.explode(F.sequence(F.lit(0), F.col("stripes") - 1))
    asked = state.join(dims.select("dim", "stripes"), "dim").select(
        "dim", "tile", stripes.alias("stripe"), F.lit(0).alias("kind"), F.col("query_id").alias("id"), "key", "copies", "norm",
        "vector", "lo", "hi", "step", "need")
    none = F.lit(None).cast("long")
    # candidates meet the tiles that still have queries
    rows = candidates.join(dims.select("dim", "tiles"), "dim").withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    rows = rows.join(state.select("dim", "tile").distinct(), ["dim", "tile"], "left_semi").select(
        "dim", "tile", "stripe", F.lit(1).alias("kind"), "id", "key", "copies", "norm", "vector",
        none.alias("lo"), none.alias("hi"), none.alias("step"), none.alias("need"))
    group = ["dim", "tile", "stripe"]
    both = asked.unionByName(rows).repartition(spread, *group).sortWithinPartitions(*group, "kind")
    return both.mapInArrow(_groups(kind), kind.columns)


def top_k(vectors: DataFrame, is_query, k: int = K, scale: int = SCALE, tile: int = TILE, stripe: int = STRIPE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of ``vec_id, embedding`` for
    each row with ``is_query`` (a function of the vec_id column)."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors["vec_id"].cast("long").alias("id"), vectors["embedding"].cast("array<double>").alias("vector"))
    nodes = (rows.mapInArrow(scaled(scale), "id long, dim int, norm double, vector binary")
             .groupBy("id", "dim", "vector").agg(F.count(F.lit(1)).alias("copies"), F.first("norm").alias("norm"))
             .withColumn("key", F.xxhash64("id", "vector")))
    nodes = cut(nodes.withColumn("query", F.coalesce(is_query(F.col("id")), F.lit(False)) & F.col("id").isNotNull()), "topk-vectors")
    # One row a vector length.
    dims = cut(nodes.groupBy("dim").agg(
        F.max("norm").alias("most"), F.ceil(F.count(F.lit(1)) / stripe).cast("int").alias("stripes"),
        F.ceil(F.count_if("query") / tile).cast("int").alias("tiles")).where("tiles > 0"), "topk-dims")
    groups = dims.agg(F.sum(F.col("stripes").cast("long") * F.col("tiles"))).first()[0]
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not groups:
        return empty
    spread = max(partitions(spark), min(groups // 16, 100_000))
    deal = lambda col, of, seed: F.pmod(F.xxhash64(col, F.lit(seed)), F.col(of)).cast("int")
    candidates = nodes.join(dims.select("dim", "stripes"), "dim").select(
        "dim", deal("key", "stripes", 1).alias("stripe"), "id", "key", "copies", "norm", "vector")
    bound = F.ceil(F.col("norm") * F.col("most") * (1 + 1e-9)) + 1
    most = F.when(F.col("norm") * F.col("most") < 9e18, bound.cast("long")).otherwise(F.lit(MOST))
    state = cut(nodes.where("query").join(dims.select("dim", "tiles", "most"), "dim").withColumn("hi", most).select(
        "dim", deal("key", "tiles", 2).alias("tile"), F.col("id").alias("query_id"), "key", "copies", "norm", "vector",
        (-F.col("hi")).alias("lo"), "hi", (F.expr("hi div 128") + 1).alias("step"), F.lit(k).cast("long").alias("need")), "topk-state")
    done = None  # queries whose k-th score is known
    while state.limit(1).count():
        counts = _grid(state, candidates, dims, Histogram, spread).groupBy(*KEY, "bin").agg(F.sum("n").alias("n"))
        above = F.sum("n").over(Window.partitionBy(*KEY).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = counts.withColumn("above", above)
        at = counts.join(state.select(*KEY, "need"), KEY).where("above >= need and above - n < need").select(*KEY, "bin", "n", "above")
        state = state.join(at, KEY, "left")
        # Fewer candidates than wanted: all of them are above the new k-th score.
        # decimals: a range may be wider than a long
        few, wide = F.col("bin").isNull(), lambda c: F.col(c).cast("decimal(20,0)")
        low = wide("lo") + F.col("bin").cast("decimal(4,0)") * wide("step")
        high = F.least(wide("hi").cast("decimal(26,0)"), (low + wide("step") - 1).cast("decimal(26,0)")).cast("long")
        last = few | (F.col("step") == 1)  # then the k-th score is known
        state = cut(state.select(
            "dim", "tile", *KEY, "copies", "norm", "vector", F.when(few, F.col("lo") - 1).otherwise(low.cast("long")).alias("lo"),
            F.when(last, F.lit(MOST)).otherwise(high).alias("hi"),
            F.when(last, F.lit(0)).otherwise(F.expr("(step - 1) div 256 + 1")).cast("long").alias("step"),
            F.when(few, F.lit(0)).otherwise(F.col("need") - F.col("above") + F.col("n")).cast("long").alias("need")), "topk-state")
        ended = state.where("step = 0")
        done = ended if done is None else done.unionByName(ended)
        state = state.where("step > 0")
    found = _grid(done, candidates, dims, Filter, spread)
    found = found.withColumn("again", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)))))
    place = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    found = found.withColumn("rank", place).where(F.col("rank") <= k)
    return found.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best rows of every row whose vec_id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
