"""Operator 12: centroid clustering with Orchard search.

Vectors are made integers, ``floor(scale * x)``, so that all distances, sums and
centroids are exact and do not depend on the order of the rows.

A round assigns every vector to its nearest centroid (squared Euclidean distance;
ties: smaller number) and replaces every non-empty centroid by the floor of its
vectors' mean. The assignment is Orchard's search: every centroid has the list of
the others, nearest first. A vector starts at some centroid and walks down its list.
A centroid that it has not visited yet is compared; as soon as one is closer (or as close
with a smaller number) the walk goes on at the top of that one's list. It stops where the
list is strictly beyond twice the current distance (four times, squared): by the triangle
inequality whatever is as close as the current centroid has been visited then.

Work: a round is one pass over the vectors. Tasks carry the centroids and their lists (k
and k^2 numbers; k is a parameter) and return sums, k rows a task, which Spark adds up by
(centroid, component). The driver sees k centroids, nothing that grows with the rows.

Kept are vectors of exactly ``dim`` components, none null or non-finite; other rows are
not returned. The first centroids are the ``k`` kept rows of smallest hash of
``<seed>:<vec_id>``, ties (repeated vec_ids) by components, null vec_ids last; fewer
rows make fewer centroids. Repeated rows count and are returned as rows of their own.
Components beyond +-2^62 after scaling stop there; distances and sums of them
that a long cannot hold are returned as its largest value. An empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

K, DIM, ROUNDS = 8, 64, 10
SCALE, SEED = 1024, 3
FAST = 2**22  # components below it: 64 squared differences add up within a double's integers
MOST = 2**63 - 1


def _integers(scale: int, dim: int):
    """``vec_id, vector`` rows -> ``vec_id, vector`` (64-bit integers as bytes) of the kept ones."""
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                lists = part.column("vector")
                lens = np.asarray(lists.value_lengths().fill_null(-1), np.int64)
                right = pa.array(np.flatnonzero(lens == dim))
                x = lists.take(right).flatten().cast(pa.float64()).fill_null(np.nan)
                x = np.asarray(x, np.float64).reshape(len(right), dim)
                good = np.isfinite(x).all(axis=1)
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(scale * x[good]), -2.0**62, 2.0**62).astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(right.filter(pa.array(good))), pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["vec_id", "vector"])
    return rows


def vector_rows(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(len(column), dim)


class Orchard:
    """Centroids with their neighbour lists; ``assign`` finds the nearest of every row."""

    def __init__(self, centroids: np.ndarray):
        self.k = len(centroids)
        wide = np.abs(centroids.astype(object)).max(initial=0) >= FAST
        self.kind = object if wide else np.float64
        self.centroids = centroids
        exact = centroids.astype(object)
        between = np.array([[((a - b) ** 2).sum() for b in exact] for a in exact], object).reshape(self.k, self.k)
        # nearest first, without the centroid itself; ties by number
        self.lists = np.array([[j for _, j in sorted((between[i, j], j) for j in range(self.k) if j != i)]
                               for i in range(self.k)], np.int64).reshape(self.k, max(self.k - 1, 0))
        self.reach = np.take_along_axis(between, self.lists, axis=1) if self.k > 1 else between[:, :0]

    def assign(self, x: np.ndarray):
        """Nearest centroid, exact squared distance, and comparisons made, of integer rows."""
        small = (np.abs(x) < FAST).all(axis=1) if self.kind is np.float64 else np.zeros(len(x), bool)
        best, at = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        seen = 0
        for rows, kind in ((np.flatnonzero(small), np.float64), (np.flatnonzero(~small), object)):
            for lo in range(0, len(rows), 8192):
                some = rows[lo:lo + 8192]
                best[some], d, n = self._walk(x[some].astype(kind), kind)
                at[some] = d.astype(np.int64) if kind is np.float64 else d
                seen += n
        return best, at, seen

    def _walk(self, x: np.ndarray, kind):
        centroids, reach = self.centroids.astype(kind), self.reach.astype(kind)
        n = len(x)
        now = np.zeros(n, np.int64)
        dist = ((x - centroids[0]) ** 2).sum(axis=1)
        place = np.zeros(n, np.int64)
        visited = np.zeros((n, self.k), bool)
        visited[:, 0] = True
        active, compared = np.arange(n), n
        while len(active) and self.k > 1:
            active = active[place[active] < self.k - 1]
            active = active[~(reach[now[active], place[active]] > 4 * dist[active]).astype(bool)]
            other = self.lists[now[active], place[active]]
            place[active] += 1
            fresh = ~visited[active, other]
            rows, other = active[fresh], other[fresh]
            visited[rows, other] = True
            d = ((x[rows] - centroids[other]) ** 2).sum(axis=1)
            compared += len(rows)
            closer = (d < dist[rows]) | ((d == dist[rows]) & (other < now[rows]))
            closer = closer.astype(bool)
            rows, other = rows[closer], other[closer]
            now[rows], dist[rows], place[rows] = other, d[closer], 0
        return now, dist, compared


def _sums(search: Orchard, dim: int):
    """A task's vectors -> for each centroid the number of its vectors and the sum of each
    component, in two parts (a multiple of 2^32 and a rest) that a long can hold."""
    def rows(batches):
        count = np.zeros(search.k, np.int64)
        high, low = np.zeros((search.k, dim), np.int64), np.zeros((search.k, dim), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                x = vector_rows(batch.column("vector").slice(at, 8192), dim)
                best, _, _ = search.assign(x)
                count += np.bincount(best, minlength=search.k)
                np.add.at(high, best, x >> 32)
                np.add.at(low, best, x & 0xFFFFFFFF)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(high[some].tolist(), pa.list_(pa.int64())),
                 pa.array(low[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "high", "low"])
    return rows


def next_centroids(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: centroids of the vectors assigned to each; empty ones stay."""
    dim = centroids.shape[1]
    parts = vectors.mapInArrow(_sums(Orchard(centroids), dim), "cluster int, n long, high array<long>, low array<long>")
    cells = parts.select("cluster", "n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "part"))
    sums = cells.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("part.high").alias("high"), F.sum("part.low").alias("low"))
    out = centroids.copy()
    for r in sums.collect():  # k x dim rows
        out[r.cluster, r.i] = (r.high * 2**32 + r.low) // r.n
    return out


def _assigned(search: Orchard, dim: int):
    def rows(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                best, dist, _ = search.assign(vector_rows(part.column("vector"), dim))
                dist = np.minimum(dist, MOST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(dist)],
                                                 names=["vec_id", "cluster", "distance"])
    return rows


def first_centroids(vectors: DataFrame, k: int, dim: int, seed: int) -> np.ndarray:
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    return np.frombuffer(b"".join(bytes(r.vector) for r in rows), "<i8").reshape(len(rows), dim)


def cluster(vectors: DataFrame, k: int = K, dim: int = DIM, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED):
    """``(assigned, centroids)``: a table ``vec_id, cluster, distance`` of all kept rows, and
    the final centroids (integers, a row a centroid)."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("vector"))
    kept = cut(rows.mapInArrow(_integers(scale, dim), "vec_id long, vector binary"), "orchard-vectors")
    centroids = first_centroids(kept, k, dim, seed)
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        new = next_centroids(kept, centroids)
        if (new == centroids).all():
            break  # a further round would repeat this one
        centroids = new
    return cut(kept.mapInArrow(_assigned(Orchard(centroids), dim), schema), "orchard-assigned"), centroids


def digests(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assigned rows with the inertia of their cluster and of all, and their centroid's digest."""
    spark = assigned.sparkSession
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum"))
    sums = {r.cluster: int(r["sum"]) for r in sums.collect()}  # k rows at most
    total = sum(sums.values())
    info = [(i, min(s, MOST), min(total, MOST), hashlib.sha256(",".join(str(int(v)) for v in centroids[i]).encode()).hexdigest())
            for i, s in sorted(sums.items())]
    info = spark.createDataFrame(info, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(info), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(*cluster(table(spark, sf_dir, "embeddings")))


def _round_sql(i: int) -> str:
    return f"""
a{i} AS MATERIALIZED (
  SELECT id, cluster, distance FROM (
    SELECT v.id, c.cluster, list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS distance,
      row_number() OVER (PARTITION BY v.id ORDER BY list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.cluster) AS r
    FROM v JOIN c{i} c ON true) WHERE r = 1)"""


def _step_sql(i: int) -> str:
    return f"""
s{i} AS (
  SELECT a.cluster, v.e FROM a{i} a JOIN v ON v.id = a.id),
m{i} AS (
  SELECT cluster, j, sum(e[j]) AS s, count(*) AS n FROM s{i}, range(1, 65) t(j) GROUP BY cluster, j),
n{i} AS (
  SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM m{i} GROUP BY cluster),
c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(n.e, c.e) AS e FROM c{i} c LEFT JOIN n{i} n ON n.cluster = c.cluster)"""


OP12_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), e) - 1 AS cluster, e FROM v
  QUALIFY cluster < 8),""" + ",".join(_round_sql(i) + "," + _step_sql(i) for i in range(ROUNDS)) + "," + _round_sql(ROUNDS) + f"""
SELECT v.vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
  sha256(list_aggregate(c.e, 'string_agg', ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN v ON v.id = a.id JOIN c{ROUNDS} c ON c.cluster = a.cluster
"""
