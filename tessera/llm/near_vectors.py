"""Operator 2: embedding near-dedup with randomised-rotation binary codes.

Vectors of one label are linked when their cosine, in double precision, is
``THRESHOLD`` or more.

A vector x is made a unit vector and rotated by a random orthogonal matrix; its
code is the sign of each coordinate, a unit vector c of +-1/sqrt(dim). The
correction factor r = <c, x> is stored with it. For a second rotated unit
vector q, <c, q> / r is an unbiased estimate of <x, q> over the rotation; its
error is sqrt(1 - r^2) / r times the part of q off x in one direction, which
is ``EPSILON * sqrt(1 - <x, q>^2)`` at most: with confidence for EPSILON of a few
times 1/sqrt(dim - 1), and with certainty for 1. A pair at the threshold or
above has an estimate of at least

    threshold - EPSILON * sqrt(1 - threshold^2) * sqrt(1 - r^2) / r

so pairs whose estimate is lower are dropped unseen, and all others are
recomputed exactly. The registered query takes EPSILON = 1: no link is lost.

A label's vectors are dealt to tiles of about ``TILE`` rows, and each pair of tiles is
one group; a group returns link counts and a spanning forest, never pairs. So a
label may hold any share of the rows. Equal vectors of a label are one row there
with a count.

Vectors that are null, empty, zero, or hold null or non-finite components link
with nothing, and neither do rows with a null label. Vectors of different
length are not compared. Repeated vec_ids count as one row each; a null vec_id
is named null. Ties: a component is named by its smallest vec_id. An empty table
gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, partitions, table
from .components import components
from .jaccard_join import forest

THRESHOLD = 0.98
EPSILON = 1.0
TILE = 2048
SLACK = 1e-7  # rounding of codes and estimates; only adds pairs to recompute


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, packed sign codes and correction factors of rows."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    turned = unit @ rotation(x.shape[1])
    return turned, np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])


def code_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    return (np.unpackbits(codes, axis=1, count=dim) * 2.0 - 1) / np.sqrt(dim)


def lower_bound(factor: np.ndarray, threshold: float, epsilon: float) -> np.ndarray:
    """Least estimate of a pair that may reach the threshold."""
    return threshold - epsilon * np.sqrt(1 - threshold**2) * np.sqrt(np.maximum(1 - factor**2, 0)) / factor - SLACK


def linked_pairs(x, turned, codes, factor, other, threshold: float, epsilon: float, same: bool):
    """Pairs (row of x, row of ``other``'s x) with the threshold; ``other`` is a
    tuple like the first four arguments. In a single tile only a < b counts."""
    y, _, y_codes, y_factor = other
    least = lower_bound(y_factor, threshold, epsilon)
    codes_y = code_vectors(y_codes, x.shape[1])
    x_norm, y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    found = []
    for lo in range(0, len(x), 256):
        estimate = turned[lo:lo + 256] @ codes_y.T / y_factor
        a, b = np.nonzero(estimate >= least)
        a += lo
        if same:
            a, b = a[a < b], b[a < b]
        for s in range(0, len(a), 1 << 16):
            i, j = a[s:s + (1 << 16)], b[s:s + (1 << 16)]
            cos = np.einsum("ij,ij->i", x[i], y[j]) / (x_norm[i] * y_norm[j])
            found.append((i[cos >= threshold], j[cos >= threshold]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _group(rows, i: int, j: int, threshold: float, epsilon: float):
    """Links of one pair of tiles: rows are (tile, id, copies, vector bytes, dim)."""
    nodes, copies = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    tile = np.array([r[0] for r in rows])
    links, label = np.zeros(len(rows)), np.arange(len(rows))
    x = np.frombuffer(b"".join(r[3] for r in rows), "<f8").reshape(len(rows), -1)
    turned, codes, factor = encode(x)
    left, right = np.flatnonzero(tile == i), np.flatnonzero(tile == j)
    if len(left) and len(right):
        a, b = linked_pairs(x[left], turned[left], codes[left], factor[left],
                            (x[right], turned[right], codes[right], factor[right]), threshold, epsilon, i == j)
        a, b = left[a], right[b]
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        label = forest(len(rows), a, b)
    some = np.flatnonzero(links > 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[some]), pa.array(links[some].astype(np.int64)), pa.array(nodes[label[some]])],
        names=["node", "links", "joined"])


def _compare(threshold: float, epsilon: float):
    def compare(batches):
        current, held = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("label", "dim", "i", "j", "tile", "node", "copies", "vector")]
            for label, dim, i, j, tile, node, copies, vector in zip(*cols):
                if (label, dim, i, j) != current:
                    if held:
                        yield _group(held, *current[2:], threshold, epsilon)
                    current, held = (label, dim, i, j), []
                held.append((tile, node, copies, vector))
        if held:
            yield _group(held, *current[2:], threshold, epsilon)
    return compare


def _doubles(batches):
    """Vectors that can be compared, as bytes of doubles."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            out = []
            for v in part.column("embedding"):
                x = None
                if v.is_valid and len(v) and not v.values.null_count:
                    x = np.asarray(v.values, np.float64) + 0.0  # -0.0 becomes 0.0
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                out.append(None if x is None else x.tobytes())
            keep = [i for i, x in enumerate(out) if x is not None]
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id").take(take), part.column("label").take(take),
                 pa.array([len(out[i]) // 8 for i in keep], pa.int32()), pa.array([out[i] for i in keep], pa.binary())],
                names=["vec_id", "label", "dim", "vector"])


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, epsilon: float = EPSILON,
                 tile: int = TILE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of ``vec_id, embedding, label`` rows."""
    spark = vectors.sparkSession
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                          vectors["embedding"].cast("array<double>").alias("embedding"),
                          vectors["label"].cast("string").alias("label"))
    good = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).mapInArrow(
        _doubles, "vec_id long, label string, dim int, vector binary")
    # The node of a vector: a hash of label and components, one for equal vectors.
    good = cut(good.withColumn("node", F.xxhash64("label", "vector")), "vectors")
    nodes = good.groupBy("label", "dim", "node").agg(F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"),
                                                     F.min("vec_id").alias("first_id"))
    nodes = cut(nodes, "vector-nodes")
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    tiled = (nodes.join(sizes, ["label", "dim"])
             .withColumn("tile", F.pmod(F.xxhash64("node", F.lit(9)), F.col("tiles")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
             .withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}))
    groups = (tiled.select("label", "dim", "i", "j", "tile", "node", "copies", "vector")
              .repartition(partitions(spark), "label", "dim", "i", "j").sortWithinPartitions("label", "dim", "i", "j"))
    links = cut(groups.mapInArrow(_compare(threshold, epsilon), "node long, links long, joined long"), "vector-links")
    roots = components(links.select(F.col("node").alias("a"), F.col("joined").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    info = (nodes.select("node", "copies", "first_id").join(counts, "node", "left").join(roots, "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    first = info.groupBy("root").agg(F.min("first_id").alias("component_id"))
    info = info.join(first, "root").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    member = good.select("vec_id", "node").join(info, "node").select("vec_id", "n_links", "component_id")
    # All rows: those that were compared, and the rest alone.
    usable = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
              & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    alone = rows.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return member.unionByName(alone).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id",
        F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(node, root) AS (
  SELECT a, b FROM links
  UNION SELECT l.a, r.root FROM links l JOIN reach r ON l.b = r.node WHERE r.root < l.a OR r.root < l.b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id AS vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links,
  CAST(least(e.vec_id, coalesce(roots.root, e.vec_id)) AS BIGINT) AS component_id,
  e.vec_id = least(e.vec_id, coalesce(roots.root, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN roots ON roots.node = e.vec_id
"""
