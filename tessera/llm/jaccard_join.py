"""Operator 9: n-gram Jaccard join with Bayesian candidate pruning.

Links are pairs of different texts whose sets of five-word shingles have a
Jaccard similarity of ``THRESHOLD`` or more.

1. Equal texts become one node (64-bit hash of the text). Each node gets a
   MinHash signature; nodes that agree on one of 32 bands of 4 values are
   candidates. A pair at 0.8 agrees on none with odds of 5e-8.
2. Candidate nodes are grouped by connected component (edges to a band's
   smallest node only, never pairs). A component of more than ``TILE_NODES``
   nodes or ``TILE_SHINGLES`` shingles is dealt to tiles, and every pair of tiles
   is one group of bounded size.
3. In a group, pairs that share a band are compared by signature, 16 values at
   a time: with k agreements out of n, the posterior probability of reaching
   the threshold under a uniform prior is P(Binomial(n + 1, threshold) <= k);
   below ``TOLERANCE`` the pair is dropped. The rest is verified exactly on the
   shingle sets. A group returns link counts and a spanning forest, not pairs.

Every text is read whole; no bucket, component or number of partners is capped.

Null texts and texts without a word link with nothing, not even each other.
Rows with equal texts are copies: linked, and counted as links. Ties: a class is
named by its smallest doc_id; a null doc_id comes after all others. An empty
table gives no rows.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_column, cut, documents, free_name, partitions, ragged, slices, table
from .components import components
from .shingles import HASHES, mix64, shingles, signatures

THRESHOLD = 0.8
TOLERANCE = 1e-7
BANDS, BAND_ROWS = 32, 4
STEP = 16
TILE_NODES = 1024
TILE_SHINGLES = 1 << 20
SLICE = 1 << 20
PAIRS = 1 << 15  # compared at a time


def node(text) -> F.Column:
    """Identity of a text (null for null)."""
    return F.when(text.isNotNull(), F.xxhash64(text))


def band_keys(sig: np.ndarray) -> np.ndarray:
    """64-bit key of each band of each signature (rows x BANDS)."""
    parts = sig.reshape(len(sig), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(BAND_ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key


def _sign(batches):
    """Signature and number of distinct shingles of each text with a word."""
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            hashes, off = shingles([t or "" for t in batch.column("text").to_pylist()])
            sig = signatures(hashes, off)
            some = np.diff(off) > 0
            rows = np.flatnonzero(some)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), batch.column("node").take(pa.array(rows)),
                 pa.array(np.diff(off)[rows]),
                 binary_column(sig[rows].reshape(-1).view(np.uint8), np.arange(len(rows) + 1) * 4 * HASHES)],
                names=["doc_id", "node", "n_shingles", "sig"])


def _bands(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 20_000):
            part = batch.slice(lo, 20_000)
            sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), "<u4").reshape(-1, HASHES)
            nodes = np.asarray(part.column("node"), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(nodes, BANDS)), pa.array(band_keys(sig).ravel().view(np.int64))],
                names=["node", "band"])


def _sets(batches):
    """Sorted distinct shingles and the signature of each candidate text."""
    keep = ["node", "root", "tiles", "copies"]
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            hashes, off = shingles([t or "" for t in batch.column("text").to_pylist()])
            sig = signatures(hashes, off)
            sets = [np.unique(hashes[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            ends = np.concatenate([[0], np.cumsum([8 * len(s) for s in sets])])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep],
                 binary_column(sig.reshape(-1).view(np.uint8), np.arange(len(sets) + 1) * 4 * HASHES),
                 binary_column(np.concatenate(sets).view(np.uint8), ends)], names=[*keep, "sig", "shingles"])


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n = STEP, 2 STEP, ...: the fewest agreements whose posterior
    probability of the threshold is ``tolerance`` or more."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, k = 0.0, -1
        while total < tolerance:
            k += 1
            total += math.comb(n + 1, k) * threshold ** k * (1 - threshold) ** (n + 1 - k)
        out.append(k)
    return tuple(out)


def candidate_pairs(keys: np.ndarray, group: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (a < b) of one group that share a band. ``side`` is 0 for the
    rows of a single tile; in a pair of tiles it is 1 and 2, and only pairs
    across count. Group sizes are bounded by the tiles, so is the matrix."""
    n = len(group)
    seen = np.zeros((n, n), bool)
    for band in range(keys.shape[1]):
        key = mix64(keys[:, band] + group.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        starts = np.concatenate([[0], cuts])
        lens = np.diff(np.concatenate([starts, [n]]))
        for s, ln in zip(starts[lens > 1].tolist(), lens[lens > 1].tolist()):
            rows = order[s:s + ln]
            seen[np.ix_(rows, rows)] = True
    a, b = np.nonzero(np.triu(seen, 1))
    ok = (group[a] == group[b]) & ((side[a] == 0) | (side[a] != side[b]))
    return a[ok], b[ok]


def prune(a: np.ndarray, b: np.ndarray, sig: np.ndarray, threshold: float, tolerance: float):
    """Pairs that may still reach the threshold after comparing signatures in steps."""
    kept = []
    for lo in range(0, len(a), PAIRS):
        x, y = a[lo:lo + PAIRS], b[lo:lo + PAIRS]
        agree = np.zeros(len(x), np.int64)
        for i, least in enumerate(least_matches(threshold, tolerance)):
            agree += (sig[x, i * STEP:(i + 1) * STEP] == sig[y, i * STEP:(i + 1) * STEP]).sum(axis=1)
            live = agree >= least
            x, y, agree = x[live], y[live], agree[live]
        kept.append((x, y))
    return tuple(np.concatenate(c) for c in zip(*kept)) if kept else (a, b)


def intersections(a: np.ndarray, b: np.ndarray, sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sizes of the common parts of set pairs (sorted 64-bit hashes, row offsets)."""
    n, lens = len(off) - 1, np.diff(off)
    _, ids, uses = np.unique(sets, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), lens)
    common = uses[ids] > 1
    row, ids = row[common], ids[common]
    _, ids = np.unique(ids, return_inverse=True)
    width = int(ids.max(initial=-1)) + 1
    if len(a) > 8 * n:  # many pairs: products of 0/1 column blocks
        order = np.argsort(ids, kind="stable")
        ids, row = ids[order], row[order]
        out = np.zeros((n, n), np.float32)
        for lo in range(0, width, 4096):
            s, e = np.searchsorted(ids, [lo, lo + 4096])
            block = np.zeros((n, 4096), np.float32)
            block[row[s:e], ids[s:e] - lo] = 1
            out += block @ block.T
        return out[a, b].astype(np.int64)
    keys = row * width + ids  # sorted, as rows and the sets are
    begin = np.searchsorted(row, np.arange(n + 1))
    small = np.diff(begin)
    swap = small[a] > small[b]
    x, y = np.where(swap, b, a), np.where(swap, a, b)
    out = np.zeros(len(a), np.int64)
    size = np.concatenate([[0], np.cumsum(small[x])])
    for lo in range(0, len(a), 4096):
        hi = min(lo + 4096, len(a))
        ln = small[x[lo:hi]]
        at = ragged(begin[x[lo:hi]], ln)
        want = np.repeat(y[lo:hi], ln) * width + ids[at]
        pos = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = keys[pos] == want if len(keys) else np.zeros(0, bool)
        sums = np.concatenate([[0], np.cumsum(hit)])
        local = size[lo:hi + 1] - size[lo]
        out[lo:hi] = sums[local[1:]] - sums[local[:-1]]
    return out


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row that each of n rows reaches through the pairs."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _verify(threshold: float, tolerance: float):
    scaled = round(threshold * 10**9)

    def settle(rows):
        nodes, copies = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        group, side = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        sig = np.frombuffer(b"".join(r[4] for r in rows), "<u4").reshape(-1, HASHES)
        lens = np.array([len(r[5]) // 8 for r in rows])
        sets = np.frombuffer(b"".join(r[5] for r in rows), "<u8")
        off = np.concatenate([[0], np.cumsum(lens)])
        a, b = candidate_pairs(band_keys(sig), group, side)
        a, b = prune(a, b, sig, threshold, tolerance)
        near = np.minimum(lens[a], lens[b]) * 10**9 >= scaled * np.maximum(lens[a], lens[b])
        a, b = a[near], b[near]
        if len(a):
            inter = intersections(a, b, sets, off)
            union = lens[a] + lens[b] - inter
            linked = inter * 10**9 >= scaled * union
            a, b = a[linked], b[linked]
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        label = forest(len(rows), a, b)
        some = np.flatnonzero(links > 0)
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.array(links[some].astype(np.int64)), pa.array(nodes[label[some]])],
            names=["node", "links", "joined"])

    def verify(batches):
        held, weight, number, current = [], 0, 0, None
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                cols = [part.column(c).to_pylist() for c in ("root", "i", "j", "tile", "node", "copies", "sig", "shingles")]
                for root, i, j, tile, name, copies, sig, sets in zip(*cols):
                    if (root, i, j) != current:
                        if len(held) > TILE_NODES or weight > TILE_SHINGLES:
                            yield settle(held)
                            held, weight = [], 0
                        current, number, last = (root, i, j), number + 1, None
                    if name == last:  # a repeated row of the same text
                        continue
                    last = name
                    held.append((name, copies, number, 0 if i == j else 1 + (tile == j), sig, sets))
                    weight += len(sets) // 8
        if held:
            yield settle(held)
    return verify


def link_nodes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE):
    """Nodes and links of ``doc_id, node, text`` rows.

    Returns ``nodes`` (node, copies, first_doc) of all texts with a word and
    ``links`` (node, links, joined): linked documents of a node, counted in one
    group of the component, and a node that it is joined with there.
    """
    spark = docs.sparkSession
    signed = docs.mapInArrow(_sign, "doc_id long, node long, n_shingles long, sig binary")
    nodes = cut(signed.groupBy("node").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"),
                                           F.max("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "nodes")
    bands = nodes.select("node", "sig").mapInArrow(_bands, "node long, band long")
    low = bands.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    edges = bands.join(low, "band").where("node <> low").select(F.col("node").alias("a"), F.col("low").alias("b"))
    found = components(edges)
    info = nodes.drop("sig")
    members = found.join(info, "node")
    sizes = members.groupBy("root").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / TILE_NODES, F.sum("n_shingles") / TILE_SHINGLES)).cast("int").alias("tiles"))
    members = cut(members.join(sizes, "root").select("node", "root", "tiles", "copies", F.col("first_doc").alias("doc_id")), "members")
    mine = docs.withColumnRenamed("doc_id", "own_id")
    # Dealt by key at every size: the candidates grow with the data.
    texts = mine.hint("merge").join(members, (mine["node"] == members["node"]) & mine["own_id"].eqNullSafe(members["doc_id"]))
    sets = texts.select(members["node"], "root", "tiles", "copies", "text").mapInArrow(
        _sets, "node long, root long, tiles int, copies long, sig binary, shingles binary")
    tile = F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")).cast("int")
    sets = sets.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    grouped = (sets.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).drop("other", "tiles")
               .repartition(partitions(spark), "root", "i", "j").sortWithinPartitions("root", "i", "j", "node"))
    links = cut(grouped.mapInArrow(_verify(threshold, tolerance), "node long, links long, joined long"), "links")
    return info, links


def classes(rows: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Per text with a word of ``doc_id, node, text`` rows: ``node, class_id,
    class_node`` (the text that stands for its class), ``copies, n_links``."""
    info, links = link_nodes(rows, threshold, tolerance)
    roots = components(links.select(F.col("node").alias("a"), F.col("joined").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    info = (info.join(counts, "node", "left").join(roots, "node", "left")
            .withColumn("root", F.coalesce("root", "node")))
    first = info.groupBy("root").agg(F.min(F.struct(F.col("first_doc").isNull().alias("no_id"), "first_doc", "node")).alias("least"))
    return cut(info.join(first, "root").select(
        "node", F.col("least.first_doc").alias("class_id"), F.col("least.node").alias("class_node"), "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, class_id`` (smallest doc_id reachable by
    links or copies, itself included), ``n_links`` (other documents linked
    directly, copies included), ``n_copies`` (rows with this text), ``kept``."""
    rows = documents(docs).withColumn("node", node(F.col("text")))
    info = classes(rows, threshold, tolerance)
    out = rows.select("doc_id", "node").join(info, "node", "left")
    known = F.col("copies").isNotNull()
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node"))
    return out.select("doc_id", F.when(known, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
                      F.when(known, first).otherwise(True).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs``, all columns, with one row of each class: its smallest doc_id. Texts
    without a word all stay. Of rows equal in doc_id and text any one stays."""
    rows = documents(docs).withColumn("node", node(F.col("text")))
    own, theirs, first, least = (free_name(docs, c) for c in ("_own", "_node", "_class_node", "_class_id"))
    info = classes(rows, threshold, tolerance).select(
        F.col("node").alias(theirs), F.col("class_node").alias(first), F.col("class_id").alias(least))
    joined = docs.withColumn(own, node(docs["text"].cast("string"))).join(info, F.col(own) == F.col(theirs), "left")
    stays = F.col(theirs).isNull() | ((F.col(own) == F.col(first)) & docs["doc_id"].cast("long").eqNullSafe(F.col(least)))
    kept = joined.where(stays)
    again = rows.groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1 and node is not null").limit(1).count()
    if again:
        # equal rows of a class are told apart by a running number
        one = F.row_number().over(Window.partitionBy(own, "doc_id").orderBy(F.lit(0)))
        number = free_name(docs, "_number")
        kept = kept.withColumn(number, one).where(F.col(theirs).isNull() | (F.col(number) == 1))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, text, list_filter(string_split_regex(lower(text), '\\s+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS shingle
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
           FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT c.a, c.b FROM common c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
          WHERE 5 * c.c >= 4 * (x.n + y.n - c.c)),
reach(node, root) AS (
  SELECT a, b FROM links
  UNION SELECT l.a, r.root FROM links l JOIN reach r ON l.b = r.node WHERE r.root < l.a OR r.root < l.b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
l AS (SELECT a, count(*) AS n FROM links GROUP BY a),
copies AS (SELECT text, count(*) AS n FROM w WHERE len(ws) > 0 GROUP BY text)
SELECT w.doc_id AS doc_id, CAST(least(w.doc_id, coalesce(roots.root, w.doc_id)) AS BIGINT) AS class_id,
  CAST(coalesce(l.n, 0) AS BIGINT) AS n_links, CAST(coalesce(copies.n, 1) AS BIGINT) AS n_copies,
  w.doc_id = least(w.doc_id, coalesce(roots.root, w.doc_id)) AS kept
FROM w LEFT JOIN roots ON roots.node = w.doc_id LEFT JOIN l ON l.a = w.doc_id
  LEFT JOIN copies ON copies.text = w.text AND len(w.ws) > 0
"""
