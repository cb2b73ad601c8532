"""Operator 5: approximate nearest neighbours by NN-descent and graph search.

Nearness is the largest inner product.

Index. Every usable vector is a node; rows with equal vectors share it, so that a
group of them of any size is one point of the graph. Hits become rows after the search:
a node stands for its rows of smallest vec_id, as many as asked. The graph starts from random-hyperplane
leaves about the mean (``TREES`` divisions of all rows into leaves of at most ``LEAF`` rows,
compared inside) and one division at random, so that a row that is alone in its leaves
(an outlier, or a few of them) has neighbours to start from and is met by others.
Then NN-descent rounds improve it: the neighbours of each node and up
to ``DEGREE`` nodes that have it as a neighbour are joined with their vectors, and
those that meet at a node (neighbours of neighbours) are compared if one of
them is new there. A pair is passed on to either end only if it beats that
end's worst neighbour. Rounds stop when fewer than ``SETTLED`` of the neighbours change,
or after ``ROUNDS``. The graph is built on 8-bit vectors.

Search. A query keeps its ``BEAM`` best nodes. In each of ``HOPS`` rounds it expands the
best ``EXPAND`` nodes not expanded yet: a join with the graph gives their neighbours, a
join with the vectors their exact scores in double precision. A query that is
a row of the index starts at its own node, any other at ``ENTRIES`` nodes of lowest
hash, and so does a query that holds fewer than ``k`` nodes.

Work is divided by ``part`` (node number modulo parts); parts grow in number
with the rows, so a part's vectors, lists and updates are bounded. The rows that
a node may meet through nodes pointing at it are a sample by hash: that is the
method's own, and recall is what is measured (README).

Vectors that are null, empty, zero, or hold null or non-finite components take
no part. Vectors of each length have an index of their own (lengths are few; the driver
goes through them). Repeated rows are rows of their own: a query is compared
with all rows but itself. Ties go to the smaller vec_id. A query finds all other rows if there
are fewer than asked. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import binary_column, cut, partitions, table
from .near_vectors import _doubles

K = 20
DEGREE = 32
TREES, LEAF = 4, 512
ROUNDS, SETTLED = 8, 0.05
BEAM, EXPAND, HOPS = 256, 128, 6
ENTRIES = 64
PART_ROWS, LEAST_PARTS = 4096, 24

GRAPH = "part int, node long, nbrs array<long>, scores array<float>, fresh array<boolean>"
UPDATES = "part int, v array<long>, w array<long>, s array<float>"


@dataclass
class Index:
    vectors: DataFrame  # part, node, vec_id (smallest of its rows), vector (doubles as bytes)
    rows: DataFrame  # node, vec_id
    graph: DataFrame
    parts: int
    dim: int


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _column(t: pa.Table, name: str) -> pa.Array:
    return t.column(name).combine_chunks()


def best(v, w, s, old, degree: int):
    """The ``degree`` best of each v, without repeats (old entries first among
    them): higher score, then smaller w."""
    order = np.lexsort((~old, w, v))
    v, w, s, old = v[order], w[order], s[order], old[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    v, w, s, old = v[first], w[first], s[first], old[first]
    order = np.lexsort((w, -s, v))
    v, w, s, old = v[order], w[order], s[order], old[order]
    begin = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.empty(0, np.int64)
    rank = np.arange(len(v)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(v)]])))
    keep = rank < degree
    return v[keep], w[keep], s[keep], old[keep]


def _send(v, w, s, parts: int, degree: int) -> pa.Table:
    """Updates, the best of each node, one row a destination part."""
    v, w, s, _ = best(v, w, s, np.zeros(len(v), bool), degree)
    to = v % parts
    order = np.argsort(to, kind="stable")
    v, w, s, to = v[order], w[order], s[order], to[order]
    at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(v) else np.empty(0, np.int64)
    ends = np.concatenate([at, [len(v)]])
    return pa.table([pa.array(to[at].astype(np.int32)), _lists(v, ends, pa.int64()), _lists(w, ends, pa.int64()),
                     _lists(s, ends, pa.float32())], names=["part", "v", "w", "s"])


def _matrix(rows: pa.Array, kind: str) -> np.ndarray:
    rows = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    return np.frombuffer(b"".join(rows.to_pylist()), kind).reshape(len(rows), -1)


def _small(t: pa.Table) -> np.ndarray:
    scale = np.asarray(_column(t, "scale"), np.float32)
    return _matrix(t.column("small"), "i1").astype(np.float32) * scale[:, None]


def _unit_sums(batches):
    """Sum of the unit vectors of a task's rows, as doubles."""
    total = 0
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            x = _matrix(batch.slice(lo, 4096).column("vector"), "<f8")
            x = x / np.abs(x).max(axis=1, keepdims=True)
            total = total + (x / np.linalg.norm(x, axis=1, keepdims=True)).sum(axis=0)
    if np.ndim(total):
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["sum"])


def _compress(dim: int, bits: int, seed: int, centre: np.ndarray):
    """8-bit vector with its scale, and the leaf of each tree, of double vectors.
    Planes go through ``centre``, the mean of the unit vectors: it shifts all scores
    of a row alike, and rows that share a large mean would fall into few leaves.
    The last leaf is a random one (a node is a hash)."""
    planes = np.random.default_rng(seed).standard_normal((TREES, dim, max(bits, 1)))

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                x = _matrix(part.column("vector"), "<f8")
                scale = np.abs(x).max(axis=1) / 127
                # values may be as small as doubles go
                small = np.rint(x / np.maximum(scale, 1e-300)[:, None]).clip(-127, 127).astype(np.int8)
                leaves = np.zeros((len(x), TREES + 1), np.int64)
                leaves[:, TREES] = (np.asarray(part.column("node"), np.int64) >> 16) & ((1 << bits) - 1)
                if bits:
                    unit = x / np.abs(x).max(axis=1, keepdims=True)
                    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True) - centre
                    for t in range(TREES):
                        leaves[:, t] = ((unit @ planes[t]) > 0) @ (1 << np.arange(bits))
                yield pa.RecordBatch.from_arrays(
                    [part.column("part"), part.column("node"),
                     binary_column(small.reshape(-1).view(np.uint8), np.arange(len(x) + 1) * dim),
                     pa.array(scale.astype(np.float32)),
                     _lists(leaves.ravel(), np.arange(len(x) + 1) * (TREES + 1), pa.int64())],
                    names=["part", "node", "small", "scale", "leaves"])
    return rows


def _leaf(parts: int, degree: int):
    """Best neighbours of each row inside one leaf."""

    def compare(t: pa.Table) -> pa.Table:
        node, x = np.asarray(_column(t, "node"), np.int64), _small(t)
        n = len(node)
        if n < 2:
            return _send(*[np.empty(0, np.int64)] * 2, np.empty(0, np.float32), parts, degree)
        k = min(degree, n - 1)
        s = x @ x.T
        np.fill_diagonal(s, -np.inf)
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        return _send(np.repeat(node, k), node[top.ravel()], np.take_along_axis(s, top, 1).ravel(), parts, degree)
    return compare


def _meet(parts: int, degree: int):
    """NN-descent's local join: members that meet at a centre, compared."""

    def join(lists: pa.Table, members: pa.Table) -> pa.Table:
        node = np.asarray(_column(members, "node"), np.int64)
        x, worst = _small(members), np.asarray(_column(members, "worst"), np.float32)
        order = np.argsort(node)
        node, x, worst = node[order], x[order], worst[order]
        found = [(np.empty(0, np.int64),) * 2 + (np.empty(0, np.float32),)]
        held = 0
        ids, fresh = _column(lists, "members"), _column(lists, "fresh")
        ends = np.asarray(ids.offsets, np.int64)
        at = np.searchsorted(node, np.asarray(ids.values, np.int64))
        new = np.asarray(fresh.values.to_numpy(zero_copy_only=False), bool)
        width = int(np.diff(ends).max(initial=0))
        for lo in range(0, len(ends) - 1, 256):
            e = ends[lo:lo + 257]
            size = np.diff(e)
            row = np.repeat(np.arange(len(size)), size)
            col = np.arange(e[0], e[-1]) - np.repeat(e[:-1], size)
            m = np.full((len(size), width), -1)
            f = np.zeros((len(size), width), bool)
            m[row, col], f[row, col] = at[e[0]:e[-1]], new[e[0]:e[-1]]
            vec = x[m]
            s = vec @ vec.transpose(0, 2, 1)
            a, b = np.broadcast_to(m[:, :, None], s.shape), np.broadcast_to(m[:, None, :], s.shape)
            ok = (a >= 0) & (b >= 0) & (a != b) & (f[:, :, None] | f[:, None, :]) & (s > worst[a])
            found.append((a[ok], b[ok], s[ok]))
            held += len(found[-1][0])
            if held > 3_000_000:
                v, w, sc = (np.concatenate(c) for c in zip(*found))
                found = [best(v, w, sc, np.zeros(len(v), bool), degree)[:3]]
                held = len(found[0][0])
        v, w, s = (np.concatenate(c) for c in zip(*found))
        return _send(node[v] if len(v) else v, node[w] if len(w) else w, s, parts, degree)
    return join


def _merge(degree: int):
    """A part of the graph with its updates."""

    def merge(updates: pa.Table, graph: pa.Table) -> pa.Table:
        node = np.sort(np.asarray(_column(graph, "node"), np.int64))
        nbrs = _column(graph, "nbrs")
        size = np.diff(np.asarray(nbrs.offsets, np.int64))
        flat = lambda t, c: np.asarray(_column(t, c).flatten())
        v = np.concatenate([np.repeat(np.asarray(_column(graph, "node"), np.int64), size), flat(updates, "v")])
        w = np.concatenate([flat(graph, "nbrs"), flat(updates, "w")])
        s = np.concatenate([flat(graph, "scores"), flat(updates, "s")])
        old = np.arange(len(v)) < int(size.sum())
        v, w, s, old = best(v, w, s, old, degree)
        ends = np.concatenate([np.searchsorted(v, node), [len(v)]])
        part = np.full(len(node), graph.column("part")[0].as_py() if len(node) else 0, np.int32)
        return pa.table([pa.array(part), pa.array(node), _lists(w, ends, pa.int64()), _lists(s, ends, pa.float32()),
                         _lists(~old, ends, pa.bool_())], names=["part", "node", "nbrs", "scores", "fresh"])
    return merge


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, dim, vector, node`` of the rows that take part; a node is a hash of
    the vector."""
    rows = vectors.select(vectors["vec_id"].cast("long").alias("vec_id"),
                          vectors["embedding"].cast("array<double>").alias("embedding"), F.lit("").alias("label"))
    rows = rows.where("embedding is not null").mapInArrow(
        _doubles, "vec_id long, label string, dim int, vector binary").drop("label")
    return rows.withColumn("node", F.shiftrightunsigned(F.xxhash64("vector"), 1))


def lengths(rows: DataFrame) -> list[int]:
    """Lengths of the vectors, the most frequent first."""
    return [r["dim"] for r in rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").collect()]


def build(vectors: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = 13) -> Index | None:
    """The neighbour graph of the ``vec_id, embedding`` rows of the most frequent length
    (of equally frequent ones the smaller); None without a usable row."""
    rows = cut(usable(vectors), "ann-rows")
    for dim in lengths(rows)[:1]:
        return build_of(rows, dim, degree, rounds, seed)


def build_of(rows: DataFrame, dim: int, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = 13) -> Index:
    """The neighbour graph of the ``usable`` rows of one length."""
    spark = rows.sparkSession
    rows = rows.where(F.col("dim") == dim)
    nodes = cut(rows.groupBy("node").agg(F.min("vec_id").alias("vec_id"), F.first("vector").alias("vector")), "ann-nodes")
    n = nodes.count()
    parts = max(LEAST_PARTS, -(-n // PART_ROWS))
    nodes = nodes.withColumn("part", F.pmod("node", F.lit(parts)).cast("int"))
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF))))
    sums = nodes.select("vector").mapInArrow(_unit_sums, "sum array<double>").collect()  # a vector a task
    centre = np.round(np.sum([r["sum"] for r in sums], axis=0) / n, 6)
    small = cut(nodes.mapInArrow(_compress(dim, bits, seed, centre),
                                "part int, node long, small binary, scale float, leaves array<long>"), "ann-small")
    leaves = small.select("node", "small", "scale", F.posexplode("leaves").alias("tree", "leaf"))
    # A crowded leaf (rows alike) is dealt to several at random.
    crowd = leaves.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("pieces"))
    leaves = (leaves.join(crowd, ["tree", "leaf"])
              .withColumn("piece", F.pmod(F.xxhash64("node", "tree"), F.col("pieces"))))
    updates = leaves.groupBy("tree", "leaf", "piece").applyInArrow(_leaf(parts, degree), UPDATES)
    empty = small.select("part", "node", F.expr("array()").cast("array<long>").alias("nbrs"),
                         F.expr("array()").cast("array<float>").alias("scores"),
                         F.expr("array()").cast("array<boolean>").alias("fresh"))

    def merged(updates: DataFrame, graph: DataFrame) -> DataFrame:
        return cut(updates.groupBy("part").cogroup(graph.groupBy("part")).applyInArrow(_merge(degree), GRAPH), "ann-graph")

    graph = merged(updates, empty)
    for _ in range(rounds):
        edges = graph.select("node", F.explode(F.arrays_zip("nbrs", "fresh")).alias("e"))
        edges = edges.select("node", F.col("e.nbrs").alias("nbr"), F.col("e.fresh").alias("new"))
        share = edges.agg(F.avg(F.col("new").cast("int"))).first()[0]
        if share is None or share < SETTLED:
            break
        pick = Window.partitionBy("nbr").orderBy(F.xxhash64("node", "nbr"))
        back = (edges.withColumn("r", F.row_number().over(pick)).where(F.col("r") <= degree)
                .groupBy("nbr").agg(F.collect_list(F.struct(F.col("node").alias("nbrs"), F.col("new").alias("fresh"))).alias("back")))
        lists = graph.join(back, graph["node"] == back["nbr"], "left").select(
            "part", F.concat(F.arrays_zip("nbrs", "fresh"), F.coalesce("back", F.expr("array()"))).alias("l"))
        lists = lists.select("part", F.col("l.nbrs").alias("members"), F.col("l.fresh").alias("fresh"))
        worst = F.when(F.size("scores") >= degree, F.array_min("scores")).otherwise(F.lit(float("-inf"))).cast("float")
        state = small.select("node", "small", "scale").join(graph.select("node", worst.alias("worst")), "node")
        want = lists.select(F.col("part").alias("home"), F.explode("members").alias("node")).distinct()
        members = want.join(state, "node")
        updates = lists.groupBy("part").cogroup(members.groupBy("home")).applyInArrow(_meet(parts, degree), UPDATES)
        graph = merged(updates, graph)
    return Index(nodes.select("part", "node", "vec_id", "vector"), rows.select("node", "vec_id"), graph, parts, dim)


ASK = "part int, query long, vector binary, cands array<long>"
STATE = "query long, own long, vector binary, beam array<long>, ids array<long>, scores array<double>, done array<boolean>"


def _route(parts: int):
    """New candidates of each query (neighbours of the nodes just expanded,
    without those in its beam), one row for each part that holds some."""

    def rows(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                out = []
                for q, vec, beam, nbrs in zip(*[part.column(c) for c in ("query", "vector", "beam", "nbrs")]):
                    ids = np.unique(np.asarray(nbrs.values, np.int64))
                    ids = ids[~np.isin(ids, np.asarray(beam.values, np.int64))]
                    to = ids % parts
                    order = np.argsort(to, kind="stable")
                    ids, to = ids[order], to[order]
                    at = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(ids) else []
                    for a, b in zip(at, [*at[1:], len(ids)]):
                        out.append((int(to[a]), q.as_py(), vec.as_py(), ids[a:b]))
                if out:
                    p, q, vec, ids = zip(*out)
                    ends = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p, pa.int32()), pa.array(q, pa.int64()), pa.array(vec, pa.binary()),
                         _lists(np.concatenate(ids), ends, pa.int64())], names=["part", "query", "vector", "cands"])
    return rows


def _score(beam: int):
    """Exact scores of the candidates that a part holds; the best ``beam`` of a query."""

    def score(asks: pa.Table, vectors: pa.Table) -> pa.Table:
        node, ids = np.asarray(_column(vectors, "node"), np.int64), np.asarray(_column(vectors, "vec_id").fill_null(np.iinfo(np.int64).max), np.int64)
        order = np.argsort(node)
        x = _matrix(vectors.column("vector"), "<f8")[order] if len(node) else np.empty((0, 0))
        node, ids = node[order], ids[order]
        out = []
        for q, vec, cands in zip(_column(asks, "query").to_pylist(), _column(asks, "vector").to_pylist(), _column(asks, "cands")):
            c = np.asarray(cands.values, np.int64)
            at = np.searchsorted(node, c)
            s = x[at] @ np.frombuffer(vec, "<f8")
            top = np.lexsort((ids[at], -s))[:beam]
            out.append((q, c[top], ids[at][top], s[top]))
        q, c, i, s = zip(*out) if out else ((), (), (), ())
        ends = np.concatenate([[0], np.cumsum([len(a) for a in c])]).astype(np.int64)
        flat = lambda a, kind: np.concatenate(a) if a else np.empty(0, kind)
        return pa.table([pa.array(q, pa.int64()), _lists(flat(c, np.int64), ends, pa.int64()), _lists(flat(i, np.int64), ends, pa.int64()),
                         _lists(flat(s, float), ends, pa.float64())], names=["query", "nodes", "ids", "scores"])
    return score


def _keep(beam: int):
    """A query's beam with the new scores."""

    def rows(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                node = np.concatenate([np.array(r["beam"], np.int64), *[np.array(f["nodes"], np.int64) for f in r["found"]]])
                ids = np.concatenate([np.array(r["ids"], np.int64), *[np.array(f["ids"], np.int64) for f in r["found"]]])
                s = np.concatenate([np.array(r["scores"], float), *[np.array(f["scores"], float) for f in r["found"]]])
                done = np.zeros(len(node), bool)
                done[:len(r["done"])] = r["done"]
                top = np.lexsort((node, ids, -s))[:beam]
                out.append((r["query"], r["own"], r["vector"], node[top].tolist(), ids[top].tolist(), s[top].tolist(), done[top].tolist()))
            cols = list(zip(*out)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["query", "own", "vector", "beam", "ids", "scores", "done"])
    return rows


def _hits(index: Index, queries: DataFrame, k: int, beam: int = BEAM, expand: int = EXPAND, hops: int = HOPS) -> DataFrame:
    """``query, hits``: the ``k`` best rows found, best first, as ``vec_id, score, node``."""
    spark = queries.sparkSession
    entries = index.graph.select("node").orderBy(F.xxhash64("node"), "node").limit(ENTRIES)
    entries = entries.agg(F.sort_array(F.collect_list("node")).alias("entries"))  # ENTRIES numbers
    none = lambda kind: F.expr("array()").cast(f"array<{kind}>")
    state = cut(queries.select("query", "own", "vector", none("long").alias("beam"), none("long").alias("ids"),
                               none("double").alias("scores"), none("boolean").alias("done")), "ann-state")
    edges = index.graph.select("node", "nbrs")
    starts = entries.first()["entries"] or []
    entries = F.array(*[F.lit(e) for e in starts]).cast("array<long>")
    for hop in range(hops):
        if hop == 0:
            front = state.select("query", F.col("own").alias("node")).where("node is not null")
            given = state.select("query", F.when(F.col("own").isNull(), entries).otherwise(F.array("own")).alias("nbrs"))
        else:
            # beam is sorted: the first unexpanded places are the best
            place = F.filter(F.sequence(F.lit(0), F.size("beam")), lambda i: ~F.get("done", i))
            open_ = state.withColumn("open", F.slice(place, 1, expand))
            front = open_.select("query", F.explode("open").alias("i"), "beam").select("query", F.get("beam", F.col("i")).alias("node"))
            state = open_.withColumn("done", F.transform(F.col("done"), lambda d, i: d | F.array_contains("open", i))).drop("open")
            given = state.where(F.size("beam") < k).select("query", entries.alias("nbrs"))
        met = (front.join(edges, "node").select("query", "nbrs").unionByName(given)
               .groupBy("query").agg(F.flatten(F.collect_list("nbrs")).alias("nbrs")))
        asks = met.join(state.select("query", "vector", "beam"), "query").mapInArrow(_route(index.parts), ASK)
        found = (asks.groupBy("part").cogroup(index.vectors.groupBy("part"))
                 .applyInArrow(_score(beam), "query long, nodes array<long>, ids array<long>, scores array<double>"))
        found = found.groupBy("query").agg(F.collect_list(F.struct("nodes", "ids", "scores")).alias("found"))
        state = state.join(found, "query", "left").withColumn("found", F.coalesce("found", F.expr("array()")))
        state = cut(state.repartition(partitions(spark), "query").mapInArrow(_keep(beam), STATE), "ann-state")
    # The k best nodes (by score and smallest vec_id) hold the k best rows.
    top = state.select("query", F.explode(F.slice(F.arrays_zip("beam", "scores"), 1, k)).alias("hit"))
    top = top.select("query", F.col("hit.beam").alias("node"), F.col("hit.scores").alias("score"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("vec_id").asc_nulls_last()))
    first = index.rows.withColumn("r", place).where(F.col("r") <= k).groupBy("node").agg(
        F.collect_list(F.struct("vec_id")).alias("same"))
    row = lambda r: F.struct((-F.col("score")).alias("low"), r["vec_id"].isNull().alias("unnamed"), r["vec_id"].alias("vec_id"),
                             F.col("node").alias("node"))
    top = top.join(first, "node").groupBy("query").agg(F.flatten(F.collect_list(F.transform("same", row))).alias("hits"))
    hit = lambda h: F.struct(h["vec_id"].alias("vec_id"), (-h["low"]).alias("score"), h["node"].alias("node"))
    return top.select("query", F.transform(F.slice(F.array_sort("hits"), 1, k), hit).alias("hits"))


def _ranked(*cols: str) -> list:
    return [*cols, F.posexplode("hits").alias("rank", "hit")]


def search(index: Index, queries: DataFrame, k: int = K, beam: int = BEAM, expand: int = EXPAND,
           hops: int = HOPS) -> DataFrame:
    """``query, rank, vec_id, score``: the ``k`` best rows found for each of the ``query
    long, own long, vector binary`` rows. ``own`` is the query's node in the index
    (where it starts), or null."""
    found = _hits(index, queries, k, beam, expand, hops).select(*_ranked("query"))
    return found.select("query", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def _neighbours(index: Index) -> DataFrame:
    """The ``K`` nearest rows of every row of the index whose vec_id is divisible by 20."""
    asked = index.rows.where(F.col("vec_id") % 20 == 0)
    nodes = index.vectors.join(asked.select("node").distinct(), "node")
    found = _hits(index, nodes.select(F.col("node").alias("query"), F.col("node").alias("own"), "vector"), K + 1)
    asked = asked.select(F.col("node").alias("query"), F.col("vec_id").alias("query_id")).join(found, "query")
    # without the row itself, which is a hit of its own node
    own = F.array_position(F.transform("hits", lambda h: (h["node"] == F.col("query")) & h["vec_id"].eqNullSafe(F.col("query_id"))), True)
    asked = asked.withColumn("own", own)
    others = F.slice(F.filter("hits", lambda h, i: i + 1 != F.col("own")), 1, K)
    found = asked.select("query_id", others.alias("hits")).select(*_ranked("query_id"))
    return found.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every row whose vec_id is divisible by 20."""
    rows = cut(usable(table(spark, sf_dir, "embeddings")), "ann-rows")
    asked = rows.where(F.col("vec_id") % 20 == 0)
    found = [_neighbours(build_of(rows, dim)) for dim in lengths(asked)]
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return reduce(DataFrame.unionByName, found, none)
