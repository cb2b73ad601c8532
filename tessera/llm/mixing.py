"""Operator 1: mixing sources to target weights.

Weights. ``p`` are the sources' shares of tokens; the mixture is ``p ** a``
normalised, with one exponent ``a`` in [0, 1] (1: as found, 0: uniform). The
exponent is bisected to meet a target: the entropy of the mixture in bits, or a
limit on repetition (epochs of the most repeated source).

Budget. ``budget`` tokens in all, or, if None, the smallest budget that gives
every source at least one whole epoch.

Realisation. A source's documents are dealt to ``blocks`` blocks by hash. Each
epoch permutes the blocks anew, and the documents inside a block. A source with
budget b and t tokens gets floor(b / t) whole epochs; in the last one, whole
blocks in permuted order while they fit, then documents of the next block in
order while their running sum fits. So only block sums (sources x blocks rows)
and, of a source, one block's documents are ever ordered together.

Tokens are words between white space. A null text has 0 tokens; a null source
is a source of its own. A source without tokens has weight 0 and, as it costs
nothing, one epoch. Repeated rows and doc_ids are rows of their own; rows equal
in doc_id and text are drawn together. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, free_name, table

BLOCKS = 256
MAX_SOURCES = 100_000
MAX_EPOCHS = 1.25
BROADCAST_TURNS = 200_000  # rows of about 60 bytes


def token_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    words = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+"))
    return words.cast("long")


def entropy(w: list[float]) -> float:
    return -sum(x * math.log2(x) for x in w if x > 0)


def tempered(p: list[float], a: float) -> list[float]:
    raised = [x ** a if x > 0 else 0.0 for x in p]
    total = sum(raised)
    return [x / total for x in raised] if total else raised


def epochs(p: list[float], w: list[float], budget_share: float | None) -> list[float]:
    """Epochs of each source; ``budget_share`` is the budget over all tokens."""
    ratio = [y / x if x > 0 else 0.0 for x, y in zip(p, w)]
    if budget_share is None:
        low = min((r for r in ratio if r > 0), default=1.0)
        return [r / low for r in ratio]
    return [r * budget_share for r in ratio]


def solve(p: list[float], target: tuple[str, float], budget_share: float | None = None,
          steps: int = 60) -> float:
    """Exponent that meets ``("entropy", bits)`` or ``("epochs", limit)``.

    Entropy rises as the exponent falls, and so does the repetition of the most
    repeated source; the largest exponent that reaches the entropy, or the
    smallest one that keeps the limit, is found by bisection. A target out of
    reach gives the nearest end.
    """
    kind, goal = target
    if kind not in ("entropy", "epochs"):
        raise ValueError(f"unknown target {kind}")

    def flat_enough(a: float) -> bool:  # true for small exponents
        w = tempered(p, a)
        if kind == "entropy":
            return entropy(w) >= goal
        return max(epochs(p, w, budget_share), default=0.0) > goal

    if not flat_enough(0.0):
        return 0.0
    if flat_enough(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if flat_enough(mid) else (low, mid)
    return low if kind == "entropy" else high


def plan(totals: dict, target: tuple[str, float], budget: float | None = None) -> dict:
    """source -> (weight, token budget, epochs) from source -> tokens."""
    total = sum(totals.values())
    if not total:
        return {s: (0.0, 0.0, 1.0) for s in totals}
    names = sorted(totals, key=lambda s: (s is None, str(s)))
    p = [totals[s] / total for s in names]
    share = None if budget is None else budget / total
    w = tempered(p, solve(p, target, share))
    e = epochs(p, w, share)
    return {s: (w[i], e[i] * totals[s], e[i] if totals[s] else 1.0) for i, s in enumerate(names)}


def mix(docs: DataFrame, target: tuple[str, float] = ("epochs", MAX_EPOCHS), budget: float | None = None,
        blocks: int = BLOCKS, seed: int = 11, out: str = "draw") -> DataFrame:
    """The mixture: ``docs`` (all columns) with a row for each time that a
    document is drawn, and a struct ``out``: ``epoch`` (from 0), ``block``,
    ``block_rank`` (place of the block in the source's epoch), ``key`` (order of
    a block's documents), ``weight`` of the source and ``n_tokens``.
    """
    if free_name(docs, out) != out:
        raise ValueError(f"the input has a column {out}; name another")
    spark = docs.sparkSession
    source, text = docs["source"].cast("string"), docs["text"].cast("string")
    tokens = token_count(text)
    identity = F.xxhash64(docs["doc_id"].cast("long"), text)
    block = F.pmod(F.xxhash64(identity, F.lit(seed)), F.lit(blocks)).cast("int")
    # Narrow rows, written once: block sums and the last blocks read them.
    rows = cut(docs.select(source.alias("source"), block.alias("block"), identity.alias("identity"),
                           tokens.alias("n_tokens")), "mix-rows")
    sums = cut(rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens")), "mix-blocks")
    found = sums.groupBy("source").agg(F.sum("block_tokens").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    weights = plan({r["source"]: r["n"] for r in found}, target, budget)
    shares = spark.createDataFrame([(s, w, e, int(e + 1e-9)) for s, (w, _, e) in weights.items()],
                                   "s string, weight double, epochs double, whole int")
    # Every (source, epoch, block): its place in the epoch's permutation and the
    # tokens still left when its turn comes (no bound in a whole epoch).
    turns = sums.join(F.broadcast(shares), sums["source"].eqNullSafe(shares["s"])).drop("s")
    turns = (turns.withColumn("source_tokens", F.sum("block_tokens").over(Window.partitionBy("source")))
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole")))))
    order = Window.partitionBy("source", "epoch").orderBy(
        F.xxhash64(F.lit(seed), "source", "epoch", "block"), "block")
    before = F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = (F.col("epochs") - F.col("whole")) * F.col("source_tokens")
    turns = (turns.withColumn("block_rank", F.row_number().over(order).cast("int"))
             .withColumn("room", F.when(F.col("epoch") < F.col("whole"), F.lit(float("inf"))).otherwise(rest - before))
             .where(F.col("room") > 1e-6)
             .withColumn("fits", F.col("block_tokens") <= F.col("room") + 1e-6))
    turns = cut(turns.select("source", "block", "epoch", "weight", "block_rank", "room", "fits"), "mix-turns")

    def key(who, src, epoch):
        return F.xxhash64(F.lit(seed), src, epoch, who)

    # A source's last block (one an epoch at most) is cut between documents:
    # the last key whose running sum fits. Equal rows have equal keys and go
    # together. These are narrow rows of 1 / blocks of a source.
    last = turns.where(~F.col("fits")).select(F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "room")
    inside = rows.join(F.broadcast(last), rows["source"].eqNullSafe(last["s"]) & (rows["block"] == last["b"]))
    inside = inside.withColumn("key", key(F.col("identity"), F.col("source"), F.col("epoch")))
    running = Window.partitionBy("s", "b", "epoch").orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ends = (inside.withColumn("upto", F.sum("n_tokens").over(running)).where(F.col("upto") <= F.col("room") + 1e-6)
            .groupBy("s", "b", F.col("epoch").alias("e")).agg(F.max("key").alias("end")))
    at_source, at_block, at_turn, who_name, key_name = (
        free_name(docs, c) for c in ("_source", "_block", "_turn", "_who", "_key"))
    turns = (turns.join(ends, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
                        & (F.col("epoch") == F.col("e")), "left")
             .select(F.col("source").alias(at_source), F.col("block").alias(at_block),
                     F.struct("epoch", "block_rank", "weight", "fits", "end").alias(at_turn)))
    turns = cut(turns, "mix-ends")
    # Sources and blocks are known, so is the size of the table of turns; a
    # larger one is joined by a shuffle.
    size = len(found) * blocks * (2 + int(max((e for _, _, e in weights.values()), default=0)))
    wide = docs.withColumn(who_name, F.struct(source.alias("source"), block.alias("block"), identity.alias("identity"),
                                              tokens.alias("n_tokens")))
    side = F.broadcast(turns) if size <= BROADCAST_TURNS else turns
    who, turn = F.col(who_name), F.col(at_turn)
    mixed = wide.join(side, who["source"].eqNullSafe(F.col(at_source)) & (who["block"] == F.col(at_block)))
    mixed = mixed.withColumn(key_name, key(who["identity"], who["source"], turn["epoch"]))
    mixed = mixed.where(turn["fits"] | (F.col(key_name) <= turn["end"]))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        turn["epoch"].alias("epoch"), who["block"].alias("block"), turn["block_rank"].alias("block_rank"),
        F.col(key_name).alias("key"), turn["weight"].alias("weight"), who["n_tokens"].alias("n_tokens")).alias(out))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature mixture of ``documents``: every document at least once, no
    source more than ``MAX_EPOCHS`` times; a row for each draw."""
    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "draw.*")
