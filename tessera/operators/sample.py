"""Deterministic stratified sampling and splitting.

The seed is an input of the ordering hash ``md5(seed:key)``, so there is no
process-wide random state (L4) and a task retry draws the same rows. Rows are ordered
by that hash, the key, and a hash over all their columns. A quota of a class ends at
some row of that order: ``ordered.rank_cutoffs`` finds it from counts. Every row is then
decided where it is, by comparing its own place with its class's cutoffs; no text is
shuffled or sorted.

Keys may repeat, also in a third of all rows, and be null. Only where a quota ends among
rows that are equal in every column does a row's place not decide: such rows are
grouped and written out again as often as they were, numbered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from .ordered import rank_cutoffs

SPLITS = ("train", "val", "test")
MOST = 2**63 - 1


def order_hash(key: str | Column, seed: int, salt: str | None = None) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    parts = [F.lit(str(seed))] + ([F.lit(salt)] if salt else []) + [k.cast("string")]
    return F.md5(F.concat_ws(":", *parts))


COPIES = 1 << 16  # equal rows numbered in one go


def row_hash(df: DataFrame) -> Column:
    """96 bits over all columns; a struct that orders by its first field."""
    def plain(f):
        c = F.col(f"`{f.name}`")
        return F.to_json(c) if f.dataType.typeName() in ("map", "variant") else c
    cols = [plain(f) for f in df.schema]
    return F.struct(F.xxhash64(*cols).alias("a"), F.hash(*cols).alias("b"))


def with_cutoffs(df: DataFrame, key: str, part: str, quotas: list[Column], seed: int,
                 salt: str | None = None, prefix: int = DEFAULT.split_prefix_hex) -> DataFrame:
    """W1 against quotas: ``df`` with a boolean ``_in_<i>`` for each quota, true for
    exactly ``quota`` rows of a class, or all if it has fewer (quotas are over ``_total``)."""
    cols, some = df.columns, range(len(quotas))
    d = df.select(*[F.col(f"`{c}`") for c in cols], order_hash(F.col(f"`{key}`"), seed, salt).alias("_h"),
                  F.col(f"`{key}`").alias("_key"), row_hash(df).alias("_row"), F.col(f"`{part}`").alias("_part"))
    cuts = rank_cutoffs(d.select("_part", "_h", "_key", "_row"), quotas, prefix=prefix)
    # one row a class
    at = F.struct(F.struct("_h", "_key").alias("key"), "_row", "_take", "_n")
    cuts = cuts.groupBy(F.col("_part").alias("_class")).agg(*[F.max(F.when(F.col("_i") == i, at)).alias(f"_cut_{i}") for i in some])
    j = d.withColumn("_at", F.struct("_h", "_key")).join(cuts, F.col("_part").eqNullSafe(F.col("_class")), "left")

    def inside(i):
        cut = F.col(f"_cut_{i}")
        same = F.col("_at") == cut["key"]
        before = (F.col("_at") < cut["key"]) | (same & (cut["_row"].isNull() | (F.col("_row") < cut["_row"])))
        tied = same & cut["_row"].isNotNull() & (F.col("_row") == cut["_row"])
        # null: the number of the row among its equals decides
        return F.when(cut.isNull(), False).when(tied, F.when(cut["_take"] == cut["_n"], True)).otherwise(before)

    j = j.withColumns({f"_in_{i}": inside(i) for i in some})
    flags = [f"_in_{i}" for i in some]
    if not cuts.where(F.greatest(*[F.coalesce(F.col(f"_cut_{i}._row").isNotNull() & (F.col(f"_cut_{i}._take") < F.col(f"_cut_{i}._n")),
                                              F.lit(False)) for i in some], F.lit(False))).limit(1).count():
        return j.select(*cols, *flags)
    open_ = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in flags])
    whole = F.struct(*[F.col(f"`{c}`") for c in cols])
    equal = j.where(open_).groupBy("_part", "_h", "_key", "_row").agg(
        F.count(F.lit(1)).alias("_rows"), F.first(whole).alias("_one"),
        *[F.first(F.coalesce(F.when(F.col(f), F.lit(MOST)).when(~F.col(f), F.lit(0)), F.col(f"_cut_{i}._take"))).alias(f"_upto_{i}")
          for i, f in enumerate(flags)])
    blocks = equal.withColumn("_block", F.explode(F.sequence(F.lit(0), F.expr(f"(_rows - 1) div {COPIES}"))))
    blocks = blocks.repartition("_part", "_row", "_block")
    last = F.least(F.col("_rows"), (F.col("_block") + 1) * COPIES)
    again = blocks.withColumn("_number", F.explode(F.sequence(F.col("_block") * COPIES + 1, last)))
    again = again.select(*[F.col("_one").getField(c).alias(c) for c in cols],
                         *[(F.col("_number") <= F.col(f"_upto_{i}")).alias(f) for i, f in enumerate(flags)])
    return j.where(~open_).select(*cols, *flags).unionByName(again)


def stratified_split(df: DataFrame, key: str = "doc_id", label: str = "label",
                     cfg: Config = DEFAULT) -> DataFrame:
    """L2: test / val / train by per-class quotas on the hash rank.

    Quotas: ``test = round(n_c * test_size)``, ``val = round(n_c * val_size)``
    per class (val is a share of the whole, as ``val/(1-test)`` of the rest
    is in the reference); the remainder trains. 100 rows at 50/50 give
    80/10/10 with label mean 0.5 in each split. Row choice differs from the
    reference's RNG by design.
    """
    n = F.col("_total")
    test, val = F.round(n * F.lit(cfg.test_size)), F.round(n * F.lit(cfg.val_size))
    marked = with_cutoffs(df, key, label, [test, test + val], cfg.seed, prefix=cfg.split_prefix_hex)
    split = F.when(F.col("_in_0"), "test").when(F.col("_in_1"), "val").otherwise("train")
    return marked.withColumn("split", split).drop("_in_0", "_in_1")


def balanced_cap(df: DataFrame, key: str = "doc_id", label: str = "label",
                 max_samples: int | None = None, cfg: Config = DEFAULT) -> DataFrame:
    """L1: at most ``max(1, max_samples // n_classes)`` rows per class.

    Applies only when the data has more than ``max_samples`` rows; rows with a null
    label are then in no class and left out. The final
    ``head(max_samples)`` of the reference only bites when the per-class caps
    add up to more than ``max_samples`` (more classes than samples); then the
    rows are ordered by a second seeded hash and cut, which is the feature.
    """
    max_samples = max_samples or cfg.max_samples
    # One row a class; the totals decide whether and where to cap.
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total, n_classes = sizes.agg(F.sum("n"), F.count(label)).first()
    if (total or 0) <= max_samples:
        return df
    cap = max(1, max_samples // max(1, n_classes))
    marked = with_cutoffs(df.where(F.col(label).isNotNull()), key, label, [F.lit(cap)], cfg.seed, prefix=cfg.split_prefix_hex)
    kept = marked.where("_in_0").drop("_in_0")
    if cap * n_classes > max_samples:
        kept = kept.orderBy(order_hash(key, cfg.seed, "shuffle"), key, row_hash(kept)).limit(max_samples)
    return kept


def proportional_cap(split_df: DataFrame, key: str = "doc_id", cfg: Config = DEFAULT,
                     max_total: int | None = None, split_col: str = "split") -> DataFrame:
    """L3: cap the three splits to ``min(max_samples, 5000)`` rows in proportion.

    ``train = max(2, int(cap * share))``, ``val`` likewise, ``test`` takes
    ``max(2, cap - train - val)``; each split keeps its lowest-hash rows. Rows
    without a split count for none and are left out.
    """
    cap = max_total or min(cfg.max_samples, cfg.transformer_row_cap)
    split_df = split_df.where(F.col(split_col).isNotNull())
    sizes = {r[0]: r[1] for r in split_df.groupBy(split_col).agg(F.count(F.lit(1))).collect()}  # three rows
    total = sum(sizes.values())
    if total <= cap:
        return split_df
    quota = {s: max(2, cap * n // total) for s, n in sizes.items()}
    if "test" in quota:
        quota["test"] = max(2, cap - sum(q for s, q in quota.items() if s != "test"))
    of_split = F.coalesce(*[F.when(F.col("_part") == s, F.lit(q)) for s, q in quota.items()])
    marked = with_cutoffs(split_df, key, split_col, [of_split], cfg.seed, "cap", cfg.split_prefix_hex)
    return marked.where("_in_0").drop("_in_0")
