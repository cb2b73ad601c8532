"""Operator 4: URL filter. Host and path rules first, else gradient-boosted trees.

Only DataFrame expressions and Spark's own tree booster run on the main path.

Features of a url: lengths of url, host and path, path depth, digit ratio,
entropy of its characters, number of query parameters, dots and hyphens of the
host, and two suffix statistics: the smoothed share of blocked urls among
labelled urls with the same last label, and with the same last two labels.

Training labels: urls that a rule decides, unless labelled urls are given. Every
different (url, label) counts once, however often it is repeated. Hosts are dealt to
``FOLDS`` folds by hash: a training url's suffix statistics come from the other folds, so
they never hold its own label or its host's. The trees see at most ``TRAIN_ROWS`` urls
(lowest hash, a documented sample); suffix statistics count all of them. Without both
classes among the labels there is nothing to learn, and the verdict is the one class there
is (``allow`` without any). ``held_out`` judges every labelled url by what the other
folds' hosts teach.

A null url, or one without ``://``, has an empty host and path, fits no rule and
is judged by the trees like any other. Repeated rows are judged alike. Very long urls
are read whole. Ties: of two rules that fit the longer wins (no two of one length can fit with
different texts but in host and path alike), and a probability of one half allows. An empty
table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, table

# The rules of the registered query, (verdict, host/path prefix).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = LOWER + "0123456789" + "./-_?=&%:#~+@"
TRAIN_ROWS = 20_000
FOLDS = 5
PRIOR = 20.0
TREES, DEPTH = 10, 4


def host(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    found = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, found).otherwise("")


def path(url: Column) -> Column:
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def matched(host_col: Column, path_col: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null. A rule fits its host and all
    subdomains if the path starts with the rule's."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host_col == name) | host_col.endswith("." + name)) & path_col.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def suffix(host_col: Column, labels: int) -> Column:
    return F.substring_index(host_col, ".", -labels)


def entropy(text: Column) -> Column:
    """Shannon entropy in bits of the characters, case folded; characters
    outside ``SYMBOLS`` count as one symbol."""
    low = F.translate(text, UPPER, LOWER)
    n = F.length(low).cast("double")
    counts = [(F.length(low) - F.length(F.replace(low, F.lit(c)))).cast("double") for c in SYMBOLS]
    other = F.length(F.translate(low, SYMBOLS, "")).cast("double")
    term = lambda c: F.when(c > 0, c * F.log2(c)).otherwise(0.0)
    total = term(other)
    for c in counts:
        total = total + term(c)
    return F.when(n > 0, F.log2(n) - total / n).otherwise(0.0)


LEXICAL = ["url_len", "host_len", "path_len", "depth", "digit_ratio", "entropy", "params", "host_dots", "host_hyphens"]


def lexical(df: DataFrame) -> DataFrame:
    """Adds the lexical features to ``url, host, path`` rows."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.length(url).cast("double")
    count = lambda text, c: (F.length(text) - F.length(F.replace(text, F.lit(c)))).cast("double")
    digits = n - F.length(F.translate(url, "0123456789", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.select(
        "*", n.alias("url_len"), F.length("host").cast("double").alias("host_len"),
        F.length("path").cast("double").alias("path_len"), count(F.col("path"), "/").alias("depth"),
        F.when(n > 0, digits / n).otherwise(0.0).alias("digit_ratio"), entropy(url).alias("entropy"),
        F.when(query == "", 0.0).otherwise(1 + count(query, "&")).alias("params"),
        count(F.col("host"), ".").alias("host_dots"), count(F.col("host"), "-").alias("host_hyphens"))


RATES = (("top_rate", 1), ("pair_rate", 2))
INPUTS = [*LEXICAL, *(name for name, _ in RATES)]


def fold(host_col: Column) -> Column:
    return F.pmod(F.xxhash64(host_col, F.lit(23)), F.lit(FOLDS)).cast("int")


def _counts(known: DataFrame, labels: int) -> DataFrame:
    """Blocked and all urls of each suffix, by fold and over all (fold null)."""
    return known.withColumn("key", suffix(F.col("host"), labels)).groupBy("key", "fold").agg(
        F.sum("blocked").alias("bad"), F.count(F.lit(1)).alias("n"))


class Filter:
    """Suffix statistics and trees, learned from ``url, host, path, blocked`` rows."""

    def __init__(self, known: DataFrame):
        # every different url with its label once
        known = cut(known.groupBy("url", "host", "path", "blocked").count().drop("count").withColumn("fold", fold(F.col("host"))), "url-known")
        n, bad = known.agg(F.count(F.lit(1)), F.sum("blocked")).first()
        self.share = bad / n if n else 0.0
        self.model = None
        if 0.0 < self.share < 1.0:
            # one row a suffix and fold; written once, as the sample and all urls join them
            self.counts = {name: cut(_counts(known, k), f"url-{name}") for name, k in RATES}
            few = known.orderBy(F.xxhash64("url"), "url", "blocked").limit(TRAIN_ROWS)
            few = cut(self.features(few, "fold").select(*INPUTS, F.col("blocked").alias("label")), "url-sample")
            booster = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH,
                                    seed=17, maxBins=64, cacheNodeIds=False)
            self.model = booster.fit(self.assembled(few))

    @staticmethod
    def assembled(df: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=INPUTS, outputCol="features").transform(df)

    def features(self, df: DataFrame, own: str | None = None) -> DataFrame:
        """Features of ``url, host, path`` rows; with ``own`` the suffix statistics leave out
        the fold that this column names."""
        for name, k in RATES:
            counts = self.counts[name]
            total = counts.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
            df = df.withColumn("_key", suffix(F.col("host"), k)).join(
                total.select(F.col("key").alias("_key"), F.col("bad").alias("_bad"), F.col("n").alias("_n")), "_key", "left")
            bad, n = F.coalesce("_bad", F.lit(0.0)), F.coalesce("_n", F.lit(0))
            if own:
                part = counts.select(F.col("key").alias("_key"), F.col("fold").alias(own), F.col("bad").alias("_own"), F.col("n").alias("_m"))
                df = df.join(part, ["_key", own], "left")
                bad, n = bad - F.coalesce("_own", F.lit(0.0)), n - F.coalesce("_m", F.lit(0))
            df = df.withColumn(name, (bad + PRIOR * self.share) / (n + PRIOR)).drop("_key", "_bad", "_n", "_own", "_m")
        return lexical(df)

    def scored(self, df: DataFrame, own: str | None = None) -> DataFrame:
        """``df`` with ``learned`` (block or allow) and ``block_probability``."""
        if self.model is None:
            return df.select("*", F.lit("block" if self.share else "allow").alias("learned"), F.lit(None).cast("double").alias("block_probability"))
        out = self.model.transform(self.assembled(self.features(df, own)))
        return out.select(*df.columns, F.when(F.col("prediction") == 1.0, "block").otherwise("allow").alias("learned"),
                          F.element_at(vector_probability(), 2).alias("block_probability"))


def _parsed(urls: DataFrame) -> DataFrame:
    return urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})


def _ruled(parts: DataFrame, rules) -> DataFrame:
    verdict = F.create_map(*[F.lit(x) for v, r in rules for x in (r, v)]) if rules else None
    parts = parts.withColumn("rule", matched(F.col("host"), F.col("path"), rules))
    return parts.withColumn("decided", verdict[F.col("rule")] if rules else F.lit(None).cast("string"))


def labelled_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``url, host, path, blocked`` of the urls that a rule decides."""
    parts = _ruled(_parsed(pages.select(pages["url"].cast("string").alias("url"))), rules)
    return parts.where("rule is not null").select("url", "host", "path", F.when(F.col("decided") == "block", 1.0).otherwise(0.0).alias("blocked"))


def _known(labelled: DataFrame) -> DataFrame:
    rows = labelled.select(labelled["url"].cast("string").alias("url"), labelled["blocked"].cast("double").alias("blocked"))
    return _parsed(rows.where("blocked is not null"))


def judge(pages: DataFrame, rules=RULES, labelled: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of ``page_id, url`` rows, and the trees'
    probability of a block (null where there was nothing to learn).

    ``labelled``: ``url, blocked`` (0/1) rows to learn from; by default the urls
    that a rule decides.
    """
    trained = Filter(labelled_urls(pages, rules) if labelled is None else _known(labelled))
    urls = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"))
    scored = trained.scored(_ruled(_parsed(urls), rules))
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", "learned").alias("verdict"), "block_probability")


def held_out(labelled: DataFrame) -> DataFrame:
    """``fold, blocked, verdict, n``: different labelled urls (``url, blocked`` rows), judged
    by filters that have seen the hosts of the other folds only."""
    known = cut(_known(labelled).dropDuplicates(["url", "blocked"]).withColumn("_fold", fold(F.col("host"))), "url-held-out")
    out = None
    for k in range(FOLDS):
        trained = Filter(known.where(F.col("_fold") != k).select("url", "host", "path", "blocked"))
        got = trained.scored(known.where(F.col("_fold") == k)).groupBy(
            F.col("_fold").alias("fold"), "blocked", F.col("learned").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


def vector_probability() -> Column:
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col("probability"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
