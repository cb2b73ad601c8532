"""Cleaning (F1-F7), fingerprints and admissibility."""

import re

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as X
from tessera.sources.tables import Tables

# Written by hand from the rules: entities, lower case, tags, links, allowed
# characters, white space.
GOLDEN = [
    ("Ferry <em>LEAVES</em> at 9?! see http://quay.test/x \U0001F6A2 soon", "ferry leaves at 9?! see soon"),
    ("&amp;lt; &copy; tom &amp; jerry", "lt; tom jerry"),
    ("5 &lt; 6 &gt; 4", "5 4"),
    ("caf&eacute; na&#239;ve &#x41;", "caf na ve a"),
    ("x &notanentity; y", "x anentity; y"),
    ("a\x1cb\u3000c\xa0d", "a b c d"),
    ("  \t\n ", ""),
    ("", ""),
    (None, "none"),
    ("www.site.com rest", "rest"),
    ("go http://a.b/c?d=e#f, now", "go now"),
    ("tab\tsep<i>x</i>y", "tab sepxy"),
    ("a < b and c > d", "a d"),
    ("keep .,!?;:'\"()- drop @#$%^*_=+", "keep .,!?;:'\"()- drop"),
    ("Ünïcode ÇAPS", "n code aps"),
]


def _clean(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return [r[0] for r in df.orderBy("id").select(X.clean_text("text")).collect()]


def test_golden_cleaning_pairs(spark):
    got = _clean(spark, [a for a, _ in GOLDEN])
    assert got == [b for _, b in GOLDEN]


@pytest.mark.parametrize("table, column", [("pages", "html"), ("documents", "text"), ("conversations", "text")])
def test_cleaned_text_properties(spark, table, column):
    t = getattr(Tables(spark, "/root/testdata/sf0.001"), table)
    rows = t.select(X.clean_text(column).alias("c"), X.clean_native(X.clean_text(column)).alias("again")).collect()
    for r in rows:
        assert re.fullmatch(r"[a-z0-9 .,!?;:'\"()-]*", r.c)
        assert "  " not in r.c and r.c == r.c.strip()
        assert "http://" not in r.c and "https://" not in r.c
        assert r.again == r.c or "www." in r.c  # cleaning clean text changes nothing
    assert any(r.c for r in rows)


def test_fingerprints(spark):
    import hashlib
    df = spark.createDataFrame([("héllo wörld",)], "text string")
    r = df.select(X.sha256_hex("text").alias("h"), X.char_length("text").alias("n"),
                  X.prefix("text", 8).alias("p")).first()
    assert r.h == hashlib.sha256("héllo wörld".encode()).hexdigest()
    assert r.n == 11 and r.p == "héllo wö"


def test_admissibility_bounds(spark):
    from tessera.operators.validate import admissibility
    df = spark.createDataFrame([("",), ("x" * 5000,), ("x" * 5001,), (None,)], "text string")
    got = [r.admissible for r in admissibility(df).collect()]
    assert got == [False, True, False, False]


def test_ngrams(spark):
    df = spark.createDataFrame([("the cat sat",), ("one",), ("",)], "text string")
    from tessera.operators.features import with_grams
    got = [r.grams for r in with_grams(df, "text").collect()]
    assert got == [["the", "cat", "sat", "the cat", "cat sat"], ["one"], []]


def test_unescape_equals_the_standard_library(spark):
    import html
    import random
    from html.entities import html5
    rnd = random.Random(5)
    names = sorted(html5)
    odd = ["&", "&;", "&#", "&#;", "&#x;", "&#xZ;", "&#0;", "&#13;", "&#x80;", "&#150", "&#xD800;", "&#x110000;", "&#99999999999999999999;",
           "&#x1;", "&#xb;", "&#xFDD0;", "&#x1FFFE;", "&#x1F600;", "&#00065;", "&amp", "&ampamp;", "&notit;", "&notin;", "&NotEqualTilde;",
           "&copyright", "&é;", "&" + "a" * 40 + ";", "&a b;", "&lt&gt;", "&&amp;", "&#65&#66;", "&#x41g;", "&AMP;lt;", "x&y", "a & b", "&1;", "&aacute&Aacute"]
    texts = odd + [None, "", "plain"] + ["&" + n for n in rnd.sample(names, 200)]
    alphabet = ["&", ";", "#", "x", "X", "a", "amp", "lt", "not", "9", "41", "\t", " ", "<", "é", "😀", "copy", "gt;", "&#3"]
    texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 25))) for _ in range(2500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.u for r in df.select("i", X.unescape_entities("t").alias("u")).collect()}
    wrong = [(t, got[i]) for i, t in enumerate(texts) if got[i] != (None if t is None else html.unescape(t))]
    assert not wrong, wrong[:5]


def test_every_name_is_known(spark):
    from html.entities import html5
    df = spark.createDataFrame([(n, v) for n, v in html5.items()], "n string, v string")
    assert df.where(X.unescape_entities(F.concat(F.lit("&"), "n")) != F.col("v")).count() == 0


def test_java_classes_have_no_ranges():
    """a range makes a chain of calls of each character looked at; same characters."""
    for fast, plain in ((X._OUT, "[^a-z0-9.,!?;:'\"()\\-]"), (X._OUT_NOT_SPACE, "[^a-z0-9.,!?;:'\"()\\- ]"), (X._TOKEN, X.TOKEN_RE)):
        assert "a-z" not in fast and "0-9" not in fast
        assert all(bool(re.match(fast, c * 2)) == bool(re.match(plain, c * 2)) for c in map(chr, range(0x3000)))
