"""Text functions (F1-F15) as native column expressions.

``clean_text`` equals the Python definition: entity unescape, lower-case,
tag strip, URL strip, character whitelist, whitespace collapse and strip, in
that order. Python's ``\\s`` (for ``str`` patterns) is the set of characters
for which ``str.isspace()`` is true; Java's ``\\s`` is ASCII only and its
``(?U)\\s`` misses U+001C..U+001F, so the class is built from that rule and
written out explicitly (the same text works in Java regex and RE2).
"""

from __future__ import annotations

import json
import string
import sys
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ranges(codepoints: list[int]) -> str:
    out, i = [], 0
    while i < len(codepoints):
        j = i
        while j + 1 < len(codepoints) and codepoints[j + 1] == codepoints[j] + 1:
            j += 1
        a, b = codepoints[i], codepoints[j]
        out.append(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}")
        i = j + 1
    return "".join(out)


# Python's whitespace, derived from str.isspace() over all code points.
WS = _ranges([c for c in range(sys.maxunicode + 1) if chr(c).isspace()])
NOT_WS = f"[^{WS}]"

# Fixed patterns of the cleaning function (must equal the reference's):
#   tags      <[^>]+>                      -> ""
#   URLs      https?://\S+|www\.\S+        -> " "
#   whitelist [^a-z0-9\s.,!?;:'"()-]       -> " "
#   spaces    \s+                          -> " ", then strip
TAG_RE = "<[^>]+>"
URL_RE = f"https?://{NOT_WS}+|www\\.{NOT_WS}+"
KEEP_RE = f"[^a-z0-9{WS}.,!?;:'\"()\\-]"
SPACE_RE = f"[{WS}]+"
# Whitelist and collapse in one pass: a maximal run of characters that are
# whitespace or outside the whitelist becomes one space (same result as the
# two steps, since a replaced character joins the whitespace run around it).
# A lone space is already its own result, so runs are matched only when they
# start with another character or are longer than one space: far fewer
# replacements on ordinary prose.
# Java looks a class of single Latin-1 characters up in one table; ranges make it a chain of
# calls, which is several times slower and more so the more tasks an executor runs.
_WORD = string.ascii_lowercase + string.digits
_OUT = f"[^{_WORD}.,!?;:'\"()\\-]"
_OUT_NOT_SPACE = f"[^{_WORD}.,!?;:'\"()\\- ]"
KEEP_OR_SPACE_RE = f"{_OUT_NOT_SPACE}{_OUT}*| {_OUT}+"
# Word tokens of the vectoriser on cleaned text: two or more of [a-z0-9]
# (the public default ``\b\w\w+\b`` restricted to the cleaned alphabet).
TOKEN_RE = "[a-z0-9]{2,}"
_TOKEN = f"[{_WORD}]{{2,}}"  # the same, for Java


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Character references of HTML5, by the standard's rules: a decimal or hexadecimal number, or
# a name of up to 32 characters, each with or without a semicolon.
REF_RE = "&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\\t\\n\\f <&#;]{1,32};?)"


def _names() -> Column:
    """Names of HTML5 (Python's copy of the standard's table) as a constant map."""
    return F.from_json(F.lit(json.dumps(html5)), "map<string,string>")


# Names that also count without a semicolon; the longest that a reference begins with wins.
LEGACY_RE = "^(" + "|".join(sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))) + ")"


def _windows() -> dict[str, str]:
    """Numbers that stand for another character: those of Windows-1252, NUL, and CR."""
    out = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    return {str(n): c for n, c in (out | {0: "\ufffd", 0x0D: "\r"}).items()}


def _character(n: Column) -> Column:
    """The character of a code point, from its UTF-8 bytes."""
    byte = lambda v: F.lpad(F.hex(v), 2, "0")
    tail = lambda k: byte(F.shiftright(n, 6 * k).bitwiseAND(F.lit(63)) + 128)
    return F.decode(F.unhex(
        F.when(n < 0x80, byte(n)).when(n < 0x800, F.concat(byte(F.shiftright(n, 6) + 192), tail(0)))
        .when(n < 0x10000, F.concat(byte(F.shiftright(n, 12) + 224), tail(1), tail(0)))
        .otherwise(F.concat(byte(F.shiftright(n, 18) + 240), tail(2), tail(1), tail(0)))), "UTF-8")


def _number(ref: Column) -> Column:
    """The text of a reference by number (``#65;`` or ``#x41``)."""
    hexa = F.lower(F.substring(ref, 2, 1)) == "x"
    digits = F.regexp_extract(ref, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    digits = F.when(digits == "", "0").otherwise(digits)
    n = F.when(F.length(digits) > 8, F.lit(1 << 40)).when(hexa, F.conv(digits, 16, 10).cast("long")).otherwise(
        F.conv(digits, 10, 10).cast("long"))
    other = F.try_element_at(F.from_json(F.lit(json.dumps(_windows())), "map<string,string>"), n.cast("string"))
    none = (n.between(0x1, 0x8) | n.between(0xE, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n == 0xB)
            | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (F.when(other.isNotNull(), other).when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
            .when(none, F.lit("")).otherwise(_character(n)))


def _reference(ref: Column) -> Column:
    """What a reference (without its ampersand) stands for; unknown ones stay."""
    named = F.try_element_at(_names(), ref)
    legacy = F.regexp_extract(ref, LEGACY_RE, 1)
    begun = F.concat(F.try_element_at(_names(), legacy), F.substring(ref, F.length(legacy) + 1, F.length(ref)))
    return (F.when(ref.startswith("#"), _number(ref)).when(named.isNotNull(), named).when(legacy != "", begun)
            .otherwise(F.concat(F.lit("&"), ref)))


def unescape_entities(col: str | Column) -> Column:
    """HTML5 character references as their characters, by native expressions: the text is
    split at its references, each is looked up, and all is joined again. Texts without
    ``&`` before a letter or ``#`` pass as they are."""
    c = _c(col)
    parts = F.split(c, REF_RE)
    found = F.transform(F.regexp_extract_all(c, F.lit(REF_RE), 1), _reference)
    joined = F.zip_with(parts, F.concat(found, F.array(F.lit(""))), lambda p, r: F.concat(p, r))
    return F.when(c.rlike("&[A-Za-z#]"), F.array_join(joined, "")).otherwise(c)


def clean_native(col: str | Column) -> Column:
    """Everything after the entity unescape, fully JVM-side."""
    c = F.lower(_c(col))
    c = F.regexp_replace(c, TAG_RE, "")
    c = F.regexp_replace(c, URL_RE, " ")
    c = F.regexp_replace(c, KEEP_OR_SPACE_RE, " ")
    return F.trim(c)


def clean_text(col: str | Column, unescape: bool = True) -> Column:
    """the cleaning function used for both training and scoring.

    ``str()`` of a null is the text ``None``, as in the Python definition.
    """
    c = F.coalesce(_c(col), F.lit("None"))
    if unescape:
        c = unescape_entities(c)
    return clean_native(c)


def sha256_hex(col: str | Column) -> Column:
    """F8: SHA-256 of the UTF-8 bytes, hex."""
    return F.sha2(_c(col), 256)


def char_length(col: str | Column) -> Column:
    """length in code points."""
    return F.char_length(_c(col))


def prefix(col: str | Column, n: int) -> Column:
    """the first ``n`` characters."""
    return F.substring(_c(col), 1, n)


def format_score(value: Column, digits: int = 4) -> Column:
    """a number with fixed decimals, as in ``f"{x:.4f}"``."""
    return F.format_string(f"%.{digits}f", value)


def as_category(col: str | Column) -> Column:
    """any value as text; null becomes the category ``None``."""
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def tokens(col: str | Column, pattern: str = _TOKEN) -> Column:
    """word tokens of (cleaned) text."""
    return F.regexp_extract_all(_c(col), F.lit(pattern), 0)


def ngrams(tok: str | Column, n_max: int = 2) -> Column:
    """unigrams followed by adjacent pairs joined by a space.

    ``tok`` should be a column reference: the lambda looks elements up in it,
    and an expression there would be re-evaluated per element.
    """
    t = _c(tok)
    out = t
    for n in range(2, n_max + 1):
        k = F.size(t) - (n - 1)
        grams = F.transform(
            F.sequence(F.lit(1), F.greatest(k, F.lit(1))),
            lambda i: F.concat_ws(" ", *[F.element_at(t, i + j) for j in range(n)]))
        grams = F.when(k > 0, grams).otherwise(F.array().cast("array<string>"))
        out = F.concat(out, grams)
    return out


def admissible(col: str | Column, max_len: int = 5000) -> Column:
    """Request text length within 1..max_len."""
    n = char_length(col)
    return _c(col).isNotNull() & (n >= 1) & (n <= max_len)
