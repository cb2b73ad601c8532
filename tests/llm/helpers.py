"""Small fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rnd: random.Random, n: int, stems=("ka", "lo", "mi", "ré", "su", "ta", "ne", "wi")) -> str:
    return " ".join("".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def docs_frame(spark, rows, extra: bool = False):
    """Rows (doc_id, text, lang, source); ``extra`` adds columns whose names the
    operators use inside."""
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS)
    if extra:
        for name in ("node", "block", "language", "draw", "spans", "root", "tiles", "_own", "_who", "rank", "part"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def odd_rows(rnd: random.Random):
    """Nulls, empty and very long texts, ties and repeated rows."""
    base = [words(rnd, rnd.randint(5, 60)) for _ in range(12)]
    rows = [(i, t, "xx" if i % 2 else "yy", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(20, None, None, None), (21, "", "xx", "s0"), (22, "   ", None, "s0"), (23, words(rnd, 20_000), "yy", None),
             (24, base[0], "yy", "s1"), (24, base[0], "yy", "s1"), (25, base[1].upper(), "xx", "s1"),
             (None, base[2], "xx", "s2"), (None, None, None, None), (26, "12 34 !!", "xx", "s0"), (27, "a", "yy", "s9")]
    return rows


def shingle_set(text: str | None) -> frozenset:
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_brute(rows, threshold=0.8):
    """Row number -> (documents linked, smallest row number of the class)."""
    sets = [shingle_set(r[1]) for r in rows]
    n = len(rows)
    links, label = [0] * n, list(range(n))
    pairs = [(i, j) for i in range(n) for j in range(i) if sets[i] and sets[j]
             and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    while True:
        new = list(label)
        for i, j in pairs:
            new[i] = new[j] = min(new[i], new[j])
        if new == label:
            return links, label
        label = new


def repeats_brute(texts, length):
    """Per text: bytes, removed bytes, spans, the bytes that stay."""
    raws = [(t or "").encode() for t in texts]
    count = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if count[r[i:i + length]] > 1:
                gone[i:i + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        out.append((len(r), int(gone.sum()), int((edges == 1).sum()), bytes(np.frombuffer(r, np.uint8)[~gone])))
    return out


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
