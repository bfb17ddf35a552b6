"""Awkward documents, and plain versions of the operators to compare with."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copies int, n_words int"


def documents(spark, texts, lang="en"):
    """Texts as documents; columns beyond the usual ones clash with names the operators use."""
    rows = [
        (i, t, lang, None if i % 7 == 3 else f"s{i % 3}", len(t or ""), 99, -1)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "one two three",
    "ein Wort. Noch ein Wort. Ein Wort noch.",
    "x y z x y z x y z",
    "\x1c\x85 odd spaces ́combining ﬁ Straße İstanbul Σίσυφος",
    "word " * 3000,
    "🙂 emoji 🙂 text 12,5% <|endoftext|> it's",
    "one two three",
]


def repeated_words(text):
    w = WORD.findall(text or "")
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)})


def shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(lower)
    if 0 < len(w) < words:
        return {tuple(w)}
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}


def smallest_reachable(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}
