"""Small fixtures and plain reference implementations for the corpus operators."""
from __future__ import annotations

import re
from collections import Counter, defaultdict

import pandas as pd

SMALL = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, leaks string"


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing extra columns."""
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "s", 0, 1.0, "x"), (3, " \n\t", "de", "s", 3, 1.0, "x"),
            (4, "12 345 ...", "en", "s", 10, 1.0, "x"), (5, "the cat and the dog " * 20000, "en", "s", 400000, 1.0, "x"),
            (6, "a b c d e", "en", "s", 9, 1.0, "x"), (6, "a b c d e", "en", "s", 9, 1.0, "x"),
            (None, "mail me at a.b@example.com or +1 415 555 2671 now", "en", None, 40, None, None),
            (7, "A B c d E", "en", "s", 9, 1.0, "x"), (8, "é" * 5000, "fr", "s", 5000, 1.0, "x")]
    return spark.createDataFrame(rows, ODD)


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in (text or ""))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


class Forest:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x, y):
        self.up[self.find(x)] = self.find(y)


def jaccard_components(ids, texts, n=4):
    """Brute force over all pairs with a common shingle: (set size, least id reachable) per row."""
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    lists, f = defaultdict(list), Forest(len(ids))
    for k, s in enumerate(sets):
        for t in s:
            lists[t].append(k)
    for k, s in enumerate(sets):
        for j, common in Counter(j for t in s for j in lists[t] if j > k).items():
            if 100 * common >= 85 * (len(s) + len(sets[j]) - common):
                f.join(k, j)
    low = {}
    for k, i in enumerate(ids):
        r = f.find(k)
        low[r] = i if low.get(r) is None else (low[r] if i is None else min(low[r], i))
    return [(len(sets[k]), low[f.find(k)]) for k in range(len(ids))]


def documents(folder=SMALL):
    return pd.read_parquet(f"{folder}/documents.parquet")
