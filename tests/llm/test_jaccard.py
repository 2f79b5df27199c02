import random

import numpy as np

from baflow.llm import jaccard
from baflow.llm.queries import QUERIES
from tests.llm.helpers import SMALL, documents, jaccard_components, odd_documents


def _compare(rows, ids, texts):
    want = sorted(zip([-1 if i is None else i for i in ids], jaccard_components(ids, texts), strict=True), key=str)
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"], (r["n_shingles"], r["component_id"])) for r in rows), key=str)
    assert got == want


def test_against_brute_force_on_edited_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "HOT_ROUTE", 40)      # common shingles are dealt over several tasks here
    monkeypatch.setattr(jaccard, "PROBE", 16)          # and long routes probed in shares
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randint(1, 120))] for _ in range(30)]
    texts = []
    for k in range(500):
        w = list(rng.choice(base[:4] if k % 2 else base))
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    ids = [7 + 3 * k for k in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(5)
    _compare(jaccard.join_components(docs).collect(), ids, texts)


def test_query(spark):
    docs = documents()
    _compare(QUERIES["op8_count_vector_join"](spark, SMALL).collect(), docs["doc_id"].tolist(), docs["text"].tolist())


def test_bound_never_loses_a_link():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 60, 80, dtype="u8"))
        b = np.union1d(a[int(rng.integers(0, 12)):], rng.integers(0, 1 << 60, 4, dtype="u8"))
        over = int(np.minimum(jaccard._group_counts(a), jaccard._group_counts(b)).sum())
        assert over >= len(np.intersect1d(a, b))
        tree = jaccard.CountTree(np.array([len(a), len(b)]), np.stack([jaccard._group_counts(x) for x in (a, b)]),
                                 np.array([1, 2]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 85 * (len(a) + len(b) - both):
            assert len(tree.search(0, 85, 100)) == 1


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.join_components(docs).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (6, 2, 6), (7, 2, 6), (5, 5, 5)} <= rows
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted("1 2 3 4 5 6 8 None".split())
    assert jaccard.join_components(docs.where("false")).count() == 0
