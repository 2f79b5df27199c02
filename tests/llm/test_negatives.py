import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from baflow.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>, place long, score double, extra string"


def brute(rows, positives=5, count=10, low=30, high=90):
    """The contract over all pairs; rows are (id, label, integer tuple)."""
    out = []
    anchors = sorted({r for r in rows if r[0] % 100 == 0})
    for i, label, v in anchors:
        mine = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in rows if j != i and len(w) == len(v)]
        others = sorted((s, j) for s, j, m in mine if m != label)
        for s, j in sorted((s, j) for s, j, m in mine if m == label)[:positives]:
            band = [(t, k) for t, k in others if low * -s <= 100 * -t <= high * -s][:count]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(band)]
    return sorted(out)


def integers(rows):
    return [(i, m, tuple(int(np.floor(256 * x)) for x in v)) for i, m, v in rows]


def got(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame([(i, m, [float(x) for x in v], 1, 1.0, "x") for i, m, v in rows], SCHEMA)


@pytest.mark.parametrize("kind", ["random", "groups", "one direction", "whole numbers"])
def test_against_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)          # several blocks and parts
    monkeypatch.setattr(negatives, "CLUSTER_ANCHORS", 4)
    monkeypatch.setattr(negatives, "STEP", 16)
    monkeypatch.setattr(negatives, "SEED_ROWS", 60)
    rng = np.random.default_rng(3)
    n = 900
    x = rng.normal(size=(n, 6))
    if kind == "groups":
        x = np.repeat(rng.normal(size=(9, 6)), 100, axis=0) + 0.1 * x
    if kind == "one direction":
        x = x * 0.05 + 1
    if kind == "whole numbers":
        x = np.round(x)                                          # many ties, zero vectors
    rows = [(k, int(rng.integers(0, 4)), tuple(x[k])) for k in range(n)]
    df = frame(spark, rows).repartition(5)
    assert got(negatives.mine(df, F.col("vec_id") % 100 == 0)) == brute(integers(rows))


def test_walks_end_early():
    """On grouped vectors the certified end spares most scores, and the lists hold what a full search finds."""
    rng = np.random.default_rng(4)
    n = 4000
    x = np.floor(256 * (np.repeat(rng.normal(size=(40, 16)), 100, axis=0) + 0.02 * rng.normal(size=(n, 16))))
    labels = rng.integers(0, 3, n)
    anchors = np.arange(0, 100, 10)
    c = negatives.Cluster(np.arange(10), anchors, labels[anchors], x[anchors], negatives.centres(x[anchors], 1)[0])
    lists = negatives.Lists(10, 5, np.full(10, negatives.NONE))
    done = negatives.walk([c], lists, 1, True, np.full(10, negatives.NEVER), np.arange(n), labels, x)
    assert done < 0.3 * 10 * n
    place, ids, score = lists.entries()
    for p, a in enumerate(anchors):
        full = sorted((-int(x[a] @ x[j]), j) for j in range(n) if j != a and labels[j] == labels[a])[:5]
        assert [(-s, j) for s, j in zip(score[place == p], ids[place == p])] == full


def test_large_numbers_are_exact():
    a = np.array([[2.0 ** 30 - 1, 3.0], [1.0, 2.0]])
    b = np.array([[2.0 ** 30 - 1, 1.0], [-(2.0 ** 29), 5.0]])
    assert negatives.products(a, b).tolist() == [[int(p[0]) * int(q[0]) + int(p[1]) * int(q[1]) for q in b] for p in a]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (100, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (1, 1, [0.9, 0.1]), (2, 0, [0.5, 0.5]), (2, 0, [0.5, 0.5]),
            (3, 0, [0.5, 0.1]), (4, 2, [0.0, 0.0]), (5, 2, [-1.0, 0.0]), (200, 2, [0.0, 0.0]), (300, 5, [1.0, 0.0]), (6, 1, [1.0, 0.0, 0.0]), (300, 1, [0.6, 0.0]),
            (400, 1, []), (7, 1, [])]
    bad = [(None, 1, [1.0, 0.0]), (500, None, [1.0, 0.0]), (600, 1, None), (8, 1, [1.0, nan]), (9, 1, [inf, 0.0]), (10, 1, [1.0, None]), (11, 1, [1e30, 0.0])]
    df = spark.createDataFrame([(i, m, v, 1, 1.0, "x") for i, m, v in rows + bad], SCHEMA)
    want = brute([(i, m, tuple(int(np.floor(256 * x)) for x in v)) for i, m, v in rows])
    assert got(negatives.mine(df, F.col("vec_id") % 100 == 0)) == want and want
    assert negatives.mine(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(df.where("vec_id < 100"), F.col("vec_id") % 100 == 7).count() == 0


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    from baflow.llm.queries import op11_shared_list_negatives
    t = pd.read_parquet(f"{folder}/embeddings.parquet")
    rows = [(int(i), (int(m) + 1) % 10 if i % 7 == 0 else int(m), tuple(v)) for i, m, v in zip(t["vec_id"], t["label"], t["embedding"])]
    assert got(op11_shared_list_negatives(spark, folder)) == brute(integers([(i, m, [float(x) for x in v]) for i, m, v in rows]))
