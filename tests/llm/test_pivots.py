import numpy as np
import pandas as pd

from baflow.llm import pivots
from baflow.llm.queries import QUERIES
from tests.llm.helpers import SMALL, Forest


def brute(ids, x):
    n, f = len(ids), Forest(len(ids))
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    for a, b in zip(*np.nonzero(near), strict=True):
        f.join(int(a), int(b))
    low = {}
    for k in range(n):
        low[f.find(k)] = min(low.get(f.find(k), ids[k]), ids[k])
    return near.sum(axis=1), np.array([low[f.find(k)] for k in range(n)])


def test_recall_on_groups(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 32)           # long lists are cut into blocks
    rng = np.random.default_rng(4)
    x = [rng.normal(size=(300, 32))]
    for size in (2, 5, 120):
        c = rng.normal(size=32)
        x.append(c + 0.12 * rng.normal(size=(size, 32)))
    x = np.vstack(x).astype("f4")
    ids = list(range(10, 10 + len(x)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>")
    got = pivots.near_duplicates(df).toPandas().sort_values("vec_id")
    n, comp = brute(ids, x.astype("f8"))
    assert got["n_links"].sum() >= 0.9 * n.sum() and (got["n_links"].to_numpy() <= n).all()
    assert (got["component_id"].to_numpy() == comp).mean() > 0.98
    assert (got["kept"] == (got["vec_id"] == got["component_id"])).all()


def test_query(spark):
    got = QUERIES["op10_pivot_permutations"](spark, SMALL).toPandas().sort_values("vec_id")
    t = pd.read_parquet(f"{SMALL}/embeddings.parquet").sort_values("vec_id")
    n, _ = brute(t["vec_id"].tolist(), np.stack(t["embedding"]).astype("f8"))
    assert len(got) == len(t) and got["n_links"].sum() >= 0.9 * n.sum() and (got["n_links"].to_numpy() <= n).all()


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.1]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]),
            (8, [1.0]), (9, []), (10, [0.0, 1.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0]), (11, [float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<float>, n_links double")
    got = {(r["vec_id"], r["n_links"], r["component_id"]) for r in pivots.near_duplicates(df).collect()}
    linked = {(v, 4, 1) for v in (1, 2, 3, None)}
    assert got == linked | {(v, 0, v) for v in (4, 5, 6, 7, 8, 9, 10, 11)}
    assert pivots.near_duplicates(df.where("false")).count() == 0


def _against_brute(spark, x):
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = pivots.near_duplicates(df).toPandas().sort_values("vec_id")
    n, comp = brute(list(range(len(x))), x)
    assert n.sum() and got["n_links"].tolist() == n.tolist() and got["component_id"].tolist() == comp.tolist()


def test_one_group_and_common_direction(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 32)
    rng = np.random.default_rng(8)
    c = rng.normal(size=16)
    _against_brute(spark, c + 0.1 * rng.normal(size=(150, 16)))           # one group of near copies
    _against_brute(spark, np.array([[1.0, 0.0], [0.99, 0.14]]))
    common = 4 * c + rng.normal(size=(120, 16))                           # all cosines over 0.8
    _against_brute(spark, np.vstack([common, common[:40] + 0.1 * rng.normal(size=(40, 16))]))


def test_every_length_is_searched(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = [rng.normal(size=(40, d)) for d in (8, 12, 4)] + [rng.normal(size=(3, 6))]
    x = [np.vstack([v, v[:n] + 0.01 * rng.normal(size=(n, v.shape[1]))]) for v, n in zip(x, (20, 15, 10, 1), strict=True)]
    df = spark.createDataFrame([(100 * k + j, v.tolist()) for k, m in enumerate(x) for j, v in enumerate(m)],
                               "vec_id long, embedding array<double>")
    for few in (52, 1000):                              # two lengths with an index, then one
        monkeypatch.setattr(pivots, "FEW_VECTORS", few)
        got = pivots.near_duplicates(df).toPandas().sort_values("vec_id")
        want = [brute([100 * k + j for j in range(len(m))], m) for k, m in enumerate(x)]
        assert got["n_links"].tolist() == np.concatenate([w[0] for w in want]).tolist()
        assert got["component_id"].tolist() == np.concatenate([w[1] for w in want]).tolist()
