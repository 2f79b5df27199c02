from itertools import combinations

import numpy as np

from baflow.llm import toxicity
from tests.llm.helpers import odd_documents

PLAIN = "the quick brown fox jumps over lazy dogs while many people walk along green rivers every single morning".split()


def brute_kernel(s, t, p, decay):
    def weights(x):
        out = {}
        for c in combinations(range(len(x)), p):
            w = "".join(x[k] for k in c)
            out[w] = out.get(w, 0) + decay ** (c[-1] - c[0] + 1)
        return out
    a, b = weights(s), weights(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_kernel_is_the_subsequence_kernel():
    rng = np.random.default_rng(0)
    for _ in range(80):
        s, t = ("".join(rng.choice(list("abcd"), rng.integers(1, 10))) for _ in range(2))
        got = toxicity.pair_kernel(toxicity._codes([s]), toxicity._codes([t]))[0]
        assert abs(got - brute_kernel(s, t, toxicity.ORDER, toxicity.DECAY)) < 1e-5


def _corpus(rng, n=400):
    out = []
    for k in range(n):
        w = list(rng.choice(PLAIN, 30))
        if k % 4 == 0:
            w[int(rng.integers(30))] = str(rng.choice(["blorkhead", "snarvik", "quimble"]))
        out.append((k, " ".join(w), int(k % 4 == 0)))
    return out


def test_learned_and_tolerant(spark):
    rng = np.random.default_rng(1)
    rows = _corpus(rng)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.landmarks
    tests = [(1, "a blorkhead here", 1), (2, "you b.l.o.r.k.h.e.a.d you", 1), (3, "blorkxhead", 1), (4, "the quick fox", 0),
             (5, "s n a r v i k is what", 1), (6, " ".join(PLAIN), 0), (7, None, 0), (8, "", 0), (9, "SNARVIK!", 1),
             (None, "quimmble", 1), (10, "x" * 100000, 0), (11, "1 2 3", 0)]
    got = toxicity.score(spark.createDataFrame([t[:2] for t in tests], "doc_id long, text string").coalesce(1), model).collect()
    assert [r["predicted"] for r in got] == [t[2] for t in tests]
    assert all(0 <= r["score"] <= 1 for r in got)


def test_no_labels(spark):
    docs = odd_documents(spark)
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count() and {r["predicted"] for r in got} == {0}
    assert toxicity.score(docs.where("false"), model).count() == 0
