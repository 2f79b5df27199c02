from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from baflow.llm import mixing
from tests.llm.helpers import odd_documents, words


def plan(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing out round by round, in plain Python."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, stopped = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(most * sizes[s] for s in stopped)
        w = sum(weight[s] for s in names if s not in stopped)
        level = left / w if w else float("inf")
        new = {s for s in names if s not in stopped and most * sizes[s] <= level * weight[s]}
        if not new:
            return {s: most * sizes[s] if s in stopped else level * weight[s] for s in names}
        stopped |= new


def check(docs, got, **kw):
    sizes = defaultdict(int)
    for s, t in docs:
        sizes[s] += len(words(t))
    want = plan(sizes, **kw)
    taken = defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= kw.get("most", 2) * r["size"]
        taken[r["source"]] += r["taken"]
    return want, taken


def test_budgets_met_to_the_word(spark):
    rows = [(k, f"s{k % 7}" if k % 11 else None, "w " * (k * 37 % 90)) for k in range(3000)]
    docs = spark.createDataFrame([(k, t, None, s, 0) for k, s, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.decisions(docs).collect()
    want, taken = check([(s, t) for _, s, t in rows], got)
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    # below the threshold whole documents, above it none; budgets are nested
    for s in want:
        mine = sorted((r["h"], r["taken"] / r["size"]) for r in got if r["source"] == s and r["size"])
        shares = [x for _, x in mine]
        assert shares == sorted(shares, reverse=True)
    less = {r["doc_id"]: r["taken"] for r in mixing.decisions(docs, share=0.7).collect()}
    level = plan({s: sum(len(words(t)) for _, s2, t in rows if s2 == s) for s in want}, share=0.7)
    for r in got:
        if level[r["source"]] <= want[r["source"]]:
            assert less[r["doc_id"]] <= r["taken"]
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.decisions(docs.repartition(5)).collect()))


def test_all_sources_full(spark):
    docs = spark.createDataFrame([(k, "a b c", f"s{k % 3}") for k in range(30)], "doc_id long, text string, source string")
    assert {r["taken"] for r in mixing.decisions(docs, share=5.0).collect()} == {6}


def test_one_long_document_and_many_sources(spark):
    rows = [(0, "big", "x " * 100_000)] + [(k, f"host{k}", "a b c d") for k in range(1, 400)]
    docs = spark.createDataFrame([(k, t, s) for k, s, t in rows], "doc_id long, text string, source string")
    want, taken = check([(s, t) for _, s, t in rows], mixing.decisions(docs).collect())
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)


def test_repeated_ids_share_the_rest(spark):
    rows = [(5, "a", "one two three four five six")] * 500 + [(k, "b", "x y") for k in range(100)]
    docs = spark.createDataFrame([(k, t, s) for k, s, t in rows], "doc_id long, text string, source string")
    want, taken = check([(s, t) for _, s, t in rows], mixing.decisions(docs, weights=(1, 1), share=0.5).collect(), weights=(1, 1), share=0.5)
    assert 0 <= want["a"] - taken["a"] < 500 and abs(taken["b"] - want["b"]) <= 0.5


def test_odd_rows_and_empty_table(spark):
    docs = odd_documents(spark)
    rows = [(r["source"], r["text"]) for r in docs.collect()]
    got = mixing.decisions(docs).collect()
    assert len(got) == len(rows)
    check(rows, got)
    assert mixing.decisions(docs.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.decisions(docs.withColumn("text", F.lit(None).cast("string"))).collect()} == {0}


def test_texts_of_the_mix(spark):
    docs = spark.createDataFrame(pd.DataFrame({"text": ["a  b\tc", "d e f", "", "g"], "size": [3, 3, 0, 1], "taken": [5, 2, 0, 2]}))
    got = docs.select(mixing.repeated(F.col("text"), F.col("size"), F.col("taken")).alias("t")).collect()
    assert [r["t"] for r in got] == [["a  b\tc", "a b"], ["d e"], [], ["g", "g"]]
