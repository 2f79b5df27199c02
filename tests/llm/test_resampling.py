import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from baflow.llm import resampling
from tests.llm.helpers import SMALL, odd_documents


def features(text, longest=1):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [" ".join(w[k:k + n]) for n in range(1, longest + 1) for k in range(len(w) - n + 1)], len(w)


def expected(docs, target, longest=1, buckets=10_000):
    """(doc_id, n_features, weight, score, rank) of every row, straight from the definition."""
    b = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(b(f) for x in texts for f in features(x, longest)[0]) for texts in ([x for _, x in docs], target))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (S + buckets) / ((s[k] + 1) * (T + buckets)))) for k in range(buckets)]
    rows = []
    for i, x in docs:
        fs, n = features(x, longest)
        weight = sum(gain[b(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((k for k in range(len(rows)) if rows[k][4] >= 20),
                  key=lambda k: (-rows[k][3], rows[k][0] is None, rows[k][0] or 0))
    rank = {k: r + 1 for r, k in enumerate(able[:10 * len(able) // 100])}
    return sorted(((*rows[k][:4], rank.get(k)) for k in range(len(rows))), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_whole_table_against_the_definition(spark, longest):
    docs, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    pd_docs, pd_bench = pd.read_parquet(f"{SMALL}/documents.parquet"), pd.read_parquet(f"{SMALL}/benchmark.parquet")
    rows = resampling.resample(docs.repartition(5), bench, longest)
    assert got(rows) == expected(list(zip(pd_docs["doc_id"], pd_docs["text"])), list(pd_bench["text"]), longest)


def test_words_of_every_shape(monkeypatch):
    texts = ["", None, "A", "ab-CD_ef 12é", "é" * 100, "x" * 64 + " " + "y" * 65 + " " + "Z" * 5000, "\x00a\x7fb", "日本 語", " ", "a" * 63 + "é"] * 3
    want = [[zlib.crc32(f.encode()) % 10_000 for f in features(t)[0]] for t in texts]
    for piece in (4_000_000, 100, 7):
        monkeypatch.setattr(resampling, "PIECE", piece)
        owner, bucket, words = resampling.features(pa.array(texts, pa.string()))
        assert [bucket[owner == k].tolist() for k in range(len(texts))] == want
        assert words.tolist() == [len(x) for x in want]
        owner, bucket, _ = resampling.features(pa.array(texts, pa.string()).slice(3, 5), 3)
        for k in range(5):
            assert sorted(bucket[owner == k].tolist()) == sorted(zlib.crc32(f.encode()) % 10_000 for f in features(texts[3 + k], 3)[0])


def test_planes_sum_exactly():
    rng = np.random.default_rng(5)
    for buckets in (1, 64, 1000, 10_000):
        gain = rng.integers(-30_000, 30_000, buckets)
        owner = np.sort(rng.integers(0, 9, 20_000))
        bucket = rng.integers(0, buckets, 20_000) * (rng.random(20_000) < 0.3).astype(int)
        want = np.zeros(10, "i8")
        np.add.at(want, owner, gain[bucket])
        assert resampling.GainPlanes(gain).sums(owner, bucket, 10).tolist() == want.tolist()
    assert resampling.GainPlanes(np.zeros(100, "i8")).sums(np.zeros(3, "i4"), np.zeros(3, "i4"), 1).tolist() == [0]


def test_ties_and_odd_rows(spark):
    bench = spark.createDataFrame([(1, "the cat"), (2, None)], "item_id long, text string")
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(resampling.resample(docs.drop("score"), bench)) == expected(rows, ["the cat", None])
    same = [(k % 40, "w " * 20) for k in range(400)]                    # repeated rows, one score for each id
    table = spark.createDataFrame(same, "doc_id long, text string").repartition(7)
    assert got(resampling.resample(table, bench)) == expected(same, ["the cat", None])
    assert resampling.resample(docs.limit(0), bench).count() == 0
    assert got(resampling.resample(docs, bench.limit(0))) == expected(rows, [])


def test_kept_columns(spark):
    docs = spark.createDataFrame([(k, "a b " * k, "s") for k in range(50)], "doc_id long, text string, source string")
    rows = resampling.resample(docs, docs.limit(3), keep=("doc_id", "source", "text")).where("rank is not null").collect()
    assert len(rows) == 4 and all(r["text"] == "a b " * r["doc_id"] and r["source"] == "s" for r in rows)
