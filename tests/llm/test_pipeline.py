import zlib

import numpy as np
import pytest

import corpus_pipeline
from baflow.llm import decontam, pii
from baflow.llm.common import save
from tests.llm.helpers import SMALL, Forest, documents, jaccard_components, odd_documents, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    import pandas as pd
    docs = corpus_pipeline.read(spark, SMALL, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, SMALL), "test")
        seen[name] = docs.toPandas()
        if name != "packing":
            assert list(seen[name].columns) == COLUMNS
    first = documents()
    a, b, c, d, e = (seen[n] for n, _ in corpus_pipeline.STAGES)
    # clean documents stay in the first stage: all of these have letters and a known language
    assert len(a) >= 0.98 * len(first)
    comp = jaccard_components(a["doc_id"].tolist(), a["text"].tolist())
    assert set(b["doc_id"]) == {i for i, (n, low) in zip(a["doc_id"], comp, strict=True) if low == i or n == 0}
    items = [" ".join(decontam.normal_words(t)) for t in pd.read_parquet(f"{SMALL}/benchmark.parquet")["text"]]
    leaks = {i for i, t in zip(b["doc_id"], b["text"], strict=True) if any(x in " ".join(decontam.normal_words(t)) for x in items)}
    assert leaks and set(c["doc_id"]) <= set(b["doc_id"]) - leaks and len(c) >= len(b) - len(leaks) - 2
    assert set(d["doc_id"]) == set(c["doc_id"])
    assert not any(pii.base_spans(t) for t in d["text"])
    assert (d["n_chars"] == d["text"].str.len()).all()
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers as P
    tok = tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = d.set_index("doc_id")["text"]
    for i, pieces in e.groupby("doc_id"):
        ids = np.array(tok.encode(texts[i], add_special_tokens=False).ids + [2], "<u4")
        assert pieces["length"].sum() == len(ids)
        assert all(zlib.crc32(ids[s:s + n].tobytes()) == x for s, n, x in zip(
            pieces["start"], pieces["length"], pieces["ids_crc32"], strict=True))
    assert set(e["doc_id"]) == set(d["doc_id"])


def test_odd_rows_and_empty_table(spark):
    for docs in (odd_documents(spark), odd_documents(spark).where("false")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = save(stage(spark, docs, SMALL), "test")
            assert name == "packing" or docs.columns == columns


def test_near_duplicates_at_five_words(spark):
    plain = [f"w{k}" for k in range(100)]
    near, far = list(plain), list(plain)
    near[30] = near[70] = "x"                          # 86 of 106 shingles of five words: 0.811
    far[20] = far[40] = far[60] = "x"                  # 81 of 111: 0.730
    rows = [(1, plain), (2, near), (3, far)] + [(k, [f"a{k}", "b", "c", "d", f"e{k}"]) for k in (4, 5)]
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 1) for i, w in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SMALL).collect()) == [1, 3, 4, 5]


def test_near_duplicates_against_brute_force(spark):
    docs = documents()
    text = [" ".join(t.split()[:60]) for t in docs["text"].fillna("")]
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} or {tuple(w)} - {()} for w in map(words, text)]
    forest = Forest(len(sets))
    for i, s in enumerate(sets):
        for j, t in enumerate(sets[:i]):
            if s and 10 * len(s & t) >= 8 * len(s | t):
                forest.join(i, j)
    ids, low = docs["doc_id"].tolist(), {}
    for k, i in enumerate(ids):
        low[forest.find(k)] = min(i, low.get(forest.find(k), i))
    want = {i for k, i in enumerate(ids) if not sets[k] or low[forest.find(k)] == i}
    rows = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in zip(ids, text, strict=True)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["n-gram Jaccard join"]
    assert {r["doc_id"] for r in stage(spark, rows, SMALL).collect()} == want
