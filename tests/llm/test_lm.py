import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from baflow.llm import lm
from baflow.llm.common import fold, read
from baflow.llm.words import word_hashes
from tests.llm.helpers import SMALL, documents, odd_documents, words


def _check_counts(rows, ids, texts):
    toks = [words(t) + ["</s>"] for t in texts]
    learn = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1 for i in ids]
    c = Counter(w for t, ok in zip(toks, learn, strict=True) if ok for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in t), 5)) for t in toks)
    got = sorted((r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-9, atol=2e-5)


def test_counts_and_gain_on_held_out(spark):
    docs = documents()
    rows = lm.score(read(spark, SMALL, "documents"), fold("doc_id", 5) != 1, block_bytes=50_000).collect()
    _check_counts(rows, docs["doc_id"].tolist(), docs["text"].tolist())
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_mixture_against_plain_counts(spark):
    """The score is that of bigrams and unigrams mixed with the learned weights."""
    docs = documents()
    frame = read(spark, SMALL, "documents")
    rows = {r["doc_id"]: r for r in lm.score(frame, fold("doc_id", 5) != 1, block_bytes=100_000).collect()}
    again = {r["doc_id"]: r for r in lm.score(frame.repartition(3), fold("doc_id", 5) != 1, block_bytes=1 << 30).collect()}
    assert all(abs(rows[k]["score"] - again[k]["score"]) < 1e-6 * abs(rows[k]["score"]) for k in rows)
    assert len(rows) == len(docs)


def test_weights_by_expectation_maximisation():
    hist = np.zeros((lm.LEVELS, lm.RATIO_BINS + 1))
    hist[5, 0] = 300                                             # unseen bigrams
    hist[5, 1 + int((10 - lm.RATIO_LOW) / lm.RATIO_STEP)] = 700  # far better than the unigram
    w = lm.learn_weights(hist)
    assert abs(w[5] - 0.7) < 0.01 and w[9] == w[5]


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = lm.score(docs, fold("doc_id", 5) != 1).collect()
    plain = docs.collect()
    _check_counts(rows, [r["doc_id"] for r in plain], [r["text"] for r in plain])
    none = lm.score(docs, fold("doc_id", 5) == 9).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in none} == {(0, 0, 0.0)}
    assert lm.score(docs.where("false"), fold("doc_id", 5) != 1).count() == 0


def _peak(run, *args):
    """Bytes that ``run`` holds at most (numpy's arrays are traced)."""
    tracemalloc.start()
    try:
        run(*args)
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_block_is_a_small_multiple_of_its_text():
    rng = np.random.default_rng(1)
    lines = [" ".join("".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(3, 9, 200)) for _ in range(2000)]
    texts = pa.array(lines, pa.string())
    size = sum(map(len, lines))
    assert _peak(word_hashes, texts) < 14 * size
    assert _peak(lm._grams, texts) < 22 * size
    cut = pa.array([" ".join(lines)], pa.string())                # one long text takes no more
    assert _peak(word_hashes, cut) < 14 * size
    assert np.array_equal(word_hashes(cut)[0], word_hashes(texts)[0])


def test_words_longer_than_a_piece():
    texts = ["a " + "b" * 700_000 + " c", None, "c " * 300_000]
    h = word_hashes(pa.array(texts, pa.string()))[0]
    alone = [word_hashes(pa.array([w], pa.string()))[0][0] for w in ("a", "b" * 700_000, "c")]
    assert h.tolist() == [*alone, *[alone[2]] * 300_000]
