import tracemalloc
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from baflow.llm import packing
from tests.llm.helpers import odd_documents

tokenizers = pytest.importorskip("tokenizers")
P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tok():
    return tokenizers.Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(P.path("word_bpe_49k.json"), limit=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abE .,;:!'\n\t-09éß́İΣ中<|>\u00a0_"), max_size=30), max_size=4))
def test_words_give_the_ids_of_whole_texts(tok, encoder, texts):
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in encoder.encode(texts)] == want


def test_special_token_texts(tok, encoder):
    for t in ("a <|endoftext|> b", "<|startoftext|>x.", "it's we'll. 'd, d's"):
        assert encoder.encode([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_round_trip(spark, tok):
    docs = odd_documents(spark).repartition(4)
    rows = packing.pack(docs, seq_len=64).collect()
    byid = {}
    for r in rows:
        byid.setdefault(r["doc_id"], []).append(r)
    for d in {(r["doc_id"], r["text"]) for r in docs.collect()}:
        ids = np.array(tok.encode(d[1] or "", add_special_tokens=False).ids + [2], "<u4")
        mine = [r for r in byid[d[0]] if r["doc_tokens"] == len(ids)]
        copies = len(mine) and sum(r["length"] for r in mine) // len(ids)
        assert copies == (2 if d[0] == 6 else 1)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in mine)
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(seqs) == list(range(len(seqs)))
    for s, parts in seqs.items():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at == 64 or s == len(seqs) - 1


def test_empty(spark):
    assert packing.pack(odd_documents(spark).where("false")).count() == 0


def test_words_with_marks_share_the_letters_and_the_marks(tok, monkeypatch):
    """Letters with any run of marks behind them are not sent to the tokenizer one by one."""
    enc, calls = packing.WordEncoder(P.path("word_bpe_49k.json")), []
    raw = enc._raw
    monkeypatch.setattr(enc, "_raw", lambda text: calls.append(text) or raw(text))
    words = [a + b for a in "abcdefgh" for b in "abcdefgh"]
    texts = [" ".join(w + m for w in words) for m in ("!!", "$$$", ",%%", "")]
    assert [x.tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) <= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abE.,;:!'$%_-(<|>\n\t 09éß́İΣª中 "), max_size=40), max_size=4))
def test_kept_and_new_words_give_the_ids_of_whole_texts(tok, encoder, texts):
    ids, size = encoder.flat_ids(packing.pa.array([*texts, None], packing.pa.string()))
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert size.tolist() == [*map(len, want), 0] and ids.tolist() == [i for x in want for i in x]


def test_kept_words_take_little_memory():
    """Workers keep the encoder while other stages run in them."""
    enc = packing.WordEncoder(P.path("word_bpe_49k.json"))
    letters = np.random.default_rng(1).integers(97, 123, (60_000, 9), dtype="u1")
    words = [bytes(w).decode() for w in letters]
    enc.encode(words[:10])
    tracemalloc.start()
    before = packing.pa.total_allocated_bytes()
    for k in range(10, len(words), 5000):
        enc.encode([" ".join(words[k:k + 5000])])
    held = tracemalloc.get_traced_memory()[0] + packing.pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert held < 80 * len(words)
