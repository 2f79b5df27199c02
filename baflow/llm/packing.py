"""Concatenate-and-cut packing of tokenised documents into fixed-length sequences.

Pass one tokenises every document once and writes its ids with the running offset inside its partition.
Prefix sums over the partitions' token totals turn these into offsets in the one long concatenation.
Pass two cuts each document where a window of ``seq_len`` tokens ends; a document that crosses a window's
boundary gives one record per window. Only the last sequence can be short.

Null text counts as empty (one end id). Repeated rows and null ids are packed like any other row. An
empty table gives an empty result. A very long text is one row of ids and gives many pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baflow.llm.common import save, slices

SEQ_LEN = 4096
END_ID = 2
CACHE_WORDS = 700_000
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<|>")    # end a word, and make one piece in a row
SLICE = 2_000_000
_ENCODERS: dict[str, WordEncoder] = {}


def _runs(flat: np.ndarray, start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, lengths) of the runs ``which`` one behind the other; run k is flat[start[k]:start[k + 1]]."""
    size = np.diff(start)[which]
    at = np.arange(int(size.sum()))
    at += np.repeat(start[which] - (size.cumsum() - size), size)
    return flat[at], size


def _plain(word: str) -> bool:
    return word.isalpha() and word.lower().isalpha()


class WordEncoder:
    """Ids of whole texts by a tokenizer whose pieces never cross white space, each different word once.

    The tokenizer's normaliser and its splitting pattern treat every run of non-space characters on
    its own, so the ids of a text are those of its words in order. Words seen are kept (``limit``) as Arrow
    strings, their ids in one array: run k of ``flat`` is that of word k, and word 0 is empty.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.kind = np.dtype("<u2") if max(vocab.values()) < 65536 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for s, i in vocab.items() if s.endswith("</w>")]] = True
        self.limit = limit
        self.known = pa.array([""], pa.string())
        self.flat, self.start = np.zeros(0, self.kind), np.zeros(2, "i8")

    def _raw(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=self.kind)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one behind the other, lengths); letter-only words go many at a time: each ends with one end-of-word piece."""
        ids, size = [np.zeros(0, self.kind)], [np.zeros(0, "i8")]
        for k in range(0, len(words), 2000):
            part = words[k:k + 2000]
            got = self._raw(" ".join(part))
            cut = np.flatnonzero(self.ends[got]) + 1
            if len(cut) == len(part):
                ids.append(got)
                size.append(np.diff(cut, prepend=0))
            else:
                each = [self._raw(w) for w in part]
                ids += each
                size.append(np.array([len(x) for x in each], "i8"))
        return np.concatenate(ids), np.concatenate(size)

    def _units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, start, run of each unit): the ids of different ``units``, kept as far as the limit goes."""
        place = pc.fill_null(pc.index_in(units, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype("i8")
        new = np.flatnonzero(place < 0)
        words = units.take(pa.array(new)).to_pylist()
        plain = np.fromiter(map(_plain, words), bool, len(words))
        new = np.concatenate([new[plain], new[~plain]])
        ids, size = self._learn([w for w, ok in zip(words, plain.tolist(), strict=True) if ok])
        other = [self._raw(w) for w, ok in zip(words, plain.tolist(), strict=True) if not ok]
        size = np.concatenate([size, np.array([len(x) for x in other], "i8")])
        flat = np.concatenate([self.flat, ids, *other])
        start = np.concatenate([self.start, self.start[-1] + size.cumsum()])
        place[new] = len(self.known) + np.arange(len(new))
        room = max(0, self.limit - len(self.known))
        if room and len(new):
            self.known = pa.concat_arrays([self.known, units.take(pa.array(new[:room]))])
            self.start = start[:len(self.known) + 1]
            self.flat = flat[:self.start[-1]]
        return flat, start, place

    def flat_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, number of ids of each text)."""
        split = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        first = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype("i8").cumsum()
        coded = pc.list_flatten(split).dictionary_encode()
        words = coded.dictionary
        # letters with marks behind them are the letters' ids and those of the run of marks; other words stay whole
        head = pc.utf8_rtrim(words, characters=MARKS)
        at = np.flatnonzero(pc.not_equal(head, words).to_numpy(zero_copy_only=False))
        found = zip(words.take(pa.array(at)).to_pylist(), head.take(pa.array(at)).to_pylist(), strict=True)
        tails = [w[len(h):] if _plain(h) else "" for w, h in found]
        cut = np.zeros(len(words), bool)
        cut[at] = np.fromiter(map(bool, tails), bool, len(tails))
        units = pa.concat_arrays([pc.if_else(pa.array(cut), head, words), pa.array(tails, pa.string())]).dictionary_encode()
        flat, start, place = self._units(units.dictionary)
        place = place[units.indices.to_numpy()]
        both = np.zeros((len(words), 2), "i8")
        both[:, 0], both[at, 1] = place[:len(words)], place[len(words):]
        flat, size = _runs(flat, start, both.ravel())
        start = np.concatenate([[0], size.reshape(-1, 2).sum(axis=1).cumsum()])
        ids, size = _runs(flat, start, coded.indices.to_numpy())
        until = np.concatenate([[0], size.cumsum()])[first]
        return ids, np.diff(until, prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, size = self.flat_ids(pa.array(texts, pa.string()))
        return np.split(ids, size.cumsum()[:-1]) if texts else []


def _encoder(tokenizer: str) -> WordEncoder:
    """One encoder per Python worker; ``tokenizer`` names a file of the tokenizers package or a path."""
    if tokenizer not in _ENCODERS:
        import os
        path = tokenizer
        if os.sep not in tokenizer:
            import public_tokenizers
            path = public_tokenizers.path(tokenizer)
        _ENCODERS[tokenizer] = WordEncoder(path)
    return _ENCODERS[tokenizer]


def tokenize(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = END_ID) -> DataFrame:
    """(part, start_in_part, doc_id, doc_tokens, wide, ids): one row per row of ``docs``, its ids as bytes."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", SLICE):
            flat, size = enc.flat_ids(b.column("text"))
            n = size + 1
            until = n.cumsum()
            ids = np.full(int(until[-1]), end_id, dtype=enc.kind)
            inner = np.ones(len(ids), bool)
            inner[until - 1] = False
            ids[inner] = flat
            off = np.concatenate([[0], until]) * enc.kind.itemsize
            whole = pa.Array.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(off), pa.py_buffer(ids)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), part, "i4")), pa.array(at + until - n), b.column("doc_id"), pa.array(n),
                 pa.array(np.full(len(n), enc.kind.itemsize, "i4")), whole],
                names=["part", "start_in_part", "doc_id", "doc_tokens", "wide", "ids"])
            at += int(n.sum())

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        encode, f"part int, start_in_part long, doc_id {kind}, doc_tokens long, wide int, ids binary")


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", seq_len: int = SEQ_LEN,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of every document: where each lies in its document and in its sequence.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    """
    ids = save(tokenize(docs, tokenizer, end_id), "ids")
    # one row per partition of pass one, so this window holds as many rows as there were tasks
    totals = ids.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # two numbers per task of pass one: small however large the input, so the ids need not be shuffled
    placed = ids.join(F.broadcast(firsts), "part").select(
        "doc_id", "doc_tokens", "wide", "ids", (F.col("first") + F.col("start_in_part")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for b in slices(batches, "ids", 16_000_000):
            row, pieces = [], []
            for k, (n, wide, raw, at) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                    "doc_tokens", "wide", "ids", "at")), strict=True)):
                x = np.frombuffer(raw, dtype=f"<u{wide}").astype("<u4")
                lo = 0
                while lo < n:
                    seq, off = divmod(at + lo, seq_len)
                    hi = min(n, lo + seq_len - off)
                    row.append(k)
                    pieces.append((lo, hi - lo, zlib.crc32(x[lo:hi]), n, seq, off))
                    lo = hi
            cols = np.array(pieces, dtype="i8").reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row, pa.int64())),
                                              *(pa.array(c) for c in cols.T.copy())], names=["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
                                  "sequence_id long, offset long")
