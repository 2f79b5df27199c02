"""Importance resampling towards a target distribution by bit-sliced aggregation.

Features are all runs of 1 to ``longest`` words in a row; a feature's bucket is the crc32 of its bytes modulo ``BUCKETS``. The
corpus and the target are counted by bucket over all their rows; each bucket has an integer gain, the rounded logarithm of
how much commoner it is in the target. A document's weight is the floored mean of the gains of its features. It is summed without
looking up features one by one: the document's bucket counts become bit planes of ``BUCKETS`` bits (plane i holds bit i of
each count), the gains become signed bit planes, and

    sum of count * gain  =  sum over i, j of 2**(i+j) * (popcount(count_i & plus_j) - popcount(count_i & minus_j)).

Planes are kept as 64-bit words, and words without a bit are left out. Sums are exact in 64-bit integers.
A repeatable Gumbel number from the id is added to the weight, so that the highest scores are a draw without replacement.
Of the documents with at least ``LEAST_WORDS`` words the first tenth (``SHARE``) by score is drawn, ties to the smaller id, null ids last.

Words are runs of letters and digits of ASCII (A-Z count as a-z) and of all bytes from 0x80. A null text or one without words has no
features and weight 0. A null id counts as the empty text in the Gumbel number. Repeated rows are scored and drawn each for itself (the same weight and
score, ranks one after the other). Empty documents give an empty result; an empty target or corpus gives gains from the added ones alone.
Other columns are not read. One text is read in pieces of ``PIECE`` bytes, so its length does not bound memory use beyond six bytes a word.

Plan: two scans of the texts in Arrow batches. The first puts out at most ``BUCKETS`` counts a task; the ``BUCKETS`` sums are collected
and the gains broadcast (a fixed size). The second writes a table of one slim row a document. The cut score comes from a count by score (weights
and Gumbel numbers are integers of a few ten thousands, whatever the input); only rows at or above it are ranked, by range partitions.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import map_texts, save, slices
from baflow.operators.chunks import ranked

BUCKETS = 10_000
SHARE = (10, 100)
LEAST_WORDS = 20
SEED = 2024
PIECE = 4_000_000
SHORT = 64             # bytes of a word whose crc32 comes from tables

_LOWER = np.arange(256, dtype="u1")
_LOWER[0x41:0x5B] += 0x20
_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
# crc32 is linear: a byte k places before the end of a word adds _PART[k, byte] to what the word's length alone gives
_BLANK = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 1)], dtype="u4")
_PART = np.array([[zlib.crc32(bytes([b]) + bytes(k)) for b in range(256)] for k in range(SHORT)], dtype="u4") ^ _BLANK[1:, None]


def _pieces(data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of pieces of about ``size`` bytes that end behind a byte outside words."""
    start = 0
    while start < len(data):
        end = min(len(data), start + size)
        while end < len(data) and _IN_WORD[data[end - 1]]:
            more = np.flatnonzero(~_IN_WORD[data[end:end + size]])
            end = end + int(more[0]) + 1 if len(more) else min(len(data), end + size)
        yield start, end
        start = end


def _words(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the words of ``data``; a word does not cross ``cuts``."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = _IN_WORD[data]
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    first[cuts] |= inside[1:-1][cuts]
    last[cuts - 1] |= inside[1:-1][cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def _crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of the lower-cased words."""
    size = (end - start).astype("i4")
    short = np.minimum(size, SHORT)
    seg = np.r_[0, np.cumsum(short)][:-1]
    # the last SHORT bytes of each word
    back = np.repeat((seg + short - 1).astype("i4"), short) - np.arange(short.sum(), dtype="i4")
    low = _LOWER[data[np.repeat(end - 1, short) - back]]
    crc = np.bitwise_xor.reduceat(_PART[back, low], seg) ^ _BLANK[short]
    for k in np.flatnonzero(size > SHORT):
        crc[k] = zlib.crc32(_LOWER[data[start[k]:end[k]]].tobytes())
    return crc


def features(texts: pa.Array, longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket) of every feature, and the number of words of every text."""
    a = texts.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(a.buffers()[1], dtype="<i8")[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype="u1")[off[0]:off[-1]] if raw is not None else np.zeros(0, "u1")
    off = off - off[0]
    words = np.zeros(len(a), dtype="i8")
    owners, found = [np.zeros(0, "i4")], [np.zeros(0, "i4")]
    carried: list[list] = []                                 # words of the text that the last piece ended in
    for lo, hi in _pieces(data, PIECE):
        cuts = off[(off > lo) & (off < hi)] - lo
        start, end = _words(data[lo:hi], cuts)
        if not len(start):
            continue
        owner = np.searchsorted(off, start + lo, "right").astype("i4") - 1
        words += np.bincount(owner, minlength=len(a))
        crc = _crcs(data[lo:hi], start, end)
        owners.append(owner)
        found.append((crc % np.uint32(buckets)).astype("i4"))
        if longest > 1:                                      # chains of crc32 over the words before
            for k, o in enumerate(owner.tolist()):
                word = _LOWER[data[lo + start[k]:lo + end[k]]].tobytes()
                carried = [c for c in carried if c[0] == o and c[2] < longest]
                more = [[o, zlib.crc32(b" " + word, c[1]), c[2] + 1] for c in carried]
                owners.append(np.full(len(more), o, "i4"))
                found.append(np.array([c[1] % buckets for c in more], "i4"))
                carried = [*more, [o, int(crc[k]), 1]]
    return np.concatenate(owners), np.concatenate(found), words


def counts(texts: DataFrame, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket over all rows of ``texts`` (text)."""

    def run(batches):
        total = np.zeros(buckets, dtype="i8")
        for b in slices(batches, "text", PIECE):
            total += np.bincount(features(b.column("text"), longest, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype("i4")), pa.array(total[some])], names=["bucket", "n"])

    told = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(buckets, dtype="i8")
    for r in told.groupBy("bucket").agg(F.sum("n").alias("n")).collect():      # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The integer gain of every bucket: a thousandth's floor of the log ratio of the smoothed shares."""
    of_corpus, of_target = (float(x.sum() + len(x)) for x in (corpus, target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * of_corpus / ((s + 1.0) * of_target)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype="i8")


class GainPlanes:
    """The gains as bit planes of 64-bit words: ``plus[j]`` and ``minus[j]`` hold bit j of the positive and negative ones."""

    def __init__(self, gain: np.ndarray):
        wide = np.zeros(-(-len(gain) // 64) * 64, dtype="i8")
        wide[:len(gain)] = gain
        self.bits = int(np.abs(wide).max()).bit_length()
        self.plus, self.minus = (self._planes(np.maximum(sign * wide, 0)) for sign in (1, -1))

    def _planes(self, size: np.ndarray) -> np.ndarray:
        return np.stack([np.packbits((size >> j & 1).astype(bool), bitorder="little").view("<u8")
                         for j in range(max(1, self.bits))])

    def sums(self, owner: np.ndarray, bucket: np.ndarray, texts: int) -> np.ndarray:
        """For each of ``texts`` documents the sum of the gains of its features."""
        out = np.zeros(texts, dtype="i8")
        if not len(owner):
            return out
        width = self.plus.shape[1] * 64
        key, count = np.unique(owner.astype("i8") * width + bucket, return_counts=True)
        word = key >> 6                                       # document and 64-bit word
        head = np.flatnonzero(np.r_[True, np.diff(word) != 0])
        bit = np.uint64(1) << (key & 63).astype("u8")
        total = np.zeros(len(head), dtype="i8")
        for i in range(int(count.max()).bit_length()):
            plane = np.bitwise_or.reduceat(np.where(count >> i & 1, bit, np.uint64(0)), head)
            live = np.flatnonzero(plane)
            plane, place = plane[live], (word[head[live]] % (width // 64)).astype("i4")
            for j in range(self.bits):
                ones = np.bitwise_count(plane & self.plus[j][place]).astype("i8") - np.bitwise_count(plane & self.minus[j][place])
                total[live] += ones << (i + j)
        np.add.at(out, word[head] // (width // 64), total)
        return out


def scored(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` (doc_id among them) with n_words, n_features, weight and score of every document."""
    planes = docs.sparkSession.sparkContext.broadcast(GainPlanes(gain))
    buckets = len(gain)

    def run(batch):
        owner, bucket, words = features(batch.column("text"), longest, buckets)
        n = np.bincount(owner, minlength=batch.num_rows)
        return {"n_words": words, "n_features": n, "weight": planes.value.sums(owner, bucket, batch.num_rows) // np.maximum(n, 1)}

    told = map_texts(docs, run, "n_words long, n_features long, weight long", keep, PIECE)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    gumbel = F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return told.withColumn("score", (F.col("weight") + gumbel).cast("long"))


def draw(table: DataFrame, share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``table`` (a saved result of ``scored``) with ``rank``: 1, 2, ... in the order of the draw, null if not drawn."""
    able = F.col("n_words") >= least_words
    steps = sorted(((r["score"], r["n"]) for r in table.where(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    want, got, cut = share[0] * sum(n for _, n in steps) // share[1], 0, None
    for score, n in steps:
        if got >= want:
            break
        got, cut = got + n, score
    near = able & (F.col("score") >= cut) if cut is not None else F.lit(False)
    placed = ranked(table.where(near), [], [F.desc("score"), F.asc_nulls_last("doc_id")], "rank", None)
    rest = table.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", F.when(F.col("rank") <= want, F.col("rank")).cast("long")).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED,
             share: tuple[int, int] = SHARE, least_words: int = LEAST_WORDS, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with n_words, n_features, weight, score and rank towards ``target`` (text).

    ``keep`` names the columns of ``docs`` that the result carries, ``text`` if wanted; none may be called like a new column.
    """
    gain = gains(counts(docs, longest, buckets), counts(target, longest, buckets))
    return draw(save(scored(docs, gain, longest, seed, keep), "scores"), share, least_words)
