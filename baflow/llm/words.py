"""Hashes of words and word shingles of whole texts, computed on Arrow batches without Python loops over words.

Words are runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's hash is a sum of
random 64-bit numbers, one for each pair of byte and place in the word, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 500_000
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype="u8") | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 1 << 14, dtype="u8") | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_BYTE[_SPACE] = 0
_COMBINE = _RNG.integers(1, 1 << 63, 16, dtype="u8") | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, first word of every text and one past the last, byte where each word starts).

    Null counts as the empty text; byte places count from the start of the first text.
    """
    a = texts.cast(pa.binary()).fill_null(b"")
    off = np.frombuffer(a.buffers()[1], dtype="<i4")[a.offset:a.offset + len(a) + 1].astype("i8")
    raw = a.buffers()[2]
    data = np.frombuffer(raw, dtype="u1")[off[0]:off[-1]] if raw is not None else np.zeros(0, "u1")
    off = off - off[0]
    if len(data) == 0:
        return np.zeros(0, "u8"), np.zeros(len(off), "i8"), np.zeros(0, "i8")
    space = _SPACE[data]
    before = np.empty(len(data), dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    before[off[:-1][off[:-1] < len(data)]] = True
    starts = np.flatnonzero(~space & before)
    if len(starts) == 0:
        return np.zeros(0, "u8"), np.zeros(len(off), "i8"), np.zeros(0, "i8")
    until = np.append(starts, len(data))
    h = np.empty(len(starts), "u8")
    at = 0
    while at < len(starts):          # PIECE bytes at a time: the products take many times the bytes' room; a long word stays whole
        to = max(at + 1, int(np.searchsorted(until, starts[at] + PIECE, "right")) - 1)
        lo, hi = until[at], until[to]
        place = np.arange(lo, hi)
        place -= np.repeat(starts[at:to], np.diff(until[at:to + 1]))
        place &= len(_PLACE) - 1
        product = _PLACE[place]
        product *= _BYTE[data[lo:hi]]
        h[at:to] = np.add.reduceat(product, starts[at:to] - lo)
        at = to
    return mix(h), np.searchsorted(starts, off), starts


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """For every text its sorted distinct hashes of ``n`` words in a row; a shorter text is one shingle."""
    h, first, _ = word_hashes(texts)
    with np.errstate(over="ignore"):
        full = np.zeros(max(0, len(h) - n + 1), "u8")
        for k in range(n):
            full += h[k:len(h) - n + 1 + k] * _COMBINE[k] if len(full) else full
        full = mix(full)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= n:
                out.append(np.unique(full[a:b - n + 1]))
            elif b > a:
                short = (h[a:b] * _COMBINE[8:8 + b - a]).sum(dtype="u8") + np.uint64(b - a)
                out.append(mix(np.array([short], "u8")))
            else:
                out.append(np.zeros(0, "u8"))
    return out
