"""Benchmark decontamination: edit-tolerant search for benchmark items inside documents.

CGK embedding: a random walk copies a string into a longer one and steps on by a random bit that depends on the
step and the character, so strings at small edit distance fall into step again and end at small Hamming
distance. Bit sampling on the embeddings gives locality-sensitive keys: ``WALKS`` embeddings with ``TABLES`` keys of
``BITS`` sampled places each. A document is looked at through windows of an item's size: their keys retrieve
items from the tables, and a retrieved item is verified by its exact edit distance to the best substring
around the window (at most ``EDITS`` of its length).

Windows start where an item could lie: runs of bytes that occur in some item vote for the start that they imply, and a
start needs the share ``SHARE`` of the item's runs (two at least, where it has two) within ``NEAR`` bytes and a sixteenth of its size. One
rule holds for all items and scripts: runs have 8 bytes, for items of less than 96 bytes fewer (``GRAMS``), so that enough of them outlive
edits up to ``EDITS``. Inserted words move the implied start, the more the longer an item is, so items are indexed by parts of about ``PART``
characters, each with votes and keys of its own; a part that is retrieved has the whole item verified. This places the windows;
what is reported is what tables and verification find. Recall at rates up to ``EDITS`` is measured in the tests.

Comparison is on lower-cased text with single blanks. The index of the items (sorted arrays: one entry per run of bytes and
one per table and part) is sent to all tasks in slices of about ``INDEX_BYTES``; more slices mean more passes, never fewer items. Null or empty items match
nothing; an item of a single word needs that word as it is or by edits. Null and empty documents have no leak.
Repeated rows, null ids, and extra columns change nothing; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import map_texts
from baflow.llm.words import mix

EDITS = 0.2
WALKS, TABLES, BITS = 8, 12, 3
GRAMS = ((96, 8), (48, 6), (16, 4), (0, 3))      # (least bytes of an item or part, bytes of a run)
SHARE, NEAR = 1 / 10, 12
GRAM_SLICE = 2_000_000
PART = 256
INDEX_BYTES = 128_000_000
RUN_COST, KEY_COST = 20, 12                      # bytes of an index entry for a run, for a table
_BLANK = re.compile(r"[\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal_words(text: str) -> list[str]:
    return [w for w in _BLANK.split(text.translate(_LOWER)) if w]


def infix_distance(item: str, text: str, most: int) -> tuple[int, int]:
    """Least edit distance of ``item`` to a substring of ``text`` and where that ends; (most + 1, -1) if above.

    The column of differences of the dynamic programme is held in the bits of two integers.
    """
    m = len(item)
    where: dict[str, int] = {}
    for k, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now, best, end = full, 0, m, most + 1, -1
    for k, c in enumerate(text):
        eq = where.get(c, 0)
        d0 = ((((eq & up) + up) ^ up) | eq | down) & full
        hp, hn = down | (full & ~(d0 | up)), d0 & up
        now += bool(hp & top) - bool(hn & top)
        hp, hn = (hp << 1) & full, (hn << 1) & full
        up, down = hn | (full & ~(d0 | hp)), d0 & hp
        if now < best:
            best, end = now, k + 1
    return best, end


def _triples(text: str) -> np.ndarray:
    """Every three neighbouring characters as one number."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    return c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]


def near_enough(item: np.ndarray, text: np.ndarray, most: int) -> bool:
    """False where too few triples of the item occur in the text: each of ``most`` edits can spoil three of them."""
    least = len(item) - 3 * most
    return least <= 0 or int(np.isin(item, text).sum()) >= least


class Walks:
    """Random walks and sampled places, the same on every worker."""

    def __init__(self, longest: int, seed: int = 99):
        rng = np.random.default_rng(seed)
        self.step = rng.integers(0, 2, (WALKS, 2 * longest + 2, 256), dtype="u1")
        self.place = rng.random((WALKS, TABLES * BITS))
        self.code = rng.integers(1, 1 << 62, (TABLES * BITS, 256), dtype="u8")

    def keys(self, strings: list[str], size: np.ndarray) -> np.ndarray:
        """Key of every string in every table: strings x (WALKS * TABLES); ``size`` scales the sampled places."""
        n = max(map(len, strings), default=0)
        x = np.zeros((len(strings), n + 1), "u1")
        for k, s in enumerate(strings):
            cp = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4")
            x[k, :len(s)] = 1 + cp % 255
        rows = np.arange(len(strings))
        flat, base = x.ravel(), rows * (n + 1)
        out = np.empty((len(strings), WALKS * TABLES), "u8")
        for w in range(WALKS):
            at = (self.place[w][None, :] * (2 * size[:, None])).astype("i8")
            i = np.zeros(len(strings), "i8")
            walk = np.zeros((int(at.max(initial=0)) + 1, len(strings)), "u1")
            for j in range(len(walk)):
                walk[j] = c = flat[base + np.minimum(i, n)]
                i += self.step[w, j][c]
            seen = self.code[np.arange(TABLES * BITS), walk[at, rows[:, None]]]
            with np.errstate(over="ignore"):
                out[:, w * TABLES:(w + 1) * TABLES] = mix(
                    seen.reshape(len(strings), TABLES, BITS).sum(axis=2, dtype="u8")
                    + size[:, None].astype("u8") * np.uint64(0x9E3779B97F4A7C15)
                    + (np.arange(TABLES, dtype="u8") + np.uint64(w * TABLES))[None, :])
        return out


_LOWER_BYTE = np.arange(256, dtype="u1")
_LOWER_BYTE[65:91] += 32
_LOWER_BYTE[9:14] = 32
_END = 255                                       # stands between texts; no byte of UTF-8


def _runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Eight bytes from every place of the normal texts on, and the places of the ends of texts.

    Texts are lower-cased, blanks single, one blank on either side; runs over the end of a text hold the end mark.
    """
    data = _LOWER_BYTE[np.frombuffer(b" " + b" \xff ".join(texts) + b" \xff", "u1")]
    blank = data == 32
    data = data[~np.r_[False, blank[1:] & blank[:-1]]]
    n = len(data)
    wide = np.r_[data, np.full(15, _END, "u1")]
    run = np.empty((n + 7) // 8 * 8, "<u8")
    for k in range(8):
        run[k::8] = wide[k:k + len(run)].view("<u8")
    return run[:n], np.flatnonzero(data == _END)


def _gate(key: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype("i8")


@dataclass
class Seeds:
    """Runs of one length in order of their bytes."""

    size: int
    key: np.ndarray
    item: np.ndarray
    place: np.ndarray
    same: np.ndarray             # how many entries have the same bytes
    gate: np.ndarray

    @classmethod
    def of(cls, size: int, texts: list[bytes], item: np.ndarray) -> Seeds:
        """Seeds of ``texts``, which are the items of the numbers ``item``."""
        run, end = _runs(texts)
        at = np.arange(len(run))
        owner = np.searchsorted(end, at)
        at = at[at + size <= end[owner]]
        owner, key = owner[at], cls.cut(run[at], size)
        order = np.argsort(key, kind="stable")
        gate = np.zeros(1 << 22, bool)
        gate[_gate(key)] = True
        place = at - np.r_[0, end[:-1] + 1][owner]
        key = key[order]
        same = (np.searchsorted(key, key, "right") - np.searchsorted(key, key)).astype("i4")
        return cls(size, key, item[owner[order]].astype("i4"), place[order].astype("i4"), same, gate)

    @staticmethod
    def cut(run: np.ndarray, size: int) -> np.ndarray:
        return run & np.uint64((1 << 8 * size) - 1)

    def starts(self, run: np.ndarray, end: np.ndarray, need: np.ndarray, near: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, start) of starts with ``need`` votes within ``near``."""
        key = self.cut(run, self.size)
        some = np.flatnonzero(self.gate[_gate(key)])
        key = key[some]
        lo = np.searchsorted(self.key, key)
        some, lo = (x[self.key[np.minimum(lo, len(self.key) - 1)] == key] for x in (some, lo))
        n = self.same[lo]
        entry = np.repeat(lo - n.cumsum() + n, n) + np.arange(n.sum())
        # places of the starts of all items on one line, texts and items so far apart that no votes of two come near each other
        gap = 4 * (int(self.place.max(initial=0)) + int(near.max(initial=0)) + 1)
        text = np.searchsorted(end, some)
        reach = len(run) + (len(end) + 1) * gap
        line = np.repeat(some + (text + 1) * gap, n) - self.place[entry] + self.item[entry].astype("i8") * reach
        line.sort()
        item = line // reach
        count = np.searchsorted(line, line + near[item], "right") - np.searchsorted(line, line - near[item], "left")
        ok = np.flatnonzero((count >= need[item]) & np.r_[True, line[1:] != line[:-1]][:len(line)])
        item, at = item[ok], line[ok] % reach
        text = np.searchsorted(end + np.arange(1, len(end) + 1) * gap + gap // 2, at)
        start = at - (text + 1) * gap - np.r_[0, end[:-1] + 1][text]
        # of the starts of one stretch of ``near`` bytes the one on which most votes agree
        agree = np.searchsorted(line, line[ok] + 2, "right") - np.searchsorted(line, line[ok] - 2, "left")
        cell = start // near[item]
        best = np.lexsort((start, -agree, cell, item, text))
        text, item, start, cell = (x[best] for x in (text, item, start, cell))
        first = np.r_[True, (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])][:len(text)]
        return list(zip(text[first].tolist(), item[first].tolist(), start[first].tolist(), strict=True))


def _parts(text: str) -> list[tuple[int, str]]:
    """(place, text) of parts of about ``PART`` characters, cut at blanks where there are any."""
    n = max(1, len(text) // PART)
    cuts = [0]
    for k in range(1, n):
        at = k * len(text) // n
        blank = text.rfind(" ", at - PART // 2, at) + 1
        cuts.append(blank or at)
    return [(lo, text[lo:hi].rstrip(" ")) for lo, hi in zip(cuts, [*cuts[1:], len(text)], strict=True)]


@dataclass
class Index:
    """Items of one slice: their parts (id, text, item and place in it), seeds by length of run, and tables as sorted keys."""

    ids: list[int]
    texts: list[str]
    whole: list[str]
    item: list[int]
    offset: list[int]
    seeds: list[Seeds]
    need: np.ndarray
    near: np.ndarray
    walks: Walks
    key: np.ndarray
    part: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> Index:
        whole = [" ".join(normal_words(t)) for t in texts]
        parts = [(k, at, t) for k, text in enumerate(whole) for at, t in _parts(text)]
        owner, offset, texts = ([x[c] for x in parts] for c in range(3))
        ids = [ids[k] for k in owner]
        raw = [t.encode("utf-8", "replace") for t in texts]
        size = np.array([len(t) for t in raw], "i8")
        near = NEAR + size // 16
        need = np.ones(len(raw), "i8")
        seeds, above = [], np.inf
        for least, n in GRAMS:
            at = np.flatnonzero((size >= max(1, least)) & (size < above))
            above = least
            if len(at):
                seeds.append(Seeds.of(n, [raw[k] for k in at], at))
                votes = np.bincount(seeds[-1].item, minlength=len(raw))[at]
                need[at] = np.minimum(votes, np.maximum(2, votes * SHARE)) if least else 1
        walks = Walks(max(map(len, texts), default=1))
        keys = [walks.keys(texts[k:k + 2000], np.array([len(t) for t in texts[k:k + 2000]], "i8")) for k in range(0, len(texts), 2000)]
        key = np.concatenate(keys).ravel() if keys else np.empty(0, "u8")
        order = np.argsort(key, kind="stable")
        return cls(ids, texts, whole, owner, offset, seeds, need, near, walks, key[order], (order // (WALKS * TABLES)).astype("i4"))

    def windows(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(text, item, first byte) of every start with enough votes."""
        out, lo = [], 0
        raw = texts.cast(pa.binary()).fill_null(b"")
        size = np.diff(np.frombuffer(raw.buffers()[1], "<i4")[raw.offset:raw.offset + len(raw) + 1]).cumsum() if len(raw) else []
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + GRAM_SLICE, "right")))
            run, end = _runs(raw[lo:hi].to_pylist())
            for seeds in self.seeds:
                out += [(lo + d, i, s) for d, i, s in seeds.starts(run, end, self.need, self.near)]
            lo = hi
        return sorted(out)

    def retrieved(self, strings: list[str], size: np.ndarray) -> list[tuple[int, int]]:
        """(string, part) of every part that shares a key with a string."""
        key = self.walks.keys(strings, size)
        lo, hi = (np.searchsorted(self.key, key.ravel(), side) for side in ("left", "right"))
        n = hi - lo
        entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(n.cumsum() - n, n)
        pair = np.unique(np.repeat(np.arange(len(n)) // key.shape[1], n) * len(self.texts) + self.part[entry])
        return list(zip((pair // len(self.texts)).tolist(), (pair % len(self.texts)).tolist(), strict=True))

    def leaks(self, texts: pa.Array, edits: float) -> list[list[tuple[int, int, int]]]:
        """Per text (item id, edit distance, item length) of every item found in it."""
        found: list[dict] = [{} for _ in range(len(texts))]
        near = self.windows(texts)
        for lo in range(0, len(near), 2000):
            windows = [x for x in near[lo:lo + 2000] if self.ids[x[1]] not in found[x[0]]]
            strings, spans = [], []
            cache: dict[int, tuple[str, np.ndarray | None]] = {}
            tried: set[tuple[int, int, int, int]] = set()
            triples: dict[int, np.ndarray] = {}
            for d, i, s in windows:
                if d not in cache:
                    text = " ".join(normal_words(texts[d].as_py()))
                    lead = None if text.isascii() else (np.frombuffer(text.encode(), "u1") & 0xC0) != 0x80
                    cache[d] = text, None if lead is None else np.r_[0, lead.cumsum()]
                text, place = cache[d]
                a = max(s, 0) if place is None else int(place[min(max(s, 0), len(place) - 1)])
                a = min(a, len(text))
                strings.append(text[a:a + len(self.texts[i])])
                spans.append((d, a))
            if not windows:
                continue
            for w, k in self.retrieved(strings, np.array([len(self.texts[i]) for _, i, _ in windows], "i8")):
                d, a = spans[w]
                item = self.whole[self.item[k]]
                if self.ids[k] in found[d] or not item:
                    continue
                most = int(edits * len(item))
                slack = most + int(self.near[k])
                # windows of one copy share a span: it is looked at once
                start = (a - self.offset[k] - slack) // slack * slack
                stop = -(-(a - self.offset[k] + len(item) + slack) // slack) * slack
                span = (d, self.item[k], max(0, start), max(0, stop))
                if span in tried:
                    continue
                tried.add(span)
                near_text = cache[d][0][span[2]:span[3]]
                if self.item[k] not in triples:
                    triples[self.item[k]] = _triples(item)
                if not near_enough(triples[self.item[k]], _triples(near_text), most):
                    continue
                dist, _ = infix_distance(item, near_text, most)
                if dist <= most:
                    found[d][self.ids[k]] = (self.ids[k], dist, len(item))
        return [sorted(f.values()) for f in found]


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), edits: float = EDITS,
               index_bytes: int = INDEX_BYTES, into: str = "leaks") -> DataFrame:
    """``keep`` columns of every row and column ``into``: (item_id, distance, length) of each item found in it."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id is not null and trim(text) <> ''").distinct()
    cost = F.octet_length("text") * RUN_COST + (1 + F.length("text") / PART) * (WALKS * TABLES * KEY_COST)
    slices = max(1, math.ceil((items.agg(F.sum(cost)).first()[0] or 0) / index_bytes))
    out = docs.select(*(c for c in keep if c != "text"), F.col("text").cast("string").alias("text"), F.array().cast(
        "array<struct<item_id:bigint,distance:int,length:int>>").alias(into))
    for k in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text").collect()
        if not rows:
            continue
        index = spark.sparkContext.broadcast(Index.of([r["item_id"] for r in rows], [r["text"] for r in rows]))

        def run(b, index=index):
            got = index.value.leaks(b.column("text"), edits)
            return {"__more": [[{"item_id": i, "distance": d, "length": n} for i, d, n in x] for x in got]}

        carried = (*keep, *(c for c in ("text",) if c not in keep), into) if slices > 1 else keep
        told = map_texts(out, run, "__more array<struct<item_id:bigint,distance:int,length:int>>", carried, 4_000_000)
        out = told.withColumn(into, F.concat(into, "__more") if slices > 1 else F.col("__more")).drop("__more")
    return out.select(*keep, into)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a leak; columns stay as they are."""
    found = find_leaks(docs, benchmark, tuple(docs.columns), into="__leaks")
    return found.where(F.size("__leaks") == 0).select(*docs.columns)
