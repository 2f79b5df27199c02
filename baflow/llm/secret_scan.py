"""Secret scan: pattern findings, with a random forest that removes the false positives.

Findings come from three generators: keys with a known beginning, values assigned to a name (``token = "..."``), and
long runs of letters and digits. The forest sees the finding's length, shares and changes of character classes,
its likelihood under the corpus's character transitions, how much of it dictionary words cover, the path (the
``path`` column, split at marks) and the words next to it.

Character transitions and the dictionary (the ``MAX_WORDS`` words in most documents) are counted over all documents. The forest learns from all
different labelled findings of all documents, on Spark; the share of secrets on a path is counted in ``PATHS`` buckets of paths' hashes. Labelled findings may be given; without them they are
labelled by rule: known beginnings, and random-looking values of a secret's name, are secrets; plain words,
digits alone, placeholders and repeated characters are not; the rest has no label and is left to the forest.
Each labelled secret's place is also filled with a key of a known beginning (a secret) and with joined words and
digits (no secret).

Null and empty texts have no finding; a null path is an empty path. Without labels of both kinds nothing is
reported. Rows are judged one by one: repeated rows repeat their findings; null ids and extra columns pass.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import hash_share, map_texts, sample_rate, save, slices
from baflow.llm.trees import Forest, forest

MAX_WORDS = 30_000
PATHS = 65_536
LEAST = 0.5
_KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_.-]{10,})"
                    r"(?![A-Za-z0-9])")
_NAME = re.compile(r"([A-Za-z][A-Za-z0-9_-]{1,30})[\"']? ?$")
_ASSIGNS = re.compile(r"[A-Za-z][A-Za-z0-9_-]*[\"']? ?[:=] ?[\"']?$")
_VALUE = re.compile(r" ?[\"']?([^\s\"',;]{6,})")
INNER = 200                                      # a value this long may hold further assignments behind that place
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_SECRET_NAME = re.compile(r"(?i)pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private")
_PLACEHOLDER = re.compile(r"(?i)change|example|sample|dummy|placeholder|your|xxx|test|none|null|true|false|\*\*\*|<|\$\{")
_NEIGHBOURS = ("password", "secret", "token", "key", "auth", "aws", "login", "user", "id", "version", "hash", "commit")
_CLASS = np.zeros(256, "u1")                     # 0 other, 1 lower, 2 upper, 3 digit, 4 mark of encodings
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 1, 2, 3
_CLASS[[43, 47, 61, 95, 45]] = 4
_SYMBOL = np.full(256, 37, "u1")                 # letters without case, digits, blank and all the rest
_SYMBOL[97:123] = _SYMBOL[65:91] = np.arange(26)
_SYMBOL[48:58], _SYMBOL[32] = np.arange(26, 36), 36
SYMBOLS = 38


def findings(text: str) -> list[tuple[str, int, int]]:
    """(generator, start, end) in code points, whole values; findings may overlap."""
    out = []
    if "IA" in text or "gh" in text or "eyJ" in text:
        out += [("known", *m.span()) for m in _KNOWN.finditer(text)]
    done = 0
    for m in re.finditer("[:=]", text):
        if m.start() >= done and _NAME.search(text, max(0, m.start() - 34), m.start()):
            v = _VALUE.match(text, m.end())
            if v and not v.group(1).startswith("//"):
                out.append(("assigned", *v.span(1)))
                done = min(v.end(), v.start(1) + INNER)
    named = sorted(s[1:] for s in out)
    starts = [a for a, _ in named]
    ends = list(itertools.accumulate((b for _, b in named), max))
    for m in _RUN.finditer(text):
        lo, hi = m.span()
        k = bisect.bisect_left(starts, hi)
        if not k or ends[k - 1] <= lo:                             # a named finding stands for the run around it
            out.append(("run", lo, hi))
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def _entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def label(text: str, kind: str, lo: int, hi: int) -> float | None:
    """1 secret, 0 not, None open."""
    s = text[lo:hi]
    if kind == "known":
        return 1.0
    if s.isdigit() or len(set(s)) < 5 or _PLACEHOLDER.search(s):
        return 0.0
    if s.isalpha() and (s.islower() or s[1:].islower()):
        return 0.0
    mixed = any(c.isdigit() for c in s) and any(c.isalpha() for c in s)
    if kind == "assigned" and mixed and _entropy(s) >= 2.8:
        name = _NAME.search(text, max(0, lo - 40), max(0, lo - 1))
        near = text[max(0, lo - 40):lo]
        return 1.0 if _SECRET_NAME.search(name.group(1) if name else near) else None
    return None


def _known_forms(body: str) -> list[str]:
    """Keys with a known beginning, to stand in a labelled secret's place: rare formats are learned too."""
    rng = np.random.default_rng(zlib.crc32(body.encode()))
    upper, both = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    return ["AKIA" + "".join(rng.choice(list(upper), 16)), "ghp_" + "".join(rng.choice(list(both), 36))]


def _plain_forms(head: str, body: str) -> list[str]:
    """Words joined as in paths and names, and digits: what long runs are when they are no secret."""
    words = re.findall(r"[a-z]{2,}", head.lower()) or ["some", "path"]
    return ["/".join(words), "-".join(words), "_".join(words[:3]), str(zlib.crc32(body.encode()))]


def transitions(docs: DataFrame) -> np.ndarray:
    """Log probability of each symbol after each symbol, over the texts of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS * SYMBOLS, "i8")
        for b in slices(batches, "text", 8_000_000):
            a = b.column("text").cast(pa.binary()).drop_null()
            data = _SYMBOL[np.frombuffer(b"\n".join(a.to_pylist()), "u1")]
            total += np.bincount(data[:-1].astype("i4") * SYMBOLS + data[1:], minlength=SYMBOLS * SYMBOLS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "pair long, n long").groupBy(
        "pair").agg(F.sum("n").alias("n")).collect()               # SYMBOLS squared at most
    n = np.full(SYMBOLS * SYMBOLS, 0.5)
    for r in rows:
        n[r["pair"]] += r["n"]
    n = n.reshape(SYMBOLS, SYMBOLS)
    return np.log2(n / n.sum(axis=1, keepdims=True))


@dataclass
class Model:
    logp: np.ndarray
    words: frozenset = frozenset()
    forest: Forest = field(default_factory=lambda: Forest([]))
    paths: dict = field(default_factory=dict)        # by bucket of the path
    usual: float = 0.0               # share of secrets on a path that training has not seen

    def covered(self, s: str) -> float:
        """Share of the letters that dictionary words of 3 to 12 letters cover, longest first from the left."""
        s, at, hit = s.lower(), 0, 0
        while at < len(s):
            n = next((n for n in range(min(12, len(s) - at), 2, -1) if s[at:at + n] in self.words), 0)
            hit, at = hit + n, at + max(n, 1)
        return hit / max(1, len(s))

    def features(self, text: str, path: str, kind: str, lo: int, hi: int) -> list[float]:
        s = text[lo:hi]
        raw = np.frombuffer(s.encode("utf-8", "replace"), "u1")
        c, y = _CLASS[raw], _SYMBOL[raw]
        before, after = text[max(0, lo - 40):lo], text[hi:hi + 20]
        name = re.findall(r"[A-Za-z]+", before.lower())[-2:]
        parts = re.split(r"[^A-Za-z0-9]+", path.lower())
        return [
            float(hi - lo), *(float((c == k).mean()) for k in range(5)), float((c[1:] != c[:-1]).sum()),
            float((c[1:] != c[:-1]).mean()) if len(c) > 1 else 0.0,
            float(self.logp[y[:-1], y[1:]].mean()) if len(y) > 1 else -5.0, _entropy(s), self.covered(s),
            float(before[-1:] in "\"'"), float("=" in before[-4:]), float(":" in before[-4:]), float(after[:1] in "\"'"),
            *(float(any(w in n for n in name)) for w in _NEIGHBOURS), float(before[-1:].isspace() or not before),
            float(any(p in ("test", "tests", "example", "docs") for p in parts)), float(len(parts)),
            float(self.paths.get(zlib.crc32(path.encode("utf-8", "replace")) % PATHS, self.usual))]

    def judge(self, text: str, path: str) -> list[tuple[str, int, int, float]]:
        found = findings(text)
        if not found or not self.forest.trees:
            return []
        p = self.forest.predict(np.array([self.features(text, path, *f) for f in found]))
        return [(*f, float(x)) for f, x in zip(found, p, strict=True)]


def _with_path(docs: DataFrame, path: str | None) -> DataFrame:
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    return docs.select("doc_id", where.alias("path"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, path: str | None = "source", train_docs: int | None = None, labelled: DataFrame | None = None) -> Model:
    """Fit the forest on findings of all rows; ``labelled`` (path, text, kind, start, end, label) replaces the rule labels when given.

    The dictionary is counted over all rows too, unless a caller bounds its documents with ``train_docs`` (drawn by a hash of the text).
    """
    rows = _with_path(docs, path).where("text is not null")
    model = Model(transitions(rows))
    counted = rows if train_docs is None else rows.where(hash_share(sample_rate(rows.count(), train_docs), "text"))
    words = counted.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\b([a-z]{3,12})\b")))).alias("w"))
    # saved first: what each task puts forward meets in a task, not in the driver
    top = save(words.groupBy("w").count().where("count > 2").orderBy(F.desc("count"), "w").limit(MAX_WORDS).select("w"), "words")
    model.words = frozenset(r["w"] for r in top.collect())

    def own(b):
        out = []
        for t in b.column("text").to_pylist():
            marked = [(f, label(t, *f)) for f in findings(t)]
            out.append([{"kind": k, "head": t[max(0, lo - 60):lo], "body": t[lo:hi], "tail": t[hi:hi + 30], "label": y}
                        for (k, lo, hi), y in marked if y is not None])
            out[-1] += [{**f, "kind": "known", "head": head, "body": other} for f in out[-1] if f["label"] == 1
                        for head in (f["head"], _ASSIGNS.sub("", f["head"])) for other in _known_forms(f["body"])] + [
                        {**f, "body": other, "label": 0.0} for f in out[-1] if f["label"] == 1
                        for other in _plain_forms(f["head"], f["body"])]
        return {"found": out}

    if labelled is None:
        kind = "found array<struct<kind:string,head:string,body:string,tail:string,label:double>>"
        got = map_texts(rows, own, kind, ("path",)).select("path", F.explode("found").alias("f")).select("path", "f.*")
    else:
        got = labelled.select("path", "kind", F.expr("substring(text, greatest(start - 59, 1), least(start, 60))").alias("head"),
                              F.expr("substring(text, start + 1, end - start)").alias("body"),
                              F.expr("substring(text, end + 1, 30)").alias("tail"), F.col("label").cast("double").alias("label"))
    # copies count once, so that a group of them does not outweigh the rest
    got = save(got.distinct(), "findings")
    told = F.col("label")
    n, model.usual = got.agg(F.count(told), F.coalesce(F.avg(told), F.lit(0.0))).first()
    if not n or not 0 < model.usual < 1:
        return model
    bucket = F.crc32(F.coalesce("path", F.lit("")).cast("binary")) % PATHS
    model.paths = {r["k"]: (r["secret"] + 20 * model.usual) / (r["n"] + 20) for r in got.groupBy(bucket.cast("int").alias("k")).agg(
        F.count(told).alias("n"), F.sum(told).alias("secret")).collect()}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [shared.value.features(r["head"] + r["body"] + r["tail"], r["path"] or "", r["kind"], len(r["head"]), len(r["head"]) + len(r["body"]))
                 for r in b.select(["head", "body", "tail", "path", "kind"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column("label"), b.column("row")], names=["x", "y", "row"])

    row = F.xxhash64("path", "kind", "head", "body", "tail", "label").alias("row")
    kept = got.where(told.isNotNull()).select("path", "kind", "head", "body", "tail", "label", row)
    model.forest = forest(save(kept.mapInArrow(measure, "x array<double>, y double, row long"), "features"))
    return model


def scan(docs: DataFrame, model: Model, path: str | None = "source", least: float = LEAST) -> DataFrame:
    """(doc_id, kind, start, end, value, score) of every finding that the forest accepts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # fixed numbers of trees, words and symbols

    def run(b):
        out = []
        for t, p in zip(b.column("text").to_pylist(), b.column("path").to_pylist(), strict=True):
            taken: list = []
            for k, lo, hi, s in sorted(shared.value.judge(t or "", p), key=lambda f: (-f[3], f[1], -f[2], f[0])):
                if s >= least and all(hi <= x["start"] or lo >= x["end"] for x in taken):
                    taken.append({"kind": k, "start": lo, "end": hi, "value": t[lo:hi], "score": s})
            out.append(sorted(taken, key=lambda x: x["start"]))
        return {"found": out}

    kind = "found array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"
    return map_texts(_with_path(docs, path), run, kind, ("doc_id", "path")).select(
        "doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")
