"""Personal data: base patterns, loose candidate generators and boosted trees that accept or refuse them.

Base spans (email, ip, card, phone) are found by fixed patterns and always stay. Generators with high recall
propose further, overlapping spans: addresses written with (at) and (dot), numbers grouped with blanks,
dots, slashes or brackets. Gradient-boosted trees score each from its format and its surroundings; the
margin is calibrated on spans kept back and a proposal is accepted from the threshold on that reaches
``PRECISION`` on those, unless it overlaps a base span or a better proposal.

There are no labelled spans, so the trees learn from base spans: those of at most ``TRAIN_DOCS`` documents drawn by a hash
of the text from all, and, however rare a kind is, of ``KIND_DOCS`` different texts of each kind drawn from all that hold
one (fewer only if there are no more). Each is a positive, also rewritten in place into a looser form; its spoiled forms
(wrong checksum, parts out of range, too few digits, text joined on) and the proposals that lie inside longer
words are negatives, ``TEXT_SPANS`` of either sort from one text at most. Without any base span nothing is added.

Null and empty texts have no spans. Very long texts, also without blanks, take time in proportion to their length. Offsets are code points, end exclusive. Rows are judged one by one, so
repeated rows, null ids and extra columns change nothing.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import hash_share, map_texts, sample_rate, save
from baflow.llm.trees import Boosted, boost, calibrate

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 6000
KIND_DOCS = 500
PRECISION = 0.99
TEXT_SPANS = 200       # training spans of one text
PART = 20_000          # proposals of a text that are scored at once
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# every pattern starts at the beginning of a run and gives nothing back, so long unbroken texts take linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE_AT = (
    re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++)(?: ?[(\[{]at[)\]}] ?| ?@ ?)"
               r"([A-Za-z0-9-]++(?:(?: ?[(\[{]dot[)\]}] ?| dot |\.)[A-Za-z0-9-]++)+)"),
    re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]++) at ([A-Za-z0-9-]++(?:(?: ?[(\[{]dot[)\]}] ?| dot )[A-Za-z0-9-]++)+)"))
_LOOSE_NUMBER = re.compile(r"(?<![0-9.])\(?[0-9][0-9 ().\-/]{6,30}[0-9](?![0-9])")
_WORDS = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "addr"), "card": ("card", "visa", "pay"),
          "phone": ("tel", "phone", "call", "fax", "mobile")}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(digits: str) -> bool:
    """At most 255, for any number of digits."""
    d = digits.lstrip("0")
    return len(d) < 3 or (len(d) == 3 and int(d) <= 255)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind, by start and kind."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > done and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append(("email", lo, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if _HAS_DIGIT(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(_small(p) for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            d = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                    if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return _ordered(out)


_HAS_DIGIT = re.compile(r"[0-9]").search


def _ordered(spans):
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Loose spans, overlapping ones included; the base spans are not among them as such."""
    out = []
    if any(sign in text for sign in (" dot ", "dot)", "dot]", "(at", "[at", "@ ", " @")):
        out += [("email", m.start(), m.end()) for pattern in _LOOSE_AT for m in pattern.finditer(text)]
    if _HAS_DIGIT(text):
        for m in _LOOSE_NUMBER.finditer(text):
            lo, hi = m.span()
            digits = sum(c.isdigit() for c in m.group())
            if digits >= 12:
                out.append(("card", lo, hi))
            if 7 <= digits <= 15:
                out.append(("phone", lo, hi))
            if len(re.findall(r"[0-9]+", m.group())) == 4:
                out.append(("ip", lo, hi))
    return out


class Cover:
    """Spans that do not overlap, kept in order, and the question whether a further span meets one of them."""

    def __init__(self, spans=()):
        self.starts, self.ends = [], []
        for _, lo, hi in sorted(spans, key=lambda s: s[1]):
            if self.ends and lo < self.ends[-1]:             # spans of two kinds: one covered stretch
                self.ends[-1] = max(self.ends[-1], hi)
            else:
                self.starts.append(lo)
                self.ends.append(hi)

    def meets(self, lo: int, hi: int) -> bool:
        return bisect.bisect_right(self.ends, lo) < bisect.bisect_left(self.starts, hi)

    def add(self, lo: int, hi: int) -> None:
        k = bisect.bisect_left(self.starts, lo)
        self.starts.insert(k, lo)
        self.ends.insert(k, hi)


def features(text: str, kind: str, lo: int, hi: int) -> list[float]:
    """Format of the span and of what stands around it."""
    s, before, after = text[lo:hi], text[max(0, lo - 30):lo], text[hi:hi + 15]
    runs = re.findall(r"[0-9]+", s)
    digits = "".join(runs)
    near = before.lower()
    return [
        KINDS.index(kind), len(s), len(digits), len(runs), max(map(len, runs), default=0), min(map(len, runs), default=0),
        len(set(digits)), len(set(re.sub(r"[0-9A-Za-z]", "", s))), s.count("."), s.count("-"), s.count(" "), s.count("/"),
        float("(" in s), float(s.count("(") == s.count(")")), float("@" in s), len(re.findall(r"\bdot\b", s)),
        float(bool(digits) and luhn(digits)), float(len(runs) == 4 and all(map(_small, runs))),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] == "+" or s[:1] == "+"),
        float(before[-1:] in "=:\"'#_/" and before != ""), float(any(w in near for w in _WORDS[kind])),
        sum(c.isdigit() for c in before) / 30, float(len(digits) >= 7 and len(set(digits)) <= 2)]


def _loosened(rng, kind: str, s: str) -> list[str]:
    """Looser writings of a base span, all positive."""
    if kind == "email":
        name, host = s.split("@")
        return [f"{name} at {host.replace('.', ' dot ')}", f"{name} (at) {host.replace('.', ' (dot) ')}", f"{name}[at]{host}"]
    if kind == "card":
        d = re.sub(r"[ -]", "", s)
        return [d[:4] + sep + d[4:8] + sep + d[8:12] + sep + d[12:] for sep in (".", "/")]
    if kind == "phone":
        d = "".join(c for c in s if c.isdigit())[-10:]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    return [s.replace(".", " . ")]


def _spoiled(rng, kind: str, s: str) -> list[str]:
    """Writings that look alike and are not personal data."""
    some = lambda n: "".join(str(x) for x in rng.integers(0, 10, n))
    d = "".join(c for c in s if c.isdigit())
    if kind == "card":
        wrong = d[:-1] + str((int(d[-1]) + 1 + int(rng.integers(0, 9))) % 10)
        return [wrong if not luhn(wrong) else wrong[:-1], ".".join(wrong[k:k + 4] for k in range(0, len(wrong), 4)), some(24)]
    if kind == "phone":
        return [f"{some(2)}-{some(2)}-20{some(2)}", f"{some(3)} {some(2)} {some(2)}", f"{some(1)}.{some(2)}.{some(4)}", some(8),
                f"{some(4)}/{some(2)}/{some(2)} {some(2)}"]
    if kind == "ip":
        return [".".join(str(300 + int(x)) for x in rng.integers(0, 600, 4)), f"{some(1)} . {some(4)} . {some(4)} . {some(2)}"]
    return []


def training_rows(text: str) -> list[tuple[float, list[float]]]:
    """Labelled feature rows from one document, by rewriting its base spans in place."""
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(text.encode()).digest()[:4], "little"))
    out = []
    spans = base_spans(text)
    cover = Cover(spans)
    for kind, lo, hi in _some(spans):
        s, head, tail = text[lo:hi], text[max(0, lo - 60):lo], text[hi:hi + 60]
        out.append((1.0, features(text, kind, lo, hi)))
        for label, forms in ((1.0, _loosened(rng, kind, s)), (0.0, _spoiled(rng, kind, s))):
            for form in forms:
                new, a = head + form + tail, len(head)
                found = [p for p in proposals(new) if p[1] < a + len(form) and p[2] > a]
                for k, x, y in found:
                    out.append((label if k == kind else 0.0, features(new, k, x, y)))
    inside = [(kind, lo, hi) for kind, lo, hi in proposals(text)
              if (text[max(0, lo - 1):lo].isalnum() or text[hi:hi + 1].isalnum()) and not cover.meets(lo, hi)]
    return out + [(0.0, features(text, *p)) for p in _some(inside)]


def _some(spans: list) -> list:
    """At most ``TEXT_SPANS`` of one text's spans, evenly spaced: one text does not fill the training sample."""
    return [spans[k] for k in np.linspace(0, len(spans) - 1, min(len(spans), TEXT_SPANS)).astype(int)]


@dataclass
class Model:
    trees: Boosted | None = None
    threshold: float = 1.0

    def spans(self, text: str) -> tuple[list, list]:
        """(base spans, all spans)."""
        base = base_spans(text)
        if self.trees is None:
            return base, base
        cover = Cover(base)
        free = [p for p in proposals(text) if not cover.meets(*p[1:])]
        if not free:
            return base, base
        score = np.concatenate([self.trees.predict(np.array([features(text, *p) for p in free[k:k + PART]]))
                                for k in range(0, len(free), PART)])
        taken, cover = [], Cover()
        for k in np.argsort(-score, kind="stable"):
            p = free[k]
            if score[k] >= self.threshold and not cover.meets(*p[1:]):
                taken.append(p)
                cover.add(*p[1:])
        return base, _ordered(base + taken)


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS, kind_docs: int = KIND_DOCS) -> Model:
    """Fit on the rewritten base spans of bounded, hash-drawn samples: of all documents, and of those that hold each kind."""
    texts = docs.where(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text"))
    drawn = hash_share(sample_rate(texts.count(), train_docs), "text")
    sample = texts.where(drawn)

    def kinds(b):
        return {"kinds": [sorted({s[0] for s in base_spans(t)}) for t in b.column("text").to_pylist()]}

    named = texts.withColumn("name", F.xxhash64(F.lit(5), "text")).withColumn("drawn", drawn)
    holds = save(map_texts(named, kinds, "kinds array<string>", ("name", "drawn")).where("size(kinds) > 0").groupBy("name").agg(
        F.first("kinds").alias("kinds"), F.first("drawn").alias("drawn")), "kinds")
    names = {}
    for kind in KINDS:                                             # KIND_DOCS names each; many are drawn already in small tables
        for r in holds.where(F.array_contains("kinds", kind)).orderBy("name").limit(kind_docs).collect():
            names[r["name"]] = r["drawn"]
    more = [(n,) for n, known in names.items() if not known]
    if more:
        few = named.where(~F.col("drawn")).join(
            F.broadcast(docs.sparkSession.createDataFrame(more, "name long")), "name")
        sample = sample.union(few.dropDuplicates(["name"]).select("text"))

    def rows(b):
        return {"rows": [[[y, *x] for y, x in training_rows(t)] for t in b.column("text").to_pylist()]}

    got = map_texts(sample, rows, "rows array<array<double>>", ()).where("size(rows) > 0").select(
        F.explode("rows").alias("r")).toPandas()
    if not len(got):
        return Model()
    data = np.array(sorted(got["r"].map(tuple)))
    y, x = data[:, 0], data[:, 1:]
    kept = np.random.default_rng(2).random(len(y)) < 0.3
    if not 0 < y[~kept].mean() < 1 or not 0 < y[kept].sum() < kept.sum():
        return Model()
    model = boost(x[~kept], y[~kept])
    model.slope, model.shift = calibrate(model.margin(x[kept]), y[kept])
    p = model.predict(x[kept])
    order = np.argsort(-p)
    precision = np.cumsum(y[kept][order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(precision >= PRECISION)
    return Model(model, float(max(0.5, p[order[good[-1]]])) if len(good) else 1.1)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs``: base counts per kind, the base spans' checksum and all spans, as text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a bounded number of small trees

    def run(b):
        out = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for t in b.column("text").to_pylist():
            base, every = shared.value.spans(t or "")
            for k in KINDS:
                out[f"n_{k}"].append(sum(s[0] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(digest(base).encode()).hexdigest())
            out["spans"].append(digest(every))
        return out

    return map_texts(docs, run, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with every span, overlapping ones together, replaced by the first one's kind in brackets."""
    out, at = [], 0
    for kind, lo, hi in spans:
        if lo >= at:
            out += [text[at:lo], f"[{kind.upper()}]"]
        at = max(at, hi)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; other columns and all rows stay (n_chars is renewed)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    others = tuple(c for c in docs.columns if c != "text")

    def run(b):
        return {"text": [None if t is None else redacted(t, shared.value.spans(t)[1]) for t in b.column("text").to_pylist()]}

    out = map_texts(docs, run, "text string", others).select(*docs.columns)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(kind)))
    return out
