"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; every run of non-letters is one space. Character n-grams (1 to 3) are hashed into
``DIM`` columns. Document frequencies come from all training documents (a Spark aggregate). The weights are
fitted with follow-the-regularised-leader (proximal, per-coordinate rates, L1 and L2 penalties) on about ``TRAIN_DOCS``
different training texts at most, the same share of them for each language and ``LEAST_DOCS`` of each at least, drawn from all by a hash of the text,
so that rare languages are learned at any size; ``CALIBRATE`` of them are kept back to fit the temperature of the softmax. Prediction
is one pass over whole texts.

Null texts and texts without letters get ``und`` with score 0. With no training documents every text gets
``und``; with one language that language gets score 1. Training texts without letters teach nothing. Repeated texts of a language count
once in the draw; otherwise repeated rows and null ids are rows like any other; only the listed columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import map_texts, sample_rate

DIM = 1 << 14
ORDERS = (1, 2, 3)
TRAIN_DOCS = 4000
LEAST_DOCS = 50
CALIBRATE = 0.2
UNDETERMINED = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """True for code points that are letters; made once per worker."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTER[0]


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None when it has no letter."""
    if not text:
        return None
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = _letters()[cp]
    if not is_letter.any():
        return None
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]                      # the first of a run of non-letters stays, as a space
    a = np.where(is_letter, cp, 32)[keep].astype("u8")
    h, out = np.zeros(len(a), dtype="u8"), np.zeros(DIM, dtype="f8")
    shift = np.uint64(64 - DIM.bit_length() + 1)
    for n in range(1, max(ORDERS) + 1):
        if len(a) < n:
            break
        h = h[:len(a) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + a[n - 1:] + np.uint64(n)
        if n in ORDERS:
            out += np.bincount(((h * np.uint64(0xD6E8FEB86659FD93)) >> shift).astype("i8"), minlength=DIM)
    return out


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with letters and, for each column, the number of texts that have it."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(DIM + 1, dtype="i8"), 0
        for b in batches:
            for t in b["text"]:
                c = gram_counts(t)
                if c is not None:
                    df[:-1] += c > 0
                    n += 1
        df[-1] = n
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"column": seen, "n": df[seen]})

    rows = texts.select("text").mapInPandas(count, "column long, n long").groupBy("column").agg(
        F.sum("n").alias("n")).toPandas()          # DIM + 1 rows at most
    df = np.zeros(DIM + 1)
    df[rows["column"].to_numpy(dtype="i8")] = rows["n"].to_numpy(dtype="f8")
    return int(df[-1]), df[:-1]


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray          # DIM x languages, idf folded in
    idf2: np.ndarray             # idf squared, for the norm
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        c = gram_counts(text)
        if c is None or not self.langs:
            return UNDETERMINED, 0.0
        at = np.flatnonzero(c)
        tf = 1.0 + np.log(c[at])
        norm = np.sqrt(float(tf * tf @ self.idf2[at])) or 1.0
        z = (tf @ self.weights[at] / norm + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return self.langs[k], float(p[k])


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, *, alpha: float = 0.5,
             beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, epochs: int = 4, seed: int = 5):
    """FTRL-proximal for the softmax loss over sparse rows (columns, values); the last column is the bias."""
    z, n = np.zeros((DIM + 1, classes)), np.zeros((DIM + 1, classes))

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(zi) <= l1, 0.0, w)

    order = np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for k in order:
            at, x = rows[k]
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y[k]] -= 1.0
            g = np.outer(x, p)
            g2 = n[at] + g * g
            z[at] += g - (np.sqrt(g2) - np.sqrt(n[at])) / alpha * w
            n[at] = g2
    full = weights(np.arange(DIM + 1))
    return full[:-1], full[-1]


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature of least negative log likelihood on rows kept back (a search over its logarithm)."""
    if not len(y):
        return 1.0
    best = (np.inf, 1.0)
    for t in np.exp(np.linspace(np.log(0.02), np.log(20), 120)):
        s = logits / t
        s = s - s.max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]))
        best = min(best, (loss + 1e-4 * abs(np.log(t)), float(t)))
    return best[1]


def draw(rows: DataFrame, train_docs: int) -> DataFrame:
    """Of ``rows`` (text, label) about ``train_docs`` different texts, by language, drawn by a hash of the text."""
    letters = rows.where(F.col("text").rlike("\\p{L}"))
    counts = letters.groupBy("label").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n"))
    told = counts.collect()                         # one row for each language
    each = max(LEAST_DOCS, train_docs // max(1, len(told)))
    share = F.lit(1.0)
    for r in told:
        share = F.when(F.col("label") == r["label"], F.lit(sample_rate(r["n"], each))).otherwise(share)
    place = F.pmod(F.xxhash64(F.lit(7), "text"), F.lit(1 << 20))
    return letters.where(place < F.ceil(share * (1 << 20))).dropDuplicates(["label", "text"])


def train(docs: DataFrame, label: str = "lang", may_learn: Column | None = None,
          train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on the rows of ``docs`` that ``may_learn`` allows and that have a text and a label."""
    rows = docs.where(F.col("text").isNotNull() & F.col(label).isNotNull())
    rows = rows if may_learn is None else rows.where(may_learn)
    rows = rows.select(F.col("text").cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    n, df = document_frequencies(rows)
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [(lab, gram_counts(t)) for lab, t in zip(b["label"], b["text"], strict=True)]
            got = [(lab, c, np.flatnonzero(c)) for lab, c in got if c is not None]
            if not got:                             # a batch of texts without letters
                continue
            yield pd.DataFrame({"label": [g[0] for g in got], "at": [g[2].astype("<i4").tobytes() for g in got],
                                "tf": [(1.0 + np.log(g[1][g[2]])).astype("<f4").tobytes() for g in got]})

    drawn = draw(rows, train_docs)
    sample = drawn.mapInPandas(features, "label string, at binary, tf binary").toPandas().sort_values(["label", "at", "tf"])
    langs = sorted(sample["label"].unique().tolist())
    y = sample["label"].map({v: k for k, v in enumerate(langs)}).to_numpy(dtype="i8")
    vectors = []
    for a, t in zip(sample["at"], sample["tf"], strict=True):
        at = np.frombuffer(a, dtype="<i4")
        x = np.frombuffer(t, dtype="<f4") * idf[at]
        vectors.append((np.append(at, DIM), np.append(x / np.linalg.norm(x), 1.0)))
    if not langs:
        return Model([], np.zeros((DIM, 0)), idf * idf, np.zeros(0), 1.0)
    kept = np.random.default_rng(3).random(len(y)) < CALIBRATE
    w, b = fit_ftrl([v for v, k in zip(vectors, kept, strict=True) if not k], y[~kept], len(langs))
    full = np.vstack([w, b])
    logits = np.array([x @ full[at] for (at, x), k in zip(vectors, kept, strict=True) if k]).reshape(-1, len(langs))
    return Model(langs, w * idf[:, None], idf * idf, b, fit_temperature(logits, y[kept]))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",),
             into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of every row, with the predicted language and its probability in columns ``into``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)    # DIM x languages numbers: a fixed size

    def predict(b):
        got = [shared.value.predict(t) for t in b.column("text").to_pylist()]
        return {into[0]: [g[0] for g in got], into[1]: [g[1] for g in got]}

    return map_texts(docs, predict, f"{into[0]} string, {into[1]} double", keep)


def accepted(docs: DataFrame, model: Model, least: float = 0.4) -> DataFrame:
    """The rows of ``docs`` whose language is determined with probability ``least`` or more; columns stay."""
    told = identify(docs, model, tuple(docs.columns), ("__lang", "__score"))
    return told.where((F.col("__lang") != UNDETERMINED) & (F.col("__score") >= least)).select(*docs.columns)
