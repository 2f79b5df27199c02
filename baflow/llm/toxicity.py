"""Toxicity: support vector machine on a gapped subsequence string kernel with Nystroem landmarks.

Unit of scoring: a *window*, that is a word of the lower-cased text with its marks and digits taken out
(``i.d.i.o.t`` is one window) or a run of three or more one-letter words joined (``m o r o n``). A text's
score is that of its best window, calibrated to 0..1.

Kernel: K_p(x, l) sums, over all common subsequences of ``ORDER`` letters, ``DECAY`` to the power of the
spans they take in both strings, so inserted characters weaken a match but do not end it. Landmarks are
letter runs that the labelled sentences tie to label 1 (greedy cover of the positive documents) and
clean words close to them; features are K(x, landmarks) whitened with the landmarks' own kernel matrix
(Nystroem); a linear SVM (squared hinge) on these is equal to a weighted sum of landmark kernels.

Training reads the words of at most ``TRAIN_DOCS`` labelled documents of each label, drawn by a hash of the
text. Windows of positive documents are chosen as in multiple-instance learning: those that hold a landmark
first, then the best-scoring one. Scoring is one pass over whole texts; each worker keeps the scores of words
it has seen.

Null and empty texts, and texts without a letter, have no window and get the lowest score. Without labels
of both kinds every text gets score 0. Repeated rows and null ids are rows like any other.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import hash_share, map_texts, sample_rate

ORDER = 4
DECAY = 0.5
TRAIN_DOCS = 2000
MAX_LANDMARKS = 48
MAX_CLEAN_WORDS = 20_000          # clean words that the support vector machine is fitted against
CACHE_WORDS = 500_000
LONGEST = 48                     # a longer word is scored in overlapping parts of this length
_NOT_LETTER = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_]\s+){2,}[^\W\d_](?!\S)")
_CACHE: dict[int, dict[str, float]] = {}


def windows(text: str | None) -> set[str]:
    """Windows of a whole text (words before marks are taken out; see ``clean``)."""
    if not text:
        return set()
    text = text.lower()
    out = set(text.split())
    for m in _SPACED.finditer(text):
        run = m.group().split()
        out.add("".join(run))
        out.update("".join(run[k:k + 12]) for k in range(0, len(run), 6) if len(run) > 12)
    return out


def clean(word: str) -> list[str]:
    """Letters of a word; very long ones in overlapping parts."""
    w = word if word.isalpha() else _NOT_LETTER.sub("", word)
    if len(w) <= LONGEST:
        return [w] if w else []
    return [w[k:k + LONGEST] for k in range(0, len(w) - LONGEST // 2, LONGEST // 2)]


def _codes(words: list[str]) -> np.ndarray:
    out = np.zeros((len(words), max((len(w) for w in words), default=1) or 1), dtype="u4")
    for k, w in enumerate(words):
        out[k, :len(w)] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out


def _masks(codes: np.ndarray) -> np.ndarray:
    """One bit per letter modulo 64; a common subsequence of p different letters needs p common bits."""
    bits = np.where(codes > 0, np.uint64(1) << (codes % 64).astype("u8"), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


def pair_kernel(s: np.ndarray, t: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Subsequence kernel of row k of ``s`` with row k of ``t`` (code matrices, 0 behind the end).

    ``prev[i]`` holds, for the part of s read so far and every prefix of t, the weight of common
    subsequences of length i, decayed to the end of both; one step per column of s.
    """
    n, m = len(s), t.shape[1]
    step = decay ** np.maximum(0, np.subtract.outer(np.arange(m), np.arange(m)).T).astype("f4")
    step = np.triu(step).astype("f4")                # spreads a match at column k of t to later columns
    prev = [np.zeros((n, m + 1), "f4") for _ in range(order)]
    prev[0][:] = 1.0
    total = np.zeros(n, "f4")
    known = t > 0
    for k in range(s.shape[1]):
        match = ((t == s[:, k:k + 1]) & known).astype("f4") * np.float32(decay * decay)
        total += (match * prev[order - 1][:, :-1]).sum(axis=1)
        for i in range(order - 1, 0, -1):
            prev[i] *= decay
            prev[i][:, 1:] += (match * prev[i - 1][:, :-1]) @ step
    return total


def kernel_matrix(words: list[str], landmarks: list[str]) -> np.ndarray:
    """K(word, landmark) / K(landmark, landmark): 1 when the word holds the landmark as it is.

    The kernel is cut to 0 where a word lacks more than a fifth of the landmark's letters.
    """
    out = np.zeros((len(words), len(landmarks)), "f4")
    if not words:
        return out
    t, own = _codes(landmarks), _codes(landmarks)
    norm = pair_kernel(own, own) + 1e-12
    tm = _masks(t)
    need = [max(min(ORDER, len(set(x))), -(-4 * len(set(x)) // 5)) for x in landmarks]
    by_len = np.argsort([len(w) for w in words], kind="stable")
    for part in np.array_split(by_len, max(1, len(words) // 4000)):
        s = _codes([words[k] for k in part])
        sm = _masks(s)
        common = np.bitwise_count(sm[:, None] & tm[None, :])
        a, b = np.nonzero(common >= np.array(need)[None, :])
        for lo in range(0, len(a), 60_000):
            i, j = a[lo:lo + 60_000], b[lo:lo + 60_000]
            out[part[i], j] = pair_kernel(s[i], t[j]) / norm[j]
    return out


@dataclass
class Model:
    landmarks: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None        # one per landmark: whitening and SVM weights together
    bias: float = -1.0
    slope: float = 1.0
    shift: float = 0.0

    def decide(self, words: list[str]) -> np.ndarray:
        if not self.landmarks or not words:
            return np.full(len(words), self.bias)
        return kernel_matrix(words, self.landmarks) @ self.weights + self.bias

    def probability(self, f: float) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * f + self.shift, -50, 50))))


def _cover(pos: list[set[str]], neg: list[set[str]], most: int) -> list[str]:
    """Letter runs of 4 to 8 letters that mark positive documents and hardly occur elsewhere.

    Greedy: the run that explains most of the open (document, word) pairs is taken, its words are closed.
    """
    def runs(w):
        return {w[k:k + n] for n in range(4, 9) for k in range(len(w) - n + 1)}

    # near copies of one document count once: they agree on their words of least checksum
    once = {tuple(heapq.nsmallest(3, words, key=lambda w: zlib.crc32(w.encode()))): words for words in pos}
    pos = [once[k] for k in sorted(once)]
    docs_of = Counter(w for words in pos for w in words)
    least = max(3, len(pos) // 100)
    count: dict[str, int] = {}
    for n in range(4, 9):                             # one length at a time keeps the driver's memory small
        c: Counter[str] = Counter()
        for w, k in docs_of.items():
            for r in {w[i:i + n] for i in range(len(w) - n + 1)}:
                c[r] += k
        count.update((r, k) for r, k in c.items() if k >= least)
    against: Counter[str] = Counter()
    for w, k in Counter(w for words in neg for w in words).items():
        for r in runs(w) & count.keys():
            against[r] += k
    able = {r for r, k in count.items() if against[r] * len(pos) <= 0.004 * k * len(neg)}
    held: dict[str, set[str]] = {r: set() for r in able}
    for w in docs_of:
        for r in runs(w) & able:
            held[r].add(w)
    open_words, chosen = set(docs_of), []
    gain = {r: count[r] for r in able}
    while gain and len(chosen) < most:
        top = max(gain.values())
        if top < least:
            break
        # the longer run among those that explain nearly as much
        best = max((r for r, c in gain.items() if c >= 0.9 * top), key=lambda r: (len(r), gain[r], r))
        chosen.append(best)
        gone = held[best] & open_words
        open_words -= gone
        for w in gone:
            for r in runs(w) & able:
                if r in gain:
                    gain[r] -= docs_of[w]
        gain.pop(best)
    return chosen


def _svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient descent; classes weigh the same."""
    n, d = x.shape
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    xb = np.hstack([x, np.ones((n, 1))])
    reg = np.append(np.full(d, 1.0 / (c * 1000)), 0.0)
    rate = 1.0 / (2.0 * np.linalg.norm(xb * np.sqrt(weight)[:, None], 2) ** 2 + reg.max())
    w = np.zeros(d + 1)
    v, t = w.copy(), 1.0
    for _ in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (xb @ v))
        new = v - rate * (-2.0 * xb.T @ (weight * y * slack) + reg * v)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def _calibrate(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt scaling with smoothed targets (a few Newton steps on the logistic loss)."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([f, np.ones_like(f)], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - target) + 1e-3 * w
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.linalg.solve(h, g)
    return float(max(w[0], 1e-3)), float(w[1])


def fit(pos: list[set[str]], neg: list[set[str]], seed: int = 11) -> Model:
    """Fit on the word sets of positive and negative documents."""
    rng = np.random.default_rng(seed)
    if not pos or not neg:
        return Model()
    seeds = _cover(pos, neg, MAX_LANDMARKS // 2)
    if not seeds:
        return Model()
    plain = sorted({w for words in neg for w in words if len(w) > 2})
    bad = sorted({w for words in pos for w in words if any(r in w for r in seeds)} - set(plain))
    # inserted and repeated letters of the positive windows: the kernel's gaps are trained, not only hoped for
    varied = [w[:k] + chr(rng.integers(97, 123)) + w[k:] for w in bad + seeds for k in [int(rng.integers(1, len(w)))]]
    plain = [plain[k] for k in rng.permutation(len(plain))[:MAX_CLEAN_WORDS]]
    close = kernel_matrix(plain, seeds).max(axis=1)
    hard = [plain[k] for k in np.argsort(-close, kind="stable")[:1500]]
    easy = plain[:3000]
    marks = seeds + [h for h in hard if h not in seeds and len(h) <= 10][:MAX_LANDMARKS - len(seeds)][:8]
    gram = kernel_matrix(marks, marks)
    gram = np.sqrt(np.maximum(gram * gram.T, 0))       # K(a, b) over the roots of K(a, a) and K(b, b)
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-3 * value.max()
    white = vector[:, keep] / np.sqrt(value[keep])
    model = Model()
    negatives = sorted(set(hard) | set(easy))
    positives = bad + varied + seeds
    for _ in range(2):
        words = positives + negatives
        y = np.append(np.ones(len(positives)), -np.ones(len(negatives)))
        x = kernel_matrix(words, marks) @ white
        w, b = _svm(x, y)
        model = Model(marks, white @ w, b)
        # clean words that score high join the negatives; positive documents without a window give their best
        scores = dict(zip(plain, model.decide(plain), strict=True))
        negatives = sorted(set(negatives) | {p for p, s in scores.items() if s > -0.5})
        lost = [words for words in pos if words and not any(r in v for r in seeds for v in words)]
        for words in lost:
            order = sorted(words)
            f = model.decide(order)
            best = int(f.argmax())
            if f[best] > 0 and scores.get(order[best], -1) <= 0:
                positives.append(order[best])
    def top(docs):
        every = sorted(set().union(*docs))
        s = dict(zip(every, model.decide(every), strict=True))
        return np.array([max((s[w] for w in words), default=model.bias) for words in docs])
    f, y = np.concatenate([top(pos), top(neg[::2])]), np.append(np.ones(len(pos)), np.zeros(len(neg[::2])))
    model.slope, model.shift = _calibrate(f, y)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", may_learn: Column | None = None,
          train_docs: int = TRAIN_DOCS) -> Model:
    """Fit on a bounded, hash-drawn sample of the labelled documents that ``may_learn`` allows."""
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    given = given.groupBy("doc_id").agg(F.max(F.col(label)).alias("_label"))
    given = given if may_learn is None else given.where(may_learn)
    sizes = {r["_label"]: r["n"] for r in given.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for v, n in sizes.items():
        keep = keep | ((F.col("_label") == v) & hash_share(sample_rate(n, train_docs), "doc_id"))
    # one text of each id: repeated rows do not count twice
    sample = docs.select("doc_id", "text").join(given.where(keep), "doc_id").groupBy("doc_id", "_label").agg(
        F.min("text").alias("text"))

    def words(b):
        return {"words": [" ".join(sorted({c for w in windows(t) for c in clean(w)}))
                          for t in b.column("text").to_pylist()]}

    got = map_texts(sample, words, "words string", ("_label", "doc_id")).orderBy("doc_id").collect()
    one: dict[str, str] = {}                          # one object per distinct word
    bags = [(r["_label"], {one.setdefault(w, w) for w in r["words"].split()}) for r in got]
    pos, neg = [b for v, b in bags if v == 1], [b for v, b in bags if v == 0]
    return fit(pos, neg)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row of ``docs``."""
    import uuid
    shared = docs.sparkSession.sparkContext.broadcast(model)    # at most MAX_LANDMARKS words and weights
    key = uuid.uuid4().int

    def run(b):
        if key not in _CACHE:
            _CACHE.clear()
            _CACHE[key] = {}
        known, m = _CACHE[key], shared.value
        bags = [windows(t) for t in b.column("text").to_pylist()]
        new = [w for w in set().union(*bags) if w not in known]
        parts = [clean(w) for w in new]
        every = sorted({p for ps in parts for p in ps if len(p) >= ORDER - 1})
        f = dict(zip(every, m.decide(every).tolist(), strict=True))
        here = {w: max((f.get(p, m.bias) for p in ps), default=m.bias) for w, ps in zip(new, parts, strict=True)}
        if len(known) + len(here) <= CACHE_WORDS:
            known.update(here)
            best = [max(map(known.__getitem__, bag), default=m.bias) for bag in bags]
        else:
            best = [max((known[w] if w in known else here[w] for w in bag), default=m.bias) for bag in bags]
        p = [m.probability(x) if m.landmarks else 0.0 for x in best]
        return {"score": p, "predicted": np.array([x >= threshold for x in p], dtype="i4")}

    return map_texts(docs, run, "score double, predicted int")
