"""Small decision trees on binned features: a forest of averaged trees and gradient boosting.

The boosted trees are for a bounded sample. The forest learns from all rows of a table (``forest``): a level of all trees is one pass
in which every task counts its rows by tree, node, feature and bin. A fitted model is a few arrays that tasks evaluate on their own rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import save

BINS = 32


@dataclass
class Tree:
    feature: np.ndarray      # -1 in a leaf
    cut: np.ndarray          # goes left when the value is at most this
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), "i8")
        rows = np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            k = at[rows]
            at[rows] = np.where(x[rows, self.feature[k]] <= self.cut[k], self.left[k], self.right[k])
        return self.value[at]


def edges(x: np.ndarray) -> list[np.ndarray]:
    """Cut points of every feature: quantiles of its distinct values."""
    out = []
    for col in x.T:
        v = np.unique(col)
        mid = (v[1:] + v[:-1]) / 2
        out.append(mid if len(mid) < BINS else np.unique(np.quantile(mid, np.linspace(0, 1, BINS))))
    return out


def grow(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], depth: int, least: int = 5,
         try_features: int = 0, rng: np.random.Generator | None = None, hessian: np.ndarray | None = None) -> Tree:
    """Least-squares tree; with a Hessian its leaves hold Newton steps (sum of targets over sum of Hessian)."""
    h = np.ones(len(x)) if hessian is None else hessian
    binned = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    nodes: list[list] = []

    def build(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        g, w = target[rows].sum(), h[rows].sum()
        nodes.append([-1, 0.0, -1, -1, g / (w + 1e-9)])
        if level == depth or len(rows) < 2 * least:
            return me
        best = (1e-9, -1, 0)
        feats = range(x.shape[1]) if not try_features else rng.choice(x.shape[1], try_features, replace=False)
        for f in feats:
            if not len(cuts[f]):
                continue
            b, m = binned[rows, f], len(cuts[f]) + 1
            gs, ws = np.bincount(b, target[rows], m).cumsum()[:-1], np.bincount(b, h[rows], m).cumsum()[:-1]
            ns = np.bincount(b, minlength=m).cumsum()[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = gs ** 2 / ws + (g - gs) ** 2 / (w - ws) - g * g / w
            gain = np.where((ns >= least) & (len(rows) - ns >= least), gain, -1.0)
            k = int(np.argmax(gain))
            best = max(best, (float(gain[k]), int(f), k))
        if best[1] >= 0:
            _, f, k = best
            low = binned[rows, f] <= k
            nodes[me][:2] = [f, float(cuts[f][k])]
            nodes[me][2] = build(rows[low], level + 1)
            nodes[me][3] = build(rows[~low], level + 1)
        return me

    build(np.arange(len(x)), 0)
    a, c, lo, hi, v = zip(*nodes, strict=True)
    return Tree(np.array(a), np.array(c), np.array(lo), np.array(hi), np.array(v))


@dataclass
class Boosted:
    trees: list[Tree]
    base: float
    rate: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2) -> Boosted:
    """Gradient boosting of the logistic loss."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model, cuts = Boosted([], float(np.log(p / (1 - p))), rate), edges(x)
    f = np.full(len(y), model.base)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-f))
        t = grow(x, y - q, cuts, depth, hessian=np.maximum(q * (1 - q), 1e-6))
        t.value = np.clip(t.value, -4, 4)
        model.trees.append(t)
        f = f + rate * t.predict(x)
    return model


def calibrate(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve over margins kept back from the fit."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x, w = np.stack([margin, np.ones_like(margin)], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * w)
    return float(max(w[0], 1e-3)), float(w[1])


@dataclass
class Forest:
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sum((t.predict(x) for t in self.trees), np.zeros(len(x))) / max(1, len(self.trees))


def row_edges(rows: DataFrame) -> list[np.ndarray]:
    """Cut points of every feature (array column ``x``) over all rows: between the quantiles of its distinct values."""
    each = rows.select(F.posexplode("x").alias("f", "v")).distinct()
    got = each.groupBy("f").agg(F.percentile_approx("v", [k / BINS for k in range(BINS + 1)], 10_000).alias("q")).collect()
    values = {r["f"]: np.unique(r["q"]) for r in got}
    return [(values[f][1:] + values[f][:-1]) / 2 for f in range(len(values))]


_POISSON = np.cumsum([np.exp(-1) / float(np.prod(range(1, k + 1))) for k in range(8)])


def _draws(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row (a 64-bit hash) is drawn for a tree: a Poisson number of mean 1, the same wherever the row lies."""
    with np.errstate(over="ignore"):
        z = row + np.uint64(0x9E3779B97F4A7C15) * np.uint64(1 + tree + 1000 * seed)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return np.searchsorted(_POISSON, ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / 2.0 ** 53, "right").astype("f8")


def forest(rows: DataFrame, trees: int = 40, depth: int = 8, least: int = 3, seed: int = 17) -> Forest:
    """Random forest over all rows (x array<double>, y 0 or 1, row long: a hash that tells rows apart).

    Every tree sees a bootstrap of the rows and, at each split, the root of the features. Nodes are numbered as in a heap (1; 2, 3; ...). The driver
    gets one best split per node; the counts are whole numbers, so the forest does not depend on how the rows lie.
    """
    cuts = row_edges(rows)
    if not cuts:
        return Forest([])
    wide, bins, tries = len(cuts), BINS + 1, min(len(cuts), max(2, int(np.sqrt(len(cuts)) + 1)))

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, wide)
            low = np.stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)], axis=1).astype("u1")
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in low], pa.binary()), b.column("y"), b.column("row")], names=["x", "y", "row"])

    binned = save(rows.select("x", F.col("y").cast("double").alias("y"), "row").mapInArrow(to_bins, "x binary, y double, row long"), "bins")
    feature, cut = np.full((trees, 2 ** (depth + 1)), -1), np.zeros((trees, 2 ** (depth + 1)), "i8")
    value = np.zeros((trees, 2 ** (depth + 1)))

    def tried(tree: int, node: int) -> np.ndarray:
        return np.random.default_rng([seed, tree, node]).choice(wide, tries, replace=False)

    for level in range(depth):
        first, nodes = 2 ** level, [[n for n in range(2 ** level, 2 ** (level + 1)) if level == 0 or feature[t, n // 2] >= 0] for t in range(trees)]
        if not any(nodes):
            break
        look = np.zeros((trees, first, tries), "i8")
        for t in range(trees):
            for n in nodes[t]:
                look[t, n - first] = tried(t, n)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((2, first * tries * bins)) if nodes[t] else None for t in range(trees)]
            for b in batches:
                x = np.frombuffer(b"".join(b.column("x").to_pylist()), "u1").reshape(-1, wide)
                y, row, every = b.column("y").to_numpy(), b.column("row").to_numpy().view("u8"), np.arange(len(x))
                for t in range(trees):
                    if not nodes[t]:
                        continue
                    w = _draws(row, t, seed)
                    at, use = np.ones(len(x), "i8"), w > 0
                    for _ in range(level):
                        f = feature[t, at]
                        use &= f >= 0
                        at = np.where(use, 2 * at + (x[every, np.maximum(f, 0)] > cut[t, at]), at)
                    k, slot = every[use], at[use] - first
                    place = (slot[:, None] * tries + np.arange(tries)) * bins + x[k[:, None], look[t, slot]]
                    for s, v in enumerate((w[k], w[k] * y[k])):
                        total[t][s] += np.bincount(place.ravel(), np.repeat(v, tries), first * tries * bins)
            for t in range(trees):
                if not nodes[t]:
                    continue
                sums = total[t].reshape(2, first, tries * bins).transpose(1, 0, 2)
                yield pa.RecordBatch.from_arrays([pa.array([t] * len(nodes[t]), pa.int32()), pa.array(nodes[t], pa.int32()),
                                                  pa.array([sums[n - first].tobytes() for n in nodes[t]], pa.binary())], names=["tree", "node", "sums"])

        def best(table: pa.Table) -> pa.Table:
            held: dict = {}
            for t, n, raw in zip(*(table.column(c).to_pylist() for c in ("tree", "node", "sums")), strict=True):
                held[t, n] = held.get((t, n), 0.0) + np.frombuffer(raw).reshape(2, tries, bins)
            out = []
            for (t, n), sums in held.items():
                (w, g), (ws, gs) = sums[:, 0].sum(axis=1), sums.cumsum(axis=2)[:, :, :-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = gs ** 2 / ws + (g - gs) ** 2 / (w - ws) - g * g / w
                gain = np.where((ws >= least) & (w - ws >= least), gain, -1.0)
                j, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
                good = bool(gain[j, k] > 1e-9)
                left = gs[j, k] / ws[j, k] if good else 0.0
                right = (g - gs[j, k]) / (w - ws[j, k]) if good else 0.0
                out.append((t, n, int(look[t, n - first, j]) if good else -1, int(k), g / max(w, 1e-9), left, right))
            return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int32()] * 4 + [pa.float64()] * 3, strict=True)],
                            names=["tree", "node", "feature", "cut", "mean", "left", "right"])

        told = binned.mapInArrow(count, "tree int, node int, sums binary").withColumn("part", F.col("node") % 8)
        for r in told.groupBy("tree", "part").applyInArrow(
                best, "tree int, node int, feature int, cut int, mean double, left double, right double").collect():
            t, n = r["tree"], r["node"]
            feature[t, n], cut[t, n] = r["feature"], r["cut"]
            value[t, n] = r["mean"]
            if r["feature"] >= 0:
                value[t, 2 * n], value[t, 2 * n + 1] = r["left"], r["right"]
    out = []
    for t in range(trees):
        inner = feature[t] >= 0
        limit = np.array([cuts[f][k] if f >= 0 and k < len(cuts[f]) else np.inf for f, k in zip(feature[t], cut[t], strict=True)])
        heap = np.arange(len(inner))
        # heap order from the root at 1: node 0 stands for it
        shift = lambda a: np.r_[a[1], a[1:]]
        out.append(Tree(shift(feature[t]), shift(limit), shift(np.where(inner, 2 * heap, -1)), shift(np.where(inner, 2 * heap + 1, -1)), shift(value[t])))
    return Forest(out)
