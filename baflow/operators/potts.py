"""Piecewise-constant (Potts) fit of one series given as blocks: optimal partitioning with pruning, in parts.

With prefix sums of counts, values and squares, the fit of blocks ``s+1..e`` by their mean costs

    SSE(s, e) = (Q[e] - Q[s]) - (S[e] - S[s])**2 / (N[e] - N[s]),

and the best cost of the first ``e`` blocks follows ``F(e) = min over s of F(s) + SSE(s, e) + gamma`` with
``F(0) = -gamma``, where a segment that starts behind a break has at least ``kmin`` points and a series with
fewer than ``2 * kmin`` points up to ``e`` has no break. A start that is worse than a break at ``e`` even without
its penalty can never win once ``kmin`` points lie behind ``e``, so it leaves the list of live starts then. One
method for series of every length.

A series may come in parts: all that later blocks need of earlier ones are the live starts with their costs and prefix sums
(``Starts``). A start that was dropped never wins again, so handing on the live ones is exact. Each part gives the best start of
each of its blocks; the breaks are traced back through the parts from the last to the first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_ROW = ("block", "n", "s", "q", "cost", "dies")


@dataclass
class Starts:
    """Live starts (rows of block, prefix count, sum and squares, cost, count at which it leaves) and those not yet ``kmin`` points back."""
    end: np.ndarray = field(default_factory=lambda: np.zeros(4))                  # block, n, s, q behind the last block
    live: np.ndarray | None = None
    waiting: np.ndarray = field(default_factory=lambda: np.zeros((0, len(_ROW))))

    def packed(self) -> bytes:
        """As bytes: the end, the number of live starts, and both lists."""
        return np.concatenate([self.end, [float(len(self.live))], self.live.ravel(), self.waiting.ravel()]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Starts:
        a = np.frombuffer(data)
        rows = a[5:].reshape(-1, len(_ROW))
        return cls(a[:4].copy(), rows[:int(a[4])].copy(), rows[int(a[4]):].copy())


def advance(starts: Starts, count, total, squares, kmin: int, gamma: float) -> np.ndarray:
    """Best start of each further block; ``starts`` is carried on behind them."""
    base, n0, s0, q0 = starts.end
    n, s, q = (x0 + np.cumsum(np.asarray(x, dtype=float)) for x0, x in ((n0, count), (s0, total), (q0, squares)))
    live = starts.live if starts.live is not None else np.array([[0.0, 0.0, 0.0, 0.0, -gamma, np.inf]])
    waiting = list(starts.waiting)
    before = np.zeros(len(n), dtype=np.int64)
    for e in range(len(n)):
        if n[e] >= 2 * kmin:
            ready = [w for w in waiting if n[e] - w[1] >= kmin]
            waiting = [w for w in waiting if n[e] - w[1] < kmin]
            live = np.vstack([live[live[:, 5] > n[e]], *ready])
        fit = live[:, 4] + (q[e] - live[:, 3]) - (s[e] - live[:, 2]) ** 2 / (n[e] - live[:, 1])
        best = int(np.argmin(fit))
        cost, before[e] = fit[best] + gamma, live[best, 0]
        worse = (fit > cost) & (live[:, 0] > 0)
        live[worse, 5] = np.minimum(live[worse, 5], n[e] + kmin)
        waiting.append(np.array([base + e + 1, n[e], s[e], q[e], cost, np.inf]))
    if len(n):
        starts.end = np.array([base + len(n), n[-1], s[-1], q[-1]])
    starts.live, starts.waiting = live, np.array(waiting).reshape(-1, len(_ROW))
    return before


def trace(before: np.ndarray, first: int, end: int) -> tuple[list[int], int]:
    """Ends of segments in a part whose first block is number ``first`` (1-based), from ``end`` back, and the end that lies before the part."""
    out = []
    while end >= first:
        out.append(end)
        end = int(before[end - first])
    return out, end


def optimal_breaks(count, total, squares, kmin: int, gamma: float) -> np.ndarray:
    """Last block (1-based) of each segment of the cheapest partition, left to right."""
    before = advance(Starts(), count, total, squares, kmin, gamma)
    return np.array(trace(before, 1, len(before))[0][::-1], dtype=np.int64)


def fit_blocks(count, total, squares, kmin: int, gamma: float) -> tuple[np.ndarray, np.ndarray]:
    """(segment number, segment mean) of every block."""
    ends = optimal_breaks(count, total, squares, kmin, gamma)
    size = np.diff(np.r_[0, ends])
    seg = np.repeat(np.arange(len(ends)), size)
    mean = np.bincount(seg, total) / np.bincount(seg, count) if len(ends) else np.zeros(0)
    return seg, mean[seg]
