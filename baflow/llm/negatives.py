"""Exact hard-negative mining with lists shared by clusters of anchors.

Scores are inner products of integer vectors (``floor(scale * x)``). Anchors are clustered by direction; a cluster knows its centre and
the widest angle ``r`` from the centre to a member. For a candidate at angle ``a`` from the centre no member's score exceeds
``|member| * |candidate| * cos(max(0, a - r))``, so the candidates of a shard are sorted by ``|candidate| * cos(max(0, a - r))`` once for the
cluster, and every member walks that list until its own bound falls below what it still needs: the worst score of its full
lists, or the lower end of its band. That end is certified, so the result is exact, whatever the clusters look like.

Two walks: the first finds each anchor's ``POSITIVES`` best other rows of its label; the second finds, for each positive, the ``NEGATIVES``
best rows of another label with ``low * positive <= 100 * negative <= high * positive``. Before each a walk over ``SEED_ROWS`` rows, drawn by hash,
gives a score that each list reaches at least, so that the walks over all rows end early and put out little. Higher scores come first, ties by smaller id.

A row takes no part if its id, label or vector is null, or a component is null or not finite, or if its integer vector is as long
as ``2 ** 31`` (its scores need not fit a long). Other rows, of either label, are rows of another id. Repeated rows are listed as often as they occur;
a repeated anchor counts once. Vectors of different lengths are not compared. Zero and empty vectors score 0 with all others. An anchor
without a positive, and a positive without a row in its band (always so for a negative score), give no rows. Empty tables give an empty result.

Plan: anchors are processed in blocks of about ``BLOCK_ANCHORS``, whole clusters or hash parts of a large one. A block is collected, broadcast and
held against all rows in one scan of a table of (id, label, integers): no vector is shuffled, and a task holds one Arrow batch and
the block's lists. Only lists' entries (at most the list's length from each task) are shuffled; each block's result is appended to a table in
the shared folder. Centres are fitted on ``FIT_ANCHORS`` anchors at most; every anchor is assigned and every row is walked.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baflow.llm.common import hash_share, sample_rate, save
from baflow.session import checkpoint_dir

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK_ANCHORS = 4096
FIT_ANCHORS = 4000
CLUSTER_ANCHORS = 64      # members of a cluster that the number of centres aims at
MOST_CLUSTERS = 64        # for each vector length
SEED_ROWS = 4000
STEP = 1024               # candidates of a list that are scored at once
NONE = np.iinfo("i8").min
NEVER = np.iinfo("i8").max


def quantised(rows: DataFrame, anchor: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector, norm, anchor) of the rows that take part; ``anchor`` is a condition on the columns of ``rows``."""
    e = F.col("embedding")
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    told = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(e, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return told.withColumn("norm", norm).where(F.col("norm") < 2.0 ** 31).select(
        "vec_id", "label", F.transform("v", lambda x: x.cast("int")).alias("vector"), "norm", "anchor")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for each vector length of a batch."""
    col = batch.column("vector")
    flat, size = col.flatten().to_numpy(zero_copy_only=False), col.value_lengths().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        r = np.flatnonzero(size == d)
        yield d, r, flat[start[r][:, None] + np.arange(d)].astype("f8").reshape(len(r), d)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of ``k`` clusters of the rows of ``x``, by spherical k-means from evenly spaced rows."""
    u = _unit(x)
    c = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(rounds):
        near = np.argmax(u @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, u)
        c = np.where(np.linalg.norm(total, axis=1, keepdims=True) > 0, _unit(total), c)
    return c


class Cluster:
    """Members of one cluster in a block: places of their lists, vectors, and the cone that holds them."""

    def __init__(self, members: np.ndarray, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, centre: np.ndarray):
        self.members, self.ids, self.labels, self.x, self.centre = members, ids, labels, x, centre
        self.norm = np.linalg.norm(x, axis=1)
        self.radius = float(np.arccos(np.clip(_unit(x) @ centre, -1, 1)).max(initial=0.0)) + 1e-7


def shared_list(c: Cluster, x: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates in falling order of their bound for a member of length one, and the bounds."""
    angle = np.arccos(np.clip((x @ c.centre) / np.where(norm > 0, norm, 1), -1, 1))
    bound = norm * np.cos(np.maximum(0.0, angle - c.radius))
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b`` (integers held as doubles)."""
    if np.linalg.norm(a, axis=1).max(initial=0) * np.linalg.norm(b, axis=1).max(initial=0) < 2.0 ** 52:
        return (a @ b.T).astype("i8")
    return a.astype("i8") @ b.astype("i8").T


class Lists:
    """``n`` lists of the ``k`` best (score, id); ``need`` is the least score that still enters a list."""

    def __init__(self, n: int, k: int, least: np.ndarray):
        self.k, self.need = k, least.copy()
        self.score, self.id = np.full((n, k), NONE), np.zeros((n, k), "i8")

    def offer(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        held = np.unique(place)
        old, col = np.nonzero(self.score[held] != NONE)
        old = held[old]
        p, s, i = (np.concatenate(x) for x in ((old, place), (self.score[old, col], score), (self.id[old, col], ids)))
        order = np.lexsort((i, -s, p))
        p, s, i = p[order], s[order], i[order]
        head = np.flatnonzero(np.r_[True, np.diff(p) != 0])
        rank = np.arange(len(p)) - np.repeat(head, np.diff(np.r_[head, len(p)]))
        keep = rank < self.k
        self.score[p[keep], rank[keep]], self.id[p[keep], rank[keep]] = s[keep], i[keep]
        full = rank == self.k - 1
        self.need[p[full]] = np.maximum(self.need[p[full]], s[full])

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, id, score) of all lists."""
        place, col = np.nonzero(self.score != NONE)
        return place, self.id[place, col], self.score[place, col]


def walk(clusters: list[Cluster], lists: Lists, slots: int, same_label: bool, most: np.ndarray,
         ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> int:
    """Offer the rows of one shard to the lists ``member * slots + slot``; returns the number of scores computed.

    A row enters a list if its score is at least ``lists.need`` and at most ``most`` and its label is (not) the member's.
    """
    norm, done = np.linalg.norm(x, axis=1), 0
    for c in clusters:
        order, bound = shared_list(c, x, norm)
        mine = c.members[:, None] * slots + np.arange(slots)
        for lo in range(0, len(order), STEP):
            reach = c.norm * bound[lo]
            walking = np.flatnonzero(reach + 1e-6 * np.abs(reach) + 0.5 >= lists.need[mine].min(axis=1))
            if not len(walking):
                break
            r = order[lo:lo + STEP]
            got = products(c.x[walking], x[r])
            done += got.size
            fits = (c.ids[walking][:, None] != ids[r]) & ((c.labels[walking][:, None] == labels[r]) == same_label)
            a, b = np.nonzero(fits & (got >= lists.need[mine[walking]].min(axis=1)[:, None]))
            place, score = mine[walking[a]], got[a, b][:, None]
            fit, slot = np.nonzero((score >= lists.need[place]) & (score <= most[place]))
            lists.offer(place[fit, slot], score[fit, 0], ids[r[b[fit]]])
    return done


def search(table: DataFrame, clusters, least: np.ndarray, most: np.ndarray, slots: int, k: int, same_label: bool) -> DataFrame:
    """(place, rank, vec_id, score): the best ``k`` rows of ``table`` for every list, by walks of all its shards."""
    task = table.sparkSession.sparkContext.broadcast((clusters, least, most))

    def run(batches):
        by_length, low, high = task.value
        lists = Lists(len(low), k, low)
        for b in batches:
            ids, labels = (b.column(n).to_numpy() for n in ("vec_id", "label"))
            for d, r, x in _rows(b) if b.num_rows else ():
                if d in by_length:
                    walk(by_length[d], lists, slots, same_label, high, ids[r], labels[r], x)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in lists.entries()], names=["place", "vec_id", "score"])

    told = table.select("vec_id", "label", "vector").mapInArrow(run, "place long, vec_id long, score long")
    w = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    return told.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def reached(seeds: DataFrame, clusters, least: np.ndarray, most: np.ndarray, slots: int, k: int, same_label: bool) -> np.ndarray:
    """A score that every list reaches at least: its ``k``-th best among ``seeds``, else ``least``."""
    out = least.copy()
    for r in search(seeds, clusters, least, most, slots, k, same_label).where(F.col("rank") == k).select("place", "score").collect():
        out[r["place"]] = max(out[r["place"]], r["score"])
    return out


def blocks(anchors: DataFrame) -> tuple[DataFrame, dict[int, np.ndarray], list[list[tuple[int, int, int, int]]]]:
    """Anchors with their cluster, the centres by vector length, and the blocks as lists of (length, cluster, part, parts)."""
    sized = anchors.withColumn("dim", F.size("vector"))
    sizes = {r["dim"]: r["count"] for r in sized.groupBy("dim").count().collect()}
    middle = {}
    for dim, n in sizes.items():
        drawn = sized.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "vector")).select("vector").limit(FIT_ANCHORS).collect()
        x = np.array([r["vector"] for r in drawn], dtype="f8").reshape(len(drawn), dim)
        middle[dim] = centres(x, min(MOST_CLUSTERS, -(-len(x) // CLUSTER_ANCHORS)))
    told = anchors.sparkSession.sparkContext.broadcast(middle)           # MOST_CLUSTERS vectors for each length

    def run(batches):
        for b in batches:
            near = np.zeros(b.num_rows, "i4")
            for d, r, x in _rows(b) if b.num_rows else ():
                near[r] = np.argmax(_unit(x) @ told.value[d].T, axis=1)
            yield pa.RecordBatch.from_arrays([b.column(n) for n in ("vec_id", "label", "vector", "dim")] + [pa.array(near)],
                                             names=["vec_id", "label", "vector", "dim", "cluster"])

    assigned = save(sized.select("vec_id", "label", "vector", "dim").mapInArrow(
        run, "vec_id long, label long, vector array<int>, dim int, cluster int"), "anchors")
    out, room = [], 0
    for r in assigned.groupBy("dim", "cluster").count().orderBy("dim", "cluster").collect():
        parts = -(-r["count"] // BLOCK_ANCHORS)
        for part in range(parts):
            if r["count"] / parts > room:
                out.append([])
                room = BLOCK_ANCHORS
            out[-1].append((r["dim"], r["cluster"], part, parts))
            room -= r["count"] / parts
    return assigned, middle, out


def members(assigned: DataFrame, middle: dict[int, np.ndarray], block) -> tuple[np.ndarray, dict[int, list[Cluster]]]:
    """Ids of the anchors of a block by place, and its clusters by vector length."""
    wanted = F.lit(False)
    for dim, cluster, part, parts in block:
        wanted = wanted | ((F.col("dim") == dim) & (F.col("cluster") == cluster)
                           & (F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)) == part))
    rows = assigned.where(wanted).orderBy("dim", "cluster", "vec_id", "label", "vector").toArrow()
    ids, labels, dims, near = (rows.column(n).to_numpy() for n in ("vec_id", "label", "dim", "cluster"))
    vectors = rows.column("vector").combine_chunks()
    clusters: dict[int, list[Cluster]] = {}
    for dim, cluster in sorted({(b[0], b[1]) for b in block}):
        r = np.flatnonzero((dims == dim) & (near == cluster))
        if len(r):
            x = vectors.take(pa.array(r)).flatten().to_numpy().astype("f8").reshape(len(r), dim)
            clusters.setdefault(dim, []).append(Cluster(r, ids[r], labels[r], x, middle[dim][cluster]))
    return ids, clusters


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """Hard negatives (``SCHEMA``) of the rows of ``rows`` (vec_id, label, embedding) for which ``anchor`` holds."""
    spark = rows.sparkSession
    table = save(quantised(rows, anchor, scale), "vectors").drop("anchor")
    anchors = save(quantised(rows, anchor, scale).where("anchor").select("vec_id", "label", "vector").distinct(), "anchor-rows")
    seeds = save(table.where(hash_share(sample_rate(table.count(), SEED_ROWS), "vec_id")), "seeds")
    assigned, middle, plan = blocks(anchors)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-negatives-{uuid.uuid4().hex}"
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    for block in plan:
        ids, clusters = members(assigned, middle, block)
        least, most = np.full(len(ids), NONE), np.full(len(ids), NEVER)
        least = reached(seeds, clusters, least, most, 1, positives, True)
        best = search(table, clusters, least, most, 1, positives, True).collect()        # a few for each anchor of the block
        n = len(ids) * positives
        positive, score, least, most = np.zeros(n, "i8"), np.zeros(n, "i8"), np.full(n, NEVER), np.full(n, NONE)
        for r in best:
            at = r["place"] * positives + r["rank"] - 1
            positive[at], score[at] = r["vec_id"], r["score"]
            least[at], most[at] = -(-low * r["score"] // 100), high * r["score"] // 100
        least = np.where(least > most, NEVER, least)
        least = reached(seeds, clusters, least, most, positives, negatives, False)
        found = search(table, clusters, least, most, positives, negatives, False)
        lists = spark.createDataFrame([(k, int(ids[k // positives]), int(positive[k]), int(score[k])) for k in range(n)],
                                      "place long, anchor_id long, positive_id long, positive_score long")
        found.join(lists, "place").select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)
