"""Embedding near-duplicates through a pivot-permutation index.

Every vector is described by its ``NEAREST`` most similar reference vectors (pivots). Two vectors are
candidates when they have at least two pivots in common, so the inverted lists are kept by pairs of pivots;
candidates are verified by their cosine in double precision. Pivots are drawn by hash, ``PIVOTS`` times the root
of the number of vectors and ``MOST_PIVOTS`` at most, without those more similar than ``APART`` to an earlier one (pivots
out of one group of near copies would order its members at random). Where fewer than ``2 * NEAREST - 2`` are left, the
drawn vectors farthest from the chosen ones are added: with so few pivots any two vectors have two of their nearest in
common, so all pairs are candidates. Vectors are compared with those of their own length; a length of at most
``FEW_VECTORS`` vectors is compared in one piece, every other has an index of its own. Every vector is indexed and every
list is searched whole. A list longer than ``BLOCK`` is cut into blocks and every pair of blocks is a unit of its own, so
no task holds a long list. A pair is counted in the list of its two least common pivots only, and a unit
puts out counts and a spanning forest of its links, never the pairs.

Equal vectors are one class: they link with each other without a search, unless they link with nothing.
Vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing (n_links 0, own component). Null ids take part and never name a component
while another id is in it. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import save
from baflow.llm.graph import components

THRESHOLD = 0.95
PIVOTS = 2.0
MOST_PIVOTS = 1024
APART = 0.8
NEAREST = 5
FEW_VECTORS = 1000
BLOCK = 256
UNIT_ROWS = 20_000


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype("f8").reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric boolean matrix, each tree grown from its first row."""
    open_rows = linked.any(axis=1)
    src, dst = [], []
    while open_rows.any():
        front = np.array([int(np.argmax(open_rows))])
        open_rows[front] = False
        while len(front):
            reach = linked[front] & open_rows
            new = np.flatnonzero(reach.any(axis=0))
            src.append(front[reach[:, new].argmax(axis=0)])
            dst.append(new)
            open_rows[new] = False
            front = new
    return (np.concatenate(src), np.concatenate(dst)) if src else (np.zeros(0, "i8"), np.zeros(0, "i8"))


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, classes): rows (vec_id, cls or null), classes (cls, embedding, copies, low)."""
    e = F.col("embedding")
    sound = e.isNotNull() & (F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.when(sound & F.exists(e, lambda x: x != 0), e).alias("embedding"))
    rows = rows.select("vec_id", "embedding", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding", F.lit(3))).alias("cls"))
    found = rows.where("cls is not null").groupBy("cls").agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    return rows.select("vec_id", "cls"), save(found, "vectors")


def choose(drawn: np.ndarray, m: int, nearest: int = NEAREST) -> np.ndarray:
    """At most ``m`` pivots out of unit vectors: in their order those apart from earlier ones, then the farthest up to the floor."""
    taken = [0]
    most = drawn @ drawn[0]                              # similarity to the most similar pivot
    for k in range(1, len(drawn)):
        if len(taken) < m and most[k] < APART:
            taken.append(k)
            most = np.maximum(most, drawn @ drawn[k])
    most[taken] = np.inf
    while len(taken) < min(2 * nearest - 2, len(drawn)):
        k = int(np.argmin(most))
        taken.append(k)
        most = np.maximum(most, drawn @ drawn[k])
        most[taken] = np.inf
    return drawn[taken]


def links(found: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST,
          pivots: float = PIVOTS, most: int = MOST_PIVOTS) -> DataFrame:
    """(cls, other, n): link counts (other null) and edges (n null) of the classes, length by length."""
    sized = found.withColumn("dim", F.size("embedding"))
    sizes = sized.groupBy("dim").count().where("count > 1").orderBy(F.desc("count"), "dim").collect()
    large = [r["dim"] for k, r in enumerate(sizes) if k == 0 or r["count"] > FEW_VECTORS]
    out = found.sparkSession.createDataFrame([], "cls long, other long, n long")
    for dim in large:
        out = out.union(indexed(sized.where(F.col("dim") == dim).drop("dim"), threshold, nearest, pivots, most))
    small = [r["dim"] for r in sizes if r["dim"] not in large]
    if small:
        out = out.union(compared(sized.where(F.col("dim").isin(small)), threshold))
    return out


def compared(sized: DataFrame, threshold: float) -> DataFrame:
    """Like ``indexed`` for lengths (column dim) of ``FEW_VECTORS`` vectors at most: all pairs of a length."""

    def search(key, table):
        t = table.combine_chunks()
        cls, copies = (t.column(c).to_numpy() for c in ("cls", "copies"))
        x = _matrix(t.column("embedding").chunk(0), key[0].as_py())
        linked = x @ x.T >= threshold
        np.fill_diagonal(linked, False)
        src, dst = _forest(linked)
        n = linked @ copies
        some = np.flatnonzero(n)
        edge = np.arange(len(src) + len(some)) < len(src)
        return pa.table({"cls": np.concatenate([cls[src], cls[some]]),
                         "other": pa.array(np.concatenate([cls[dst], some]).astype("i8"), mask=~edge),
                         "n": pa.array(np.concatenate([src, n[some]]).astype("i8"), mask=edge)})

    return sized.select("dim", "cls", "embedding", "copies").groupBy("dim").applyInArrow(search, "cls long, other long, n long")


def indexed(found: DataFrame, threshold: float = THRESHOLD, nearest: int = NEAREST,
            pivots: float = PIVOTS, most: int = MOST_PIVOTS) -> DataFrame:
    """(cls, other, n): link counts (other null) and edges (n null) of classes of one length, by the index."""
    spark = found.sparkSession
    total = found.count()
    m = int(min(most, max(32, pivots * total ** 0.5)))
    drawn = found.orderBy(F.xxhash64("cls", F.lit(11))).select("embedding").limit(2 * m).collect()
    if total < 2:
        return spark.createDataFrame([], "cls long, other long, n long")
    dim = len(drawn[0]["embedding"])
    chosen = choose(_matrix(pa.array([r["embedding"] for r in drawn]), dim), m, nearest)
    ref = spark.sparkContext.broadcast(chosen)           # MOST_PIVOTS rows at most
    k, width = min(nearest, len(chosen)), len(chosen)

    def describe(batches):
        for b in batches:
            if b.num_rows:
                sim = _matrix(b.column("embedding"), dim) @ ref.value.T
                near = np.sort(np.argpartition(-sim, k - 1, axis=1)[:, :k], axis=1).astype("i4")
                a, c = np.triu_indices(k, 1)
                keys = near[:, a].astype("i8") * width + near[:, c]
                yield pa.RecordBatch.from_arrays(
                    [b.column("cls"), b.column("embedding"), b.column("copies"), pa.array(list(near), pa.list_(pa.int32())),
                     pa.array(list(keys), pa.list_(pa.int64()))], names=["cls", "embedding", "copies", "near", "keys"])

    kind = found.schema["embedding"].dataType.simpleString()
    told = save(found.select("cls", "embedding", "copies").mapInArrow(
        describe, f"cls long, embedding {kind}, copies long, near array<int>, keys array<long>"), "pivots")
    posts = told.select("cls", F.explode("keys").alias("key"))
    lists = posts.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    units = posts.join(lists, "key").withColumn("blocks", blocks).withColumn("mine", mine).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cls", "key", "mine", F.least("mine", "turn").alias("i"), F.greatest("mine", "turn").alias("j"))
    n_slots = max(1, -(-lists.agg(F.sum(F.col("size") * F.ceil(F.col("size") / BLOCK))).first()[0] // UNIT_ROWS)) \
        if lists.limit(1).count() else 1
    placed = units.withColumn("slot", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_slots)))
    full = placed.join(told.drop("keys"), "cls")

    def search(table):
        t = table.combine_chunks()
        key, i, j, mine, cls, copies = (t.column(c).to_numpy() for c in ("key", "i", "j", "mine", "cls", "copies"))
        x = _matrix(t.column("embedding").chunk(0), dim)
        near = t.column("near").chunk(0).flatten().to_numpy().reshape(-1, k)
        order = np.lexsort((cls, mine, j, i, key))
        cut = np.flatnonzero(np.r_[True, (np.diff(key[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0), True])
        out = {c: [] for c in ("cls", "other", "n")}
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            r = order[lo:hi]
            linked = x[r] @ x[r].T >= threshold
            np.fill_diagonal(linked, False)
            if i[r[0]] != j[r[0]]:                     # a unit of two blocks: only pairs across them
                linked &= mine[r][:, None] != mine[r][None, :]
            if not linked.any():
                continue
            src, dst = _forest(linked)
            out["cls"].append(cls[r[src]])
            out["other"].append(cls[r[dst]])
            out["n"].append(np.full(len(src), -1))
            p, q = divmod(int(key[r[0]]), width)       # the pair counts here if no lesser pivot is shared
            lesser = np.where((near[r] < q) & (near[r] != p), near[r], -1)
            names = np.unique(lesser[lesser >= 0])
            if len(names):
                has = np.zeros((len(r), len(names)), "f4")
                a, b = np.nonzero(lesser >= 0)
                has[a, np.searchsorted(names, lesser[a, b])] = 1
                linked &= has @ has.T == 0
            n = linked @ copies[r]
            some = np.flatnonzero(n)
            out["cls"].append(cls[r[some]])
            out["other"].append(np.zeros(len(some), "i8"))
            out["n"].append(n[some])
        a, b, n = (np.concatenate([*out[c], np.zeros(0, "i8")]).astype("i8") for c in ("cls", "other", "n"))
        edge = n < 0
        return pa.table({"cls": a, "other": pa.array(b, mask=~edge), "n": pa.array(n, mask=edge)})

    return full.groupBy("slot").applyInArrow(search, "cls long, other long, n long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    rows, found = classes(vectors)
    told = save(links(found, threshold), "links")
    counts = told.where("n is not null").groupBy("cls").agg(F.sum("n").alias("n"))
    roots = components(told.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    known = found.select("cls", "copies", "low").join(roots, found["cls"] == roots["node"], "left").select(
        "cls", "copies", "low", F.coalesce("root", "cls").alias("root"))
    least = known.groupBy("root").agg(F.min("low").alias("component_id"))
    named = known.join(least, "root").join(counts, "cls", "left").select(
        "cls", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    alone = F.col("cls").isNull()
    # rows without a class keep to themselves; their join keys are spread
    out = rows.withColumn("_key", F.coalesce("cls", F.xxhash64("vec_id"))).join(
        named.withColumnRenamed("cls", "_cls"), F.col("_key") == F.col("_cls"), "left").select(
        "vec_id", F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
