"""Jaccard join of word-shingle sets through count vectors, with connected components of the links.

The method: the distinct shingles of a document are hashed into ``GROUPS`` groups; the counts per group are
a point. The overlap of two sets is at most the sum of the coordinate minima of their points, so a tree of
points with coordinate maxima per page finds the pairs that can reach the threshold; these are verified
on the whole sets. A tree over all documents would compare each document with a constant share of the
corpus (points of equal size lie close in every coordinate), so documents are first routed exactly:

1. ``profiles``: size and fingerprint of each document's set; equal sets are one *class* from here on. In the
   same pass every shingle is counted into ``BUCKETS`` buckets (a fixed size), over all documents.
2. ``prefixes``: with the shingles in a common order (rare buckets first), two sets that link share one of
   their first ``n - ceil(t n) + 1`` shingles. Each class sends its class id to those.
3. ``routes``: each shingle with two or more classes names one of them, by a hash that differs from shingle
   to shingle, as its star. Pairs (class, star) that pass size and count bound are verified; components follow.
4. ``residue``: shingles whose classes are not all in one component are taken up again: a count-vector tree
   per shingle finds the pairs of different components that pass the bound, each pair at its least common
   shingle only, and these are verified too. No pair is listed within a component that is already known.

The result is exact up to collisions of 64-bit hashes. Null, empty and word-less texts have size 0 and
link with nothing. Repeated rows fall in one class. Null ids join a class but never name a component while
a non-null id is in it. An empty table gives an empty result. Very long texts are one set like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baflow.llm.common import map_texts, save, slices
from baflow.llm.graph import components
from baflow.llm.words import mix, shingle_sets

WORDS = 4
THRESHOLD = (85, 100)
GROUPS = 128
FULL = 65535                      # a group count that stands for itself or more
SLICE = 2_000_000
BUCKETS = 1 << 20
CHUNK = 1 << 14
HOT_ROUTE = 100_000
PAGE = 32
PROBE = 1024
SEND_ROWS = 1_000_000


def _long(x: np.ndarray) -> np.ndarray:
    return x.view("i8")


def _fingerprint(s: np.ndarray) -> int:
    """A 64-bit number for a set: a sum over its mixed shingles, mixed with its size."""
    with np.errstate(over="ignore"):
        total = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype="u8") + np.uint64(len(s))
        return int(mix(np.array([total], "u8")).view("i8")[0])


def _group_counts(s: np.ndarray) -> np.ndarray:
    return np.minimum(np.bincount((s & np.uint64(GROUPS - 1)).astype("i8"), minlength=GROUPS), FULL).astype("<u2")


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype("i8")


def profiles(docs: DataFrame, words: int = WORDS) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, n, fp) of every row, and the bucket counts of the shingles of all rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "fp", "chunk", "counts"]
        total, ids = np.zeros(BUCKETS, "i8"), None
        for b in slices(batches, "text", SLICE):
            sets, ids = shingle_sets(b.column("text"), words), b.column("doc_id")
            total += np.bincount(_bucket(np.concatenate(sets)), minlength=BUCKETS)
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array([_fingerprint(s) for s in sets], pa.int64()),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        if ids is not None:
            parts = total.astype("<u4").reshape(-1, CHUNK)
            at = np.flatnonzero(parts.any(axis=1))
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(at.astype("i4")),
                 pa.array([parts[k].tobytes() for k in at], pa.binary())], names=names)

    both = save(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, n long, fp long, chunk int, counts binary"), "profiles")

    def add(key, table):
        total = np.zeros(CHUNK, "u4")
        for c in table.column("counts").to_pylist():
            total += np.frombuffer(c, "<u4")
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    counts = np.zeros((BUCKETS // CHUNK, CHUNK), "u4")
    sums = both.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInArrow(
        add, "chunk int, counts binary")
    for r in sums.collect():                          # BUCKETS numbers, however large the input
        counts[r["chunk"]] = np.frombuffer(r["counts"], "<u4")
    return both.where("chunk is null").select("doc_id", "n", "fp"), counts.reshape(-1)


def prefixes(docs: DataFrame, counts: np.ndarray, words: int, threshold: tuple[int, int]) -> DataFrame:
    """(fp, n, groups, route: array of (shingle, salt)): one row per class."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)     # BUCKETS numbers
    num, den = threshold

    def run(b):
        sets, c = shingle_sets(b.column("text"), words), shared.value
        fp, n, groups, tokens, salts = [], [], [], [], []
        for s in sets:
            m = len(s)
            df = c[_bucket(s)].astype("u8")
            key = (np.minimum(df, np.uint64((1 << 20) - 1)) << np.uint64(44)) | (s >> np.uint64(20))
            first = np.argsort(key, kind="stable")[:m + (num * -m) // den + 1] if m else np.zeros(0, "i8")
            f = _fingerprint(s)
            fp.append(f)
            n.append(m)
            groups.append(_group_counts(s).tobytes())
            tokens.append(_long(s[first]))
            # a shingle so common that its route would be one large task is dealt over several
            deal = df[first].astype("i8") // HOT_ROUTE
            salts.append(np.where(deal > 0, 1 + f % (1 + deal), 0).astype("i4"))
        return {"fp": np.array(fp, "i8"), "n": np.array(n, "i8"), "groups": groups, "tokens": tokens, "salts": salts}

    every = map_texts(docs, run, "fp long, n long, groups binary, tokens array<long>, salts array<int>", (), SLICE)
    return every.where("n > 0").dropDuplicates(["fp"])


def _overlap(g1, g2):
    """Most shingles in common by the group counts; without a bound where both stand for ``FULL`` or more."""
    least = np.minimum(g1, g2)
    return least.sum(axis=-1, dtype="i8") + np.where((least == FULL).any(axis=-1), 1 << 40, 0)


def _can_link(n1, n2, overlap, num: int, den: int):
    """Whether sets of sizes n1, n2 with at most ``overlap`` shingles in common can reach the threshold."""
    both = np.minimum(overlap, np.minimum(n1, n2))
    return den * both >= num * (n1 + n2 - both)


def bounded(pairs: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of classes that pass the size filter and the count-vector bound."""
    num, den = threshold
    one = classes.select(F.col("fp").alias("a"), F.col("n").alias("na"), F.col("groups").alias("ga"))
    two = classes.select(F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("groups").alias("gb"))
    wide = pairs.join(one, "a").join(two, "b").where(
        F.least("na", "nb") * den >= F.greatest("na", "nb") * num)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                g1, g2 = (np.frombuffer(b"".join(b.column(c).to_pylist()), "<u2").reshape(-1, GROUPS) for c in ("ga", "gb"))
                n1, n2 = (b.column(c).to_numpy() for c in ("na", "nb"))
                ok = _can_link(n1, n2, _overlap(g1, g2), num, den)
                yield b.select(["a", "b"]).filter(pa.array(ok))

    return wide.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, names: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose whole sets reach the threshold; sets are made again for the classes in ``pairs`` only."""
    num, den = threshold
    used = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).distinct()
    used = used.join(names, "fp").select("fp", F.col("any_id").alias("doc_id"))
    used = save(used.withColumnRenamed("doc_id", "_id"), "used")
    # a short list of ids is sent to the texts; a longer one meets them in a shuffle
    wanted = F.broadcast(used) if used.count() <= SEND_ROWS else used
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_id")))

    def make(b):
        sets = shingle_sets(b.column("text"), words)
        return {"is_it": [_fingerprint(s) == f for s, f in zip(sets, b.column("fp").to_pylist(), strict=True)],
                "items": [s.tobytes() for s in sets]}

    sets = save(map_texts(texts.select("fp", "text"), make, "is_it boolean, items binary", ("fp",), SLICE).where(
        "is_it").select("fp", "items").dropDuplicates(["fp"]), "sets")
    wide = pairs.join(sets.select(F.col("fp").alias("a"), F.col("items").alias("ia")), "a").join(
        sets.select(F.col("fp").alias("b"), F.col("items").alias("ib")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "ia", 8_000_000):
            ok = []
            for x, y in zip(b.column("ia").to_pylist(), b.column("ib").to_pylist(), strict=True):
                s, t = np.frombuffer(x, "u8"), np.frombuffer(y, "u8")
                both = np.concatenate([s, t])
                both.sort()
                ok.append(bool(_can_link(len(s), len(t), int((both[1:] == both[:-1]).sum()), num, den)))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return wide.select("a", "b", "ia", "ib").mapInArrow(run, "a long, b long")


class CountTree:
    """Pages of points in order of size, each with its largest size and coordinate maxima."""

    def __init__(self, n: np.ndarray, groups: np.ndarray, comp: np.ndarray):
        self.order = np.lexsort((comp, n))
        self.n, self.groups, self.comp = n[self.order], groups[self.order], comp[self.order]
        self.first = np.arange(0, len(n), PAGE)
        self.low, self.top = self.n[self.first], np.maximum.reduceat(self.n, self.first)
        self.most = np.maximum.reduceat(self.groups, self.first, axis=0)
        same = np.minimum.reduceat(self.comp, self.first) == np.maximum.reduceat(self.comp, self.first)
        self.only = np.where(same, self.comp[self.first], -1)
        self.mixed = ~same

    def search(self, k: int, num: int, den: int) -> np.ndarray:
        """Points after ``k`` in the tree's order, of another component, that pass size and count bound."""
        n, g, c = self.n[k], self.groups[k], self.comp[k]
        page = np.flatnonzero((self.first + PAGE > k + 1) & (self.low * num <= n * den) & (self.mixed | (self.only != c)))
        # all sizes behind k are n or more; a page's overlap with it is at most the sum of the minima
        cover = _overlap(self.most[page], g)
        page = page[_can_link(n, np.maximum(n, self.low[page]), cover, num, den)]
        if not len(page):
            return page
        at = (self.first[page][:, None] + np.arange(PAGE)).reshape(-1)
        at = at[(at > k) & (at < len(self.n))]
        at = at[(self.comp[at] != c) & (self.n[at] * num <= n * den)]
        cover = _overlap(self.groups[at], g)
        return at[_can_link(n, self.n[at], cover, num, den)]


def residue(routes: DataFrame, roots: DataFrame, classes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs of classes of different components that share a route and pass the bound, each listed once."""
    num, den = threshold
    rooted = routes.select("token", "fp").join(roots, F.col("fp") == F.col("node"), "left").select(
        "token", "fp", F.coalesce("root", "fp").alias("root"))
    # a route with several components stays; routes with the same members count once
    kept = rooted.groupBy("token").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("fp")).alias("who"), F.bit_xor(F.xxhash64(F.lit(1), "fp")).alias("who2")).where("lo <> hi")
    kept = kept.groupBy("who", "who2", "size").agg(F.min("token").alias("token"))
    open_routes = save(rooted.join(kept.select("token", "size"), "token"), "residue")
    mine = open_routes.groupBy("fp").agg(F.array_sort(F.collect_set("token")).alias("mine"))
    full = open_routes.join(mine, "fp").join(classes.select("fp", "n", "groups"), "fp")
    # a large route goes whole to several tasks, each of which probes with its share of the members
    full = full.withColumn("turn", F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / PROBE).cast("int"))))
    slots = 8 * int(rooted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slot = F.when(F.col("size") > PROBE, F.xxhash64("token", "turn")).otherwise(F.pmod(F.xxhash64("token"), F.lit(slots)))

    def run(table):
        a, b = [], []
        token, turn = table.column("token").to_numpy(), table.column("turn").to_numpy()
        order = np.lexsort((turn, token))
        cut = np.flatnonzero(np.r_[True, (np.diff(token[order]) != 0) | (np.diff(turn[order]) != 0), True])
        fp, n, root = (table.column(c).to_numpy() for c in ("fp", "n", "root"))
        groups = np.frombuffer(b"".join(table.column("groups").to_pylist()), "<u2").reshape(-1, GROUPS)
        tokens = [set(x) for x in table.column("mine").to_pylist()]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            rows = order[lo:hi]
            rows = rows[np.argsort(fp[rows], kind="stable")]
            tree = CountTree(n[rows], groups[rows], root[rows])
            here, share = int(token[rows[0]]), int(turn[rows[0]])
            for k in range(share, len(rows), max(1, -(-len(rows) // PROBE))):
                x = rows[tree.order[k]]
                for y in rows[tree.order[tree.search(k, num, den)]]:
                    if min(tokens[x] & tokens[y]) == here:
                        a.append(min(fp[x], fp[y]))
                        b.append(max(fp[x], fp[y]))
        return pa.table({"a": pa.array(np.array(a, "i8")), "b": pa.array(np.array(b, "i8"))})

    return full.withColumn("slot", slot).groupBy("slot").applyInArrow(run, "a long, b long")


def join_components(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row of ``docs``."""
    prof, counts = profiles(docs, words)
    names = save(prof.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("any_id")), "names")
    rows = save(prefixes(docs, counts, words, threshold), "prefixes")
    points = rows.select("fp", "n", "groups")
    post = rows.select("fp", F.explode(F.arrays_zip("tokens", "salts")).alias("r")).select(
        "fp", F.col("r.tokens").alias("token"), F.col("r.salts").alias("salt"))
    # the star of a route is the class whose id, scrambled by the shingle, is least
    star = F.col("fp").bitwiseXOR(F.col("token"))
    w = Window.partitionBy("token", "salt")
    local = post.select("fp", "token", "salt", F.min(star).over(w).alias("key"), F.count("*").over(w).alias("size"))
    top = Window.partitionBy("token")
    routes = save(local.where("size > 1 or salt > 0").select(
        "fp", "token", "salt", F.col("key").bitwiseXOR(F.col("token")).alias("star")), "routes")
    # where a route was dealt over several salts, their stars meet in one more step
    salted = routes.where("salt > 0").select("token").distinct()
    stars = routes.join(salted, "token", "left_semi").select("token", "star").distinct()
    meet = stars.select("token", "star", F.min(F.col("star").bitwiseXOR(F.col("token"))).over(top).alias("key")).select(
        "star", F.col("key").bitwiseXOR(F.col("token")).alias("first"))
    edges = routes.select(F.col("star").alias("a"), F.col("fp").alias("b")).union(meet.select("first", "star"))
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = save(verified(save(bounded(edges, points, threshold), "pairs"), docs, names, words, threshold), "links")
    roots = components(links)
    rest = save(residue(routes, roots, points, threshold), "pairs")
    more = verified(rest, docs, names, words, threshold)
    merged = more.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left").join(
        roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    tops = components(merged)
    final = names.join(roots, names["fp"] == roots["node"], "left").select(
        "fp", "any_id", F.coalesce("root", "fp").alias("root"))
    final = final.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "fp", "any_id", F.coalesce("top", "root").alias("root"))
    least = final.groupBy("root").agg(F.min("any_id").alias("component_id"))
    named = save(final.join(least, "root").select("fp", "root", "component_id"), "components")
    # documents without shingles keep to themselves; their keys are spread
    key = F.when(F.col("n") > 0, F.col("fp")).otherwise(F.xxhash64("doc_id"))
    return prof.withColumn("fp", key).join(named, "fp", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("fp").alias("class_id"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = WORDS, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each component, the one of least id; columns and order of columns stay.

    Documents without shingles and documents without an id stay. Rows that repeat id and text count as one.
    """
    found = join_components(docs, words, threshold).where(
        "doc_id is null or n_shingles = 0 or doc_id = component_id").select("doc_id").distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["doc_id"]), "left_semi").dropDuplicates(["doc_id", "text"])
