"""Language-model scoring by deleted interpolation of bigram and unigram estimates.

Tokens are the words of a text (A-Z as a-z) and one end token. The model mixes the maximum-likelihood estimate
of a token after its predecessor with the smoothed unigram estimate; the weight depends on how often the
predecessor was seen (a power of two of its count) and is learned by expectation-maximisation on held-out
counts: one in ``HELD`` training documents is deleted from the counts for that, and the final model counts all.

Spark plan. Documents are dealt by hash into blocks of about ``BLOCK_BYTES`` of text. A block sends each of its
distinct n-grams (64-bit hashes, with its own counts) to the bucket of the n-gram; a bucket adds up and returns the
corpus counts in the order in which the block sent its n-grams. The block, made again from the same
documents, then holds all counts it needs. So what moves is one entry per distinct n-gram and block, a frequent
n-gram comes in as many entries as there are blocks, and no n-gram table is ever in one place. The held-out
evidence reaches the driver as a histogram of fixed size.

Null texts are empty texts: one end token. Repeated rows count as often as they occur. Null ids hash like
an empty id. Without training documents both scores are those of the empty model (0 counts). An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.llm.common import hash_share, save
from baflow.llm.words import mix, word_hashes

BLOCK_BYTES = 8_000_000
HELD = 16
LEVELS = 40                       # buckets of context frequency: powers of two
RATIO_STEP, RATIO_LOW, RATIO_BINS = 0.125, -24.0, 720
END, START = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane: sorted or small ones then compress well."""
    return x.view("u1").reshape(len(x), x.itemsize).T.tobytes()


def _unplanes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, "u1").reshape(size, -1).T.copy().view(kind).ravel()


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every token, hash of the token before it, first token of every text and one past the last)."""
    h, first, _ = word_hashes(texts)
    n = len(first) - 1
    size = np.diff(first) + 1
    start = np.concatenate([[0], size.cumsum()])
    out = np.empty(len(h) + n, "u8")
    is_end = np.zeros(len(out), bool)
    is_end[start[1:] - 1] = True
    out[~is_end], out[is_end] = h, END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[start[:-1]] = START
    return out, before, start


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct keys, index of each key among them)."""
    order = np.argsort(key)
    key = key[order]
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    index = np.empty(len(key), "<i4")
    index[order] = new.cumsum(dtype="i4") - 1
    return key[new], index


def _grams(texts: pa.Array):
    """For unigrams and bigrams: (sorted distinct keys, index of each token's key); and the texts' starts."""
    t, before, start = tokens(texts)
    with np.errstate(over="ignore"):
        one = _distinct(mix(t + np.uint64(1)))
        before = mix(before)
        before *= np.uint64(3)
        before += t
        del t
        return [one, _distinct(mix(before))], start


def _add(index: np.ndarray, size: int, weight: np.ndarray) -> np.ndarray:
    return np.bincount(index, weight, size).astype("<u4")


def _buffers(table: pa.Table, column: str) -> list[pa.Buffer]:
    """The values of a binary column where they lie, without a copy."""
    return [x.as_buffer() for x in table.column(column)]


def _count(docs: DataFrame, bits: int) -> DataFrame:
    """One row per block, n-gram order and bucket: what the block sends to the bucket."""

    def run(key, table):
        table = table.combine_chunks()
        text = table.column("text").combine_chunks() if table.num_rows else pa.array([], pa.string())
        grams, start = _grams(text)
        size = np.diff(start)
        learn, held = (np.repeat(table.column(c).to_numpy(zero_copy_only=False).astype(bool), size) for c in ("learn", "held"))
        block, out = key[0].as_py(), {c: [] for c in ("block", "kind", "bucket", "keys", "kept", "held")}

        def put(*row):
            for c, v in zip(out, row, strict=True):
                out[c].append(v)

        for kind, (keys, index) in enumerate(grams, 1):
            kept, deleted = _add(index, len(keys), learn & ~held), _add(index, len(keys), learn & held)
            bucket = (keys >> np.uint64(64 - bits)).astype("i8") if bits else np.zeros(len(keys), "i8")
            cut = np.flatnonzero(np.r_[True, np.diff(bucket) != 0, True])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                put(block, kind, int(bucket[a]), _planes(keys[a:b]), _planes(kept[a:b]), _planes(deleted[a:b]))
        # the deleted tokens: indices of the token, of the one before it (-1 at a start) and of the bigram
        at = np.flatnonzero(learn & held)
        if len(at):
            one, two = grams[0][1].astype("<i4"), grams[1][1].astype("<i4")
            prev = np.r_[np.int32(-1), one[:-1]].astype("<i4")
            prev[start[:-1]] = -1
            put(block, 0, block % (1 << bits), _planes(one[at]), _planes(prev[at]), _planes(two[at]))
        return pa.table([pa.array(out[c], t) for c, t in zip(out, (
            pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=list(out))

    return docs.select("block", "text", "learn", "held").groupBy("block").applyInArrow(
        run, "block long, kind int, bucket long, keys binary, kept binary, held binary")


def _merge(sent: DataFrame) -> DataFrame:
    """Corpus counts for what every block sent, in its order; kind -1 rows hold the bucket's totals."""

    def run(key, table):
        out = {c: [] for c in ("block", "kind", "bucket", "a", "b", "c")}

        def put(*row):
            for c, v in zip(out, row, strict=True):
                out[c].append(v)

        block, kinds, bucket = (table.column(c).to_pylist() for c in ("block", "kind", "bucket"))
        raw = {c: _buffers(table, c) for c in ("keys", "kept", "held")}
        for k, kind in enumerate(kinds):
            if kind == 0:
                put(block[k], 0, bucket[k], *(raw[c][k].to_pybytes() for c in ("keys", "kept", "held")))
        for kind in (1, 2):
            mine = [k for k, x in enumerate(kinds) if x == kind]
            if not mine:
                continue
            size = [raw["keys"][k].size // 8 for k in mine]
            every, index = _distinct(np.concatenate([_unplanes(raw["keys"][k], "<u8") for k in mine]))
            kept, held = (_add(index, len(every), np.concatenate([_unplanes(raw[c][k], "<u4") for k in mine]))
                          for c in ("kept", "held"))
            at, both = 0, kept + held
            for k, n in zip(mine, size, strict=True):
                part = index[at:at + n]
                at += n
                put(block[k], kind, bucket[k], _planes(both[part]), _planes(kept[part]), b"")
            if kind == 1:
                totals = np.array([both.sum(dtype="i8"), (both > 0).sum(), kept.sum(dtype="i8"), (kept > 0).sum()], "<i8")
                put(-1, -1, key[0].as_py(), totals.tobytes(), b"", b"")
        return pa.table([pa.array(out[c], t) for c, t in zip(out, (
            pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=list(out))

    return sent.groupBy("bucket").applyInArrow(run, "block long, kind int, bucket long, a binary, b binary, c binary")


def _values(rows: list[dict], kind: int, column: str) -> np.ndarray:
    """A block's counts of one order, in the order of its sorted keys."""
    mine = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["bucket"])
    return np.concatenate([np.zeros(0, "<u4"), *(_unplanes(r[column], "<u4") for r in mine)]).astype("f8")


def _level(count: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(count, 1)).astype("i8")


def _evidence(counted: DataFrame, total: float, distinct: float, starts: int) -> np.ndarray:
    """Histogram over the deleted tokens: by context level, of log2(bigram estimate / unigram estimate)."""

    def run(key, table):
        rows = table.to_pylist()
        hist = np.zeros((LEVELS, RATIO_BINS + 1))
        uni, bi = _values(rows, 1, "b"), _values(rows, 2, "b")
        for r in rows:
            if r["kind"] == 0:
                w, h, g = (_unplanes(r[c], "<i4") for c in ("a", "b", "c"))
                context = np.where(h >= 0, uni[np.maximum(h, 0)], starts)
                ok = context > 0
                ratio = bi[g[ok]] / context[ok] / ((uni[w[ok]] + 0.5) / (total + 0.5 * (distinct + 1)))
                some = ratio > 0
                place = np.zeros(len(ratio), "i8")       # column 0: the bigram was not seen
                place[some] = 1 + np.clip((np.log2(ratio[some]) - RATIO_LOW) / RATIO_STEP, 0, RATIO_BINS - 1).astype("i8")
                np.add.at(hist, (_level(context[ok]), place), 1)
        a, b = np.nonzero(hist)
        return pa.table({"level": a, "place": b, "n": hist[a, b]})

    got = counted.where("kind >= 0").groupBy("block").applyInArrow(run, "level long, place long, n double").groupBy(
        "level", "place").agg(F.sum("n").alias("n")).collect()            # LEVELS x RATIO_BINS rows at most
    hist = np.zeros((LEVELS, RATIO_BINS + 1))
    for r in got:
        hist[r["level"], r["place"]] = r["n"]
    return hist


def learn_weights(hist: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weight of the bigram estimate per context level, by expectation-maximisation."""
    ratio = np.r_[0.0, 2.0 ** (RATIO_LOW + RATIO_STEP * (np.arange(RATIO_BINS) + 0.5))]
    out, last = np.zeros(len(hist)), 0.3
    for k, n in enumerate(hist):
        if n.sum() >= 20:
            w = 0.5
            for _ in range(rounds):
                w = float((n * (w * ratio / (w * ratio + 1 - w))).sum() / n.sum())
                w = min(max(w, 1e-6), 1 - 1e-6)
            last = w
        out[k] = last                      # levels without evidence take that of the level below
    return out


def score(docs: DataFrame, may_learn: Column, keep: tuple[str, ...] = ("doc_id",), held: int = HELD,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of every row, n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    rows = docs.select(*keep, text.alias("text"), may_learn.alias("learn"))
    rows = rows.withColumn("held", F.col("learn") & hash_share(1 / held, *keep, seed=29))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n"), F.count_if("learn").alias("l"),
                    F.count_if(F.col("learn") & ~F.col("held")).alias("k")).first()
    blocks = max(1, -(-(size["n"] or 0) // block_bytes))
    bits = max(0, int(blocks).bit_length() - 1)
    rows = rows.withColumn("block", F.pmod(F.xxhash64(*keep, F.octet_length("text")), F.lit(blocks)))
    counted = save(_merge(_count(rows, bits)), "counts")
    totals = np.zeros(4)
    for r in counted.where("kind = -1").select(F.expr("a")).toLocalIterator():       # four numbers per bucket
        totals += np.frombuffer(r["a"], "<i8")
    n, v, n_kept, v_kept = totals
    weights = learn_weights(_evidence(counted, n_kept, v_kept, size["k"]))
    learned = int(size["l"])

    def run(left, right):
        found = {r: [] for r in ("n_tokens", "n_known", "train_tokens", "base_score", "score")}
        if left.num_rows == 0:
            return pa.table({**{c: left.column(c) for c in keep}, **{c: pa.array([], pa.int64()) for c in list(found)[:3]},
                             **{c: pa.array([], pa.float64()) for c in list(found)[3:]}})
        counts = right.to_pylist()
        (g1, g2), start = _grams(left.column("text").combine_chunks())
        one, two = _values(counts, 1, "a")[g1[1]], _values(counts, 2, "a")[g2[1]]
        context = np.r_[0.0, one[:-1]]
        context[start[:-1]] = learned
        base = (one + 0.5) / (n + 0.5 * (v + 1))
        w = np.where(context > 0, weights[np.minimum(_level(context), LEVELS - 1)], 0.0)
        mixed = w * two / np.maximum(context, 1) + (1 - w) * base
        cols = [np.diff(start), np.add.reduceat(one > 0, start[:-1], dtype="i8"), np.full(len(start) - 1, int(n)),
                np.add.reduceat(np.log10(base), start[:-1]), np.add.reduceat(np.log10(mixed), start[:-1])]
        return pa.table([left.column(c) for c in keep] + [pa.array(c) for c in cols], names=[*keep, *found])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + \
        ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    back = counted.where("kind > 0").select("block", "kind", "bucket", "a")
    return rows.select("block", *keep, "text").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, schema)
