"""Ordered-series operators over (group keys, order), in chunks (WN-02..11, SEG-01..06).

A *series* is the rows of one group (e.g. sample, chromosome, presegment) in position order. It may be larger
than a task: rows are numbered over range partitions, windows run on chunks of ``size`` rows with a halo as wide as the filter's
reach, running sums are chunk sums plus what lies before the chunk, and quantiles are found by refinement
(``chunks``, ``quantiles``). No window is wider than a chunk with its halo. The filters are differences of running sums in
which everything before the halo cancels, so they need no sum over the whole series.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from baflow.operators.chunks import CHUNK, null_safe, prefix_sums, ranked, windowed, with_halo
from baflow.operators.quantiles import grouped_quantiles
from baflow.session import cut_lineage, ship_package

# Fixed values of the mark filter (reference defaults).
L1, L2 = 8, 1          # half-widths of the two high-pass filters
THRES = 0.9            # local-maximum tolerance
MAD_SCALE = 1.4826     # consistency constant of the median absolute deviation
SD_FLOOR = 0.09        # lower bound of the noise estimate
RUNMED_HALF = 25       # running-median half width k (width 2k+1 = 51)
PEAK_HALF = 3          # half width of the rolling maximum


def index_series(df: DataFrame, keys, order) -> DataFrame:
    """Add ``rn`` (1-based row number in the series) and ``n`` (series length)."""
    return ranked(df, keys, order)


def differs(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Where two arrays differ; a null equals a null, a NaN a NaN."""
    ne = pc.fill_null(pc.not_equal(x, y), False)
    if pa.types.is_floating(x.type):
        ne = pc.and_not(ne, pc.fill_null(pc.and_(pc.is_nan(x), pc.is_nan(y)), False))
    return pc.or_(ne, pc.xor(pc.is_null(x), pc.is_null(y))).to_numpy(zero_copy_only=False)


def new_runs(batch: pa.RecordBatch, cols, last: list | None) -> tuple[np.ndarray, list]:
    """Rows of a batch whose ``cols`` differ from the row before (``last``: that row of the batch before), and its last row."""
    arrays, n = [batch.column(c) for c in cols], batch.num_rows
    new = np.zeros(n, bool)
    new[0] = last is None
    for k, a in enumerate(arrays):
        new[1:] |= differs(a.slice(1), a.slice(0, n - 1))
        new[0] = new[0] or differs(a.slice(0, 1), last[k])[0]
    return new, [a.slice(n - 1) for a in arrays]


def run_ids(df: DataFrame, keys, order, values, out: str, mean: tuple[str, str] | None = None, dealt: bool = False) -> DataFrame:
    """AG-06/AG-10: add ``out``, the 1-based number of the run of equal ``values`` in the series, and the mean of a column over the
    run (``mean``: column, output name).

    Runs are numbered while the sorted rows of a range partition pass by; one row per (keys, partition) joins them across partitions. So the points
    are shuffled once (not at all if ``dealt``: they already lie in ranges of keys and order) and written once. A task holds one run of its partition, for its mean.
    """
    keys, order, values = list(keys), list(order), list(values)
    ship_package(df.sparkSession)
    sort = [F.asc(c) for c in [*keys, *order]]
    rows = (df if dealt else df.repartitionByRange(*sort)).sortWithinPartitions(*sort)
    extra = [StructField("__part", IntegerType()), StructField("__run", LongType()), *([StructField(mean[1], DoubleType())] if mean else [])]
    names = [*df.columns, *[f.name for f in extra]]

    def told(b: pa.RecordBatch, run: np.ndarray, part: int) -> pa.RecordBatch:
        cols = [*b.columns, pa.array(np.full(len(run), part, "i4")), pa.array(run)]
        if mean:
            x = b.column(mean[0])
            k, seen = run - run[0], x.is_valid().to_numpy(zero_copy_only=False)
            value = pc.fill_null(x.cast(pa.float64()), 0.0).to_numpy(zero_copy_only=False)
            n = np.bincount(k, seen)
            with np.errstate(invalid="ignore"):
                cols.append(pa.array((np.bincount(k, value) / n)[k], pa.float64(), mask=n[k] == 0))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def number(batches):
        part, at, last, held = TaskContext.get().partitionId(), 0, None, []
        for b in batches:
            if b.num_rows == 0:
                continue
            new, last = new_runs(b, [*keys, *values], last)
            run = at + np.cumsum(new)
            at = int(run[-1])
            if not mean:
                yield told(b, run, part)
                continue
            held.append((b, run))
            if held[0][1][0] < at:                                  # runs before the last one are complete
                whole = pa.Table.from_batches([x for x, _ in held]).combine_chunks().to_batches()[0]
                runs = np.concatenate([r for _, r in held])
                k = int(np.searchsorted(runs, at))
                yield told(whole.slice(0, k), runs[:k], part)
                held = [(whole.slice(k), runs[k:])]
        if held:
            yield told(pa.Table.from_batches([x for x, _ in held]).combine_chunks().to_batches()[0], np.concatenate([r for _, r in held]), part)

    stored = cut_lineage(rows.mapInArrow(number, StructType([*df.schema.fields, *extra])))
    run = F.struct(*[F.col(v) for v in values])
    ends = stored.groupBy(*keys, "__part").agg(F.min("__run").alias("__low"), F.max("__run").alias("__high"),
                                               F.min_by(run, "__run").alias("__first"), F.max_by(run, "__run").alias("__last"))
    w = Window.partitionBy(*keys).orderBy("__part")                 # as long as a series has range partitions
    goes_on = F.lag("__last").over(w).eqNullSafe(F.col("__first")).cast("int")
    ends = ends.withColumn("__on", goes_on).withColumn("__own", F.col("__high") - F.col("__low") + 1)
    ahead = F.coalesce(F.sum("__own").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.sum("__on").over(w)
    ends = cut_lineage(ends.select(*keys, "__part", (ahead - F.col("__low") + 1).alias("__shift")))
    d = null_safe(stored, ends, [*keys, "__part"]).withColumn(out, F.col("__run") + F.col("__shift"))
    if mean:                                                        # runs in several partitions: as many as there are partitions
        over = d.groupBy(*keys, out).agg(F.avg(mean[0]).alias("__mean"), F.min("__part").alias("__a"), F.max("__part").alias("__b"))
        over = cut_lineage(over.where(F.col("__a") < F.col("__b")).drop("__a", "__b").withColumn("__many", F.lit(True)))
        value = F.when(F.col("__many"), F.col("__mean")).otherwise(F.col(mean[1]))
        d = null_safe(d, over, [*keys, out], "left").withColumn(mean[1], value)
    return d.select(*df.columns, out, *([mean[1]] if mean else []))


def cumsum(df: DataFrame, keys, value: str, out: str = "S", square: bool = False, size: int = CHUNK) -> DataFrame:
    """WN-04: running sum (or sum of squares) from the start of the series, ordered by ``rn``."""
    v = F.col(value) * F.col(value) if square else F.col(value)
    return prefix_sums(df, keys, {out: v}, size=size)


def _highpass(S, width: int) -> Column:
    return F.abs(4 * S(0) - S(-3 * width) - S(-2 * width) - S(2 * width) - S(3 * width))


def filters(df: DataFrame, keys, value: str, kmin: int, size: int = CHUNK) -> DataFrame:
    """The four filters of one pass over chunks, added as columns (rows carry ``rn``, ``n``):

    * ``cost1``, ``cost2`` (WN-05): ``|4 S(r) - S(r-3L) - S(r-2L) - S(r+2L) - S(r+3L)|`` for ``3L <= r <= n-3L``, else 0,
      for ``L1`` and ``L2``;
    * ``short_ab`` (WN-08): ``|3(S(t+2k-1) - S(t+k-1)) - (S(t+3k-1) - S(t-1))|`` for ``t <= n-3k+1``, else null;
    * ``test1``, ``test2`` (WN-06): their centred maxima of width 7, 0 where the window does not fit;
    * ``short_b``, ``test_b``, ``short_c``, ``test_c``: the short-segment filter ``k-1`` and ``2k-1`` rows before.
    """
    k, rn, n = kmin, F.col("rn"), F.col("n")
    reach = max(3 * L1, 3 * L2, 3 * k - 1) + PEAK_HALF
    last = n - 3 * k + 1
    offsets = sorted({s * m * w for w in (L1, L2) for m in (2, 3) for s in (-1, 1)} | {2 * k - 1, k - 1, 3 * k - 1, -1} - {0})

    def run(d: DataFrame, w) -> DataFrame:
        d = d.withColumn("__S", F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        name = lambda o: f"__S{'m' if o < 0 else 'p'}{abs(o)}"
        d = d.withColumns({name(o): F.lead("__S", o).over(w) if o > 0 else F.lag("__S", -o, 0.0).over(w) for o in offsets if o})
        S = lambda o: F.col("__S") if o == 0 else F.col(name(o))
        d = d.withColumns({
            "cost1": F.when((rn >= 3 * L1) & (rn <= n - 3 * L1), _highpass(S, L1)).otherwise(F.lit(0.0)),
            "cost2": F.when((rn >= 3 * L2) & (rn <= n - 3 * L2), _highpass(S, L2)).otherwise(F.lit(0.0)),
            "short_ab": F.when(rn <= last, F.abs(3 * (S(2 * k - 1) - S(k - 1)) - (S(3 * k - 1) - S(-1))))})
        d = d.drop("__S", *[name(o) for o in offsets if o])
        around = w.rowsBetween(-PEAK_HALF, PEAK_HALF)
        d = d.withColumns({
            "test1": F.when((rn > PEAK_HALF) & (rn <= n - PEAK_HALF), F.max("cost1").over(around)).otherwise(F.lit(0.0)),
            "test2": F.when((rn > PEAK_HALF) & (rn <= last - PEAK_HALF), F.max("short_ab").over(around)).otherwise(F.lit(0.0))})
        ahead = lambda c, o: F.lag(c, o).over(w) if o else F.col(c)
        return d.withColumns({"short_b": ahead("short_ab", k - 1), "test_b": ahead("test2", k - 1),
                              "short_c": ahead("short_ab", 2 * k - 1), "test_c": ahead("test2", 2 * k - 1)})

    return windowed(df, keys, reach + 2 * k - 1, reach, run, size=size)


def mark_breakpoints(df: DataFrame, keys, value: str, kmin: int, wide: float = 0.15, narrow: float = 0.15,
                     short: float = 0.02, most: float = 0.8, size: int = CHUNK) -> DataFrame:
    """SEG-05: candidate breakpoint marks of one series (the reference's four-filter rule).

    Expects ``rn`` and ``n`` (``index_series``). Adds cost1, test1, cost2, short_ab, test2, the three
    limits and ``mark``. ``wide``, ``narrow`` and ``short`` are the shares of positions that the wide filter, the
    narrow filter and the short-segment filter put forward, ``most`` bounds the share of a filter's own peaks;
    they are the same for series of every length.
    """
    keys = list(keys)
    k, rn, n = kmin, F.col("rn"), F.col("n")
    last = n - 3 * k + 1
    d = cut_lineage(filters(df, keys, value, kmin, size))        # read by the quantiles and by the marks
    in1 = F.col("cost1") >= THRES * F.col("test1")
    in2 = (rn >= 3 * L2) & (rn <= n - 3 * L2)
    in3 = (rn <= last) & (F.col("short_ab") >= THRES * F.col("test2"))
    limits = grouped_quantiles(d, keys, [
        ("cost1", in1, lambda cnt: 1 - F.least(F.lit(most), wide * n / cnt), "limit1"),
        ("cost2", in2, 1 - narrow, "limit2"),
        ("short_ab", in3, lambda cnt: 1 - F.least(F.lit(most), short * last / cnt), "limit3")], carry=["n"])
    d = null_safe(d, limits, keys, "left")
    short_mark = lambda at, v, t: (at >= 1) & (at <= last) & (F.col(v) > F.col("limit3")) & (F.col(v) > THRES * F.col(t))
    marks = [(F.col("cost1") > F.col("limit1")) & (F.col("cost1") > THRES * F.col("test1")), in2 & (F.col("cost2") > F.col("limit2"))]
    if k > 1:
        marks += [short_mark(rn - k + 1, "short_b", "test_b"), short_mark(rn - 2 * k + 1, "short_c", "test_c")]
    mark = F.lit(False)
    for m in marks:
        mark = mark | F.coalesce(m, F.lit(False))
    if 3 * L1 > k:
        forced = ((rn >= k) & (rn <= 3 * L1 - 1)) | ((rn >= n - 3 * L1 + 1) & (rn <= n - k))
        dropped = (rn <= k - 1) | ((rn >= n - k + 1) & (rn <= n - 1))
        mark = F.when(rn == n, True).when(dropped, False).when(forced, True).otherwise(mark)
    else:
        mark = (F.when(rn == n, True).when((rn == k) | (rn == n - k), True)
                .when((rn <= k - 1) | ((rn >= n - k + 1) & (rn <= n - 1)), False).otherwise(mark))
    return d.withColumn("mark", mark).drop("short_b", "test_b", "short_c", "test_c")


def block_ids(df: DataFrame, keys, mark: str = "mark", size: int = CHUNK) -> DataFrame:
    """WN-10: block number = marks strictly before the row (the last row of a series is a mark)."""
    own = F.col(mark).cast("int")
    return prefix_sums(df, keys, {"__marks": own}, size=size).withColumn("block_id", F.col("__marks") - own).drop("__marks")


def compact(df: DataFrame, keys, value: str) -> DataFrame:
    """SEG-06 / AG-20: per block count, sum and sum of squares (and the raw index of its last row)."""
    v = F.col(value)
    return df.groupBy(*keys, "block_id").agg(
        F.count("*").alias("nr"), F.sum(v).alias("sm"), F.sum(v * v).alias("sq"),
        F.max("rn").alias("end_rn"), F.first("n").alias("n"))


# ----------------------------------------------------------------- holes and presegments

def big_holes(df: DataFrame, keys, order, limit: int, size: int = CHUNK) -> DataFrame:
    """SEG-01 / WN-02: ``gap`` to the previous point and ``hole_id`` (count of gaps >= limit so far)."""
    def gaps(d, w):
        return d.withColumn("gap", F.col("position") - F.lag("position", 1).over(w))

    d = windowed(ranked(df, keys, order, total=None), keys, 1, 0, gaps, size=size)
    return prefix_sums(d, keys, {"hole_id": F.when(F.col("gap") >= limit, 1).otherwise(0)}, size=size).drop("rn")


def presegments(points: DataFrame, breakpoints: DataFrame | None, keys, order, limit: int = 3_000_000, size: int = CHUNK):
    """SEG-02/03: presegment id per point (with the point's other columns), and the presegment
    table (keys, preseg, start, end, n_points).

    Points are grouped by the prior breakpoints of their chromosome: a point belongs to the
    interval ending at the first breakpoint >= its position. Big holes split the intervals that end
    at a breakpoint (and the whole series when there are no breakpoints), but not the remainder
    after the last breakpoint -- as in the reference. A breakpoint at or before the first point is
    not used as an interval end (unless it is the only one), and the first interval then starts at it.

    Points and breakpoints are put in one order; a point starts a presegment if the row before it is a breakpoint
    (or nothing) or lies beyond a hole, and the presegment's number is the running count of such starts.
    """
    keys = list(keys)
    extra = [c for c in points.columns if c not in keys and c not in order]
    if breakpoints is None:
        empty = StructType([points.schema[c] for c in [*keys, "position"]])
        bps = points.sparkSession.createDataFrame([], empty)
    else:
        bps = breakpoints.select(*keys, "position")
    first_pt = points.groupBy(*keys).agg(F.min("position").alias("__p1"))
    bstat = bps.groupBy(*keys).agg(F.min("position").alias("__b1"), F.count("*").alias("__m"))
    info = cut_lineage(null_safe(first_pt, bstat, keys, "left"))
    # breakpoints used as interval ends
    skip = (F.col("__p1") >= F.col("__b1")) & (F.col("__m") > 1) & (F.col("position") == F.col("__b1"))
    used = null_safe(bps, info, keys).where(~F.coalesce(skip, F.lit(False))).select(*keys, "position")
    n_used = used.groupBy(*keys).agg(F.count("*").alias("__m_used"))
    # order: points before a breakpoint at the same position (a point at a breakpoint ends that interval)
    rest = [c for c in order if c != "position"]
    rows = points.select(*keys, "position", *rest, *extra, F.lit(1).alias("__kind")).unionByName(used.select(
        *keys, "position", *[F.lit(None).cast(points.schema[c].dataType).alias(c) for c in rest + extra], F.lit(2).alias("__kind")))

    def before(d, w):
        return d.withColumns({"__last": F.lag("__kind", 1).over(w), "__gap": F.col("position") - F.lag("position", 1).over(w)})

    u = windowed(ranked(rows, keys, ["position", "__kind", *rest], total=None), keys, 1, 0, before, size=size)
    u = null_safe(prefix_sums(u, keys, {"__bps": F.when(F.col("__kind") == 2, 1).otherwise(0)}, size=size), n_used, keys, "left")
    splits = F.col("__m_used").isNull() | (F.col("__bps") < F.col("__m_used"))
    starts = F.col("__last").isNull() | (F.col("__last") == 2) | (splits & (F.col("__gap") >= limit))
    u = prefix_sums(u, keys, {"preseg": F.when((F.col("__kind") == 1) & starts, 1).otherwise(0)}, size=size)
    assigned = u.where(F.col("__kind") == 1).select(*keys, *order, *extra, (F.col("preseg") - 1).cast("int").alias("preseg"))
    table = assigned.groupBy(*keys, "preseg").agg(
        F.min("position").alias("start"), F.max("position").alias("end"), F.count("*").alias("n_points"))
    table = null_safe(table, info, keys, "left")
    moved = (F.col("preseg") == 0) & (F.col("__p1") >= F.col("__b1"))
    return assigned, table.withColumn("start", F.when(moved, F.col("__b1")).otherwise(F.col("start"))).drop("__p1", "__b1", "__m")


# ----------------------------------------------------------------- running median and MAD

def _medians(x: np.ndarray, rn: np.ndarray, n: int, half: int) -> np.ndarray:
    """Running medians with the end rule for rows ``rn`` of a series of ``n`` (consecutive, with all that their own rows need)."""
    h = (min(2 * half + 1, n - 1 if n % 2 == 0 else n) - 1) // 2
    out = x.copy()
    if h < 1:
        return out
    first = int(rn[0])
    if len(x) > 2 * h:
        out[h:len(x) - h] = np.median(np.lib.stride_tricks.sliding_window_view(x, 2 * h + 1), axis=1)
    smooth = out.copy()
    median3 = lambda a, b, c: sorted((a, b, c))[1]
    # the ends: medians of the first 1, 3, 5, ... values, and Tukey's rule for the outermost
    for at_end, ends in ((first == 1, range(len(x))), (first + len(x) - 1 == n, range(len(x) - 1, -1, -1))):
        if not at_end:
            continue
        order = np.array(ends)
        kept = out[order[:2 * h - 1]]
        kept[:h] = x[order[:h]]
        for i in range(2, min(h, len(order)) + 1):
            smooth[order[i - 1]] = np.median(kept[:2 * i - 1])
    for at_end, a, b, c in ((first == 1, 0, 1, 2), (first + len(x) - 1 == n, -1, -2, -3)):
        if at_end and len(x) >= 3:
            smooth[a] = median3(x[a], smooth[b], 3 * smooth[b] - 2 * smooth[c])
    return smooth


def running_median(df: DataFrame, keys, value: str, out: str = "runmed", half: int = RUNMED_HALF, size: int = CHUNK) -> DataFrame:
    """WN-07: R ``runmed(x, 2k+1, endrule = "median")`` per series (rows must carry rn, n).

    Width is cut to n (n odd) or n-1 (n even) for short series. Interior points take the centred
    median; the ends are smoothed as R's ``smoothEnds``: point i (2 <= i <= h) takes the median of the
    first 2i-1 values of the kept-ends vector, and the extreme point uses Tukey's rule
    median(y1, s2, 3 s2 - 2 s3). A task holds one chunk and a halo of 3 k rows, in which the medians of an end's 2 h - 1 rows lie.
    """
    ship_package(df.sparkSession)
    d = with_halo(df, 3 * half + 1, 3 * half + 1, size=size)
    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
    names = df.columns

    def run(table: pa.Table) -> pa.Table:
        t = table.sort_by("rn")
        x, rn = t.column(value).to_numpy().astype("f8"), t.column("rn").to_numpy()
        got = _medians(x, rn, int(t.column("n")[0].as_py()), half)
        t = t.select(names).append_column(out, pa.array(got)).filter(t.column("own"))
        return t

    return d.groupBy(*keys, "chunk").applyInArrow(run, schema)


def noise_sd(points: DataFrame, keys, order, value: str = "baf", size: int = CHUNK) -> DataFrame:
    """SEG-04: per series, MAD x 1.4826 of (folded BAF - running median), zeros dropped; null -> 0;
    floored at 0.09. Returns (keys, sd)."""
    keys = list(keys)
    v = F.col(value)
    folded = points.select(*keys, *order, F.when(v < 0.5, v).otherwise(1 - v).alias("__x")).filter(F.col("__x") != 0)
    d = running_median(index_series(folded, keys, order).drop(*order), keys, "__x", "__rm", size=size)
    d = cut_lineage(d.select(*keys, (F.col("__x") - F.col("__rm")).alias("__dif")))
    every = F.lit(True)
    d = null_safe(d, grouped_quantiles(d, keys, [("__dif", every, 0.5, "__md")]), keys)
    mad = grouped_quantiles(d.withColumn("__off", F.abs(F.col("__dif") - F.col("__md"))), keys, [("__off", every, 0.5, "__mad")])
    out = null_safe(points.select(*keys).distinct(), mad, keys, "left").withColumn("__mad", F.lit(MAD_SCALE) * F.col("__mad"))
    return out.select(*keys, F.greatest(F.coalesce(F.col("__mad"), F.lit(0.0)), F.lit(SD_FLOOR)).alias("sd"),
                      F.col("__mad").alias("mad_raw"))
