"""Phased-BAF segmentation as Spark jobs (SEG-07..14).

Per series (sample, chrom, presegment): candidate marks come from window filters, the points are
compacted to blocks with one ``groupBy``, and only the blocks enter the Potts dynamic programme. It goes through a series in parts
of ``BLOCKS`` blocks, all series at once: a part gets the live starts of the part before and hands on its own, so no task
holds more than one part and the live starts. The parts of a series pass one after another through a task in one job (of at most ``ROUND``
blocks a series), and the breaks are then traced back the same way.
"""

from __future__ import annotations

import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from baflow.operators import potts
from baflow.operators import series as R
from baflow.operators.chunks import null_safe, prefix_sums
from baflow.operators.quantiles import grouped_quantiles
from baflow.session import cut_lineage, ship_package

BLOCKS = 20_000        # blocks of a series that a task holds at a time
ROUND = 4_000_000      # blocks of a series that pass through one task in one job
TOP = 2 ** 63 - 1      # block number that sorts a carried state behind all blocks
OPTIONS = (1, 2, 3)    # values of the segment value rule


def _slices(batches, keys, part: int):
    """(whether a series begins, rows) of sorted batches: consecutive rows of one series, ``part`` or fewer at a time."""
    held, n, last = [], 0, None
    begins = True

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for b in batches:
        if b.num_rows == 0:
            continue
        new, last = R.new_runs(b, keys, last)
        cuts = np.flatnonzero(new)
        at = 0
        while at < b.num_rows:
            if new[at] and n:
                yield begins, joined()
                held, n = [], 0
            if new[at]:
                begins = True
            k = int(np.searchsorted(cuts, at, "right"))
            stop = min(int(cuts[k]) if k < len(cuts) else b.num_rows, at + part - n)
            held.append(b.slice(at, stop - at))
            n, at = n + stop - at, stop
            if n == part:
                yield begins, joined()
                held, n, begins = [], 0, False
    if n:
        yield begins, joined()


def segment_ends(blocks: DataFrame, keys, kmin: int, part: int = BLOCKS, most: int = ROUND) -> DataFrame:
    """(keys, end_block): last block of every segment of the cheapest partition of each series.

    ``blocks``: keys, block_id (0, 1, ...), nr, sm, sq, penalty (constant per series). The sorted blocks of a series pass through a task,
    ``part`` in memory at a time; a part hands its live starts to the next, so all parts of all series are one job forward and one back. A
    job takes at most ``most`` blocks of each series; between two, the live starts (back: the break that is looked for) are stored.
    """
    keys = list(keys)
    spark = blocks.sparkSession
    ship_package(spark)
    fields = [blocks.schema[k] for k in keys]
    told = StructType([*fields, StructField("block_id", LongType()), StructField("before", LongType()), StructField("starts", BinaryType())])
    found = StructType([*fields, StructField("end_block", LongType()), StructField("before", LongType())])
    last = blocks.agg(F.max("block_id")).first()[0]
    if last is None:
        return blocks.select(*keys, F.col("block_id").cast("long").alias("end_block")).limit(0)
    rounds = int(last) // most + 1
    # few series, one task each: a number of tasks that adaptive planning leaves alone
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = ["nr", "sm", "sq", "penalty"]

    def rows_out(b: pa.RecordBatch, n: int, cols, names) -> pa.RecordBatch:
        first = pa.array(np.zeros(n, "i8"))
        return pa.RecordBatch.from_arrays([*[b.column(k).take(first) for k in keys], *cols], names=[*keys, *names])

    def forward(batches):
        starts, state = None, None
        for begins, b in _slices(batches, keys, part):
            if begins:
                if state is not None:
                    yield state
                starts, state = potts.Starts(), None
            if b.column("block_id")[0].as_py() < 0:                # the state of the round before, ahead of the blocks
                starts = potts.Starts.unpacked(b.column("starts")[0].as_py())
                b = b.slice(1)
                if b.num_rows == 0:
                    continue
            nr, sm, sq = (b.column(c).to_numpy(zero_copy_only=False).astype("f8") for c in ("nr", "sm", "sq"))
            before = potts.advance(starts, nr, sm, sq, kmin, float(b.column("penalty")[0].as_py()))
            n = b.num_rows
            yield rows_out(b, n, [b.column("block_id"), pa.array(before.astype("i8")), pa.nulls(n, pa.binary())], ["block_id", "before", "starts"])
            if rounds > 1:
                state = rows_out(b, 1, [pa.array([-1], pa.int64()), pa.array([-1], pa.int64()), pa.array([starts.packed()], pa.binary())],
                                 ["block_id", "before", "starts"])
        if state is not None:
            yield state

    def back(batches):
        end, state = None, None
        for begins, b in _slices(batches, keys, part):
            if begins:
                if state is not None:
                    yield state
                end, state = None, None
            ids, before = (b.column(c).to_numpy() for c in ("block_id", "before"))
            if ids[0] == TOP:                                      # where the later round's trace stands
                end, ids, before = int(before[0]), ids[1:], before[1:]
                if len(ids) == 0:
                    continue
            ids, before = ids[::-1], before[::-1]
            ends, end = potts.trace(before, int(ids[0]) + 1, int(ids[-1]) + 1 if end is None else end)
            yield rows_out(b, len(ends), [pa.array(np.array(ends, "i8") - 1), pa.array(np.zeros(len(ends), "i8"))], ["end_block", "before"])
            if rounds > 1:
                state = rows_out(b, 1, [pa.array([-1], pa.int64()), pa.array([end], pa.int64())], ["end_block", "before"])
        if state is not None:
            yield state

    cut = blocks.select(*keys, F.col("block_id").cast("long").alias("block_id"), *sums, F.lit(None).cast("binary").alias("starts"))
    in_round = lambda d, k: d.where(F.col("block_id").between(k * most, (k + 1) * most - 1)) if rounds > 1 else d
    by = [F.asc(k) for k in keys]
    state, parts = None, []
    for k in range(rounds):
        rows = in_round(cut, k)
        if state is not None:
            carried = state.select(*keys, "block_id", *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in sums], "starts")
            rows = rows.unionByName(carried.join(rows.select(*[F.col(c).alias(f"__r_{c}") for c in keys]).distinct(),
                                                 [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in keys], "left_semi"))
        done = rows.repartition(tasks, *keys).sortWithinPartitions(*by, "block_id").mapInArrow(forward, told)
        done = cut_lineage(done) if rounds > 1 else done           # a single round is read once
        parts.append(done.where(F.col("block_id") >= 0))
        state = done.where(F.col("block_id") < 0)
    state, out = None, None
    for rows in reversed(parts):
        rows = rows.select(*keys, "block_id", "before")
        if state is not None:
            rows = rows.unionByName(state.select(*keys, F.lit(TOP).alias("block_id"), "before"))
        done = rows.repartition(tasks, *keys).sortWithinPartitions(*by, F.desc("block_id")).mapInArrow(back, found)
        done = cut_lineage(done) if rounds > 1 else done
        ends = done.where(F.col("end_block") >= 0).select(*keys, "end_block")
        out = ends if out is None else out.unionByName(ends)
        state = done.where(F.col("end_block") < 0)
    return out


def potts_fit(indexed: DataFrame, keys, value: str, kmin: int, penalty_col: str, part: int = BLOCKS) -> DataFrame:
    """Fitted value per point (column ``fit``) and segment index (``seg_idx``).

    ``indexed`` carries keys, rn, n, value and ``penalty_col`` (gamma, constant per series).
    """
    keys = list(keys)
    # the marked points feed both the compaction and the join back: materialise them once
    points = cut_lineage(R.block_ids(R.mark_breakpoints(indexed, keys, value, kmin), keys, "mark"))
    v = F.col(value)
    blocks = cut_lineage(points.groupBy(*keys, "block_id").agg(
        F.count("*").cast("double").alias("nr"), F.sum(v).alias("sm"), F.sum(v * v).alias("sq"),
        F.first(penalty_col).alias("penalty")))
    ends = segment_ends(blocks, keys, kmin, part).select(*keys, F.col("end_block").alias("block_id"), F.lit(1).alias("__end"))
    cut = null_safe(blocks, ends, [*keys, "block_id"], "left").withColumn("__at", F.col("block_id") + 1)
    own = F.coalesce(F.col("__end"), F.lit(0))
    cut = prefix_sums(cut, keys, {"__ends": own}, rn="__at").withColumn("seg_idx", (F.col("__ends") - own).cast("long"))
    cut = cut_lineage(cut.select(*keys, "block_id", "seg_idx", "nr", "sm"))
    means = cut.groupBy(*keys, "seg_idx").agg((F.sum("sm") / F.sum("nr")).alias("fit"))
    fitted = null_safe(cut.select(*keys, "block_id", "seg_idx"), means, [*keys, "seg_idx"])
    return null_safe(points, fitted, [*keys, "block_id"])


def segment_series(points: DataFrame, keys, value: str, kmin: int, penalty_col: str, out: str,
                   skip: bool = False) -> DataFrame:
    """One Potts pass over every series (rows carry rn, n); with ``skip``, and for series of fewer than
    ``2 * kmin`` points, which cannot hold a break, the value is the series' mean."""
    keys = list(keys)
    short = points if skip else points.where(F.col("n") < 2 * kmin)
    whole = null_safe(short, short.groupBy(*keys).agg(F.avg(value).alias(out)), keys)
    if skip:
        return whole
    fitted = potts_fit(points.where(F.col("n") >= 2 * kmin), keys, value, kmin, penalty_col).withColumnRenamed("fit", out)
    cols = [*points.columns, out]
    return whole.select(*cols).unionByName(fitted.select(*cols))


def segment_value_rule(df: DataFrame, keys, option: int = 3, seg: str = "baf_seg", phased: str = "baf_phased") -> DataFrame:
    """SEG-13/14: value of each run of equal ``seg`` values: 1 median, 2 mean, 3 median unless it is
    exactly 0 or 1 (then mean); anything else keeps the mean, with a warning."""
    if option not in OPTIONS:
        logging.getLogger(__name__).warning("unknown segment value option %r: the mean is kept", option)
    if option not in (1, 3):
        return df
    keys = list(keys)

    d = R.run_ids(df, keys, ["rn"], [seg], "__run")
    d = cut_lineage(d)
    medians = grouped_quantiles(d, [*keys, "__run"], [(phased, F.lit(True), 0.5, "__med")])
    d = null_safe(d, medians, [*keys, "__run"])
    value = F.col("__med") if option == 1 else F.when(F.col("__med").isin(0.0, 1.0), F.col(seg)).otherwise(F.col("__med"))
    return d.withColumn(seg, value).drop("__run", "__med")


def segment_baf_phased(het: DataFrame, breakpoints: DataFrame | None = None, gamma: float = 10.0,
                       phasegamma: float = 3.0, kmin: int = 3, phasekmin: int = 3,
                       no_segmentation: bool = False, calc_seg_baf_option: int = 3,
                       hole_limit: int = 3_000_000, keys=("sample_id", "chrom"),
                       order=("position",), value: str = "baf") -> DataFrame:
    """SEG-12: presegments -> noise sd -> Potts on BAF -> phase flip -> Potts on phased BAF -> value rule.

    Returns keys, order columns, preseg, ``baf``, ``baf_phased``, ``baf_seg``, ``temp_baf_segm``.
    """
    keys, order = list(keys), list(order)
    pts = het.filter(F.col(value).isNotNull()).select(*keys, *order, F.col(value).alias("baf"))
    assigned, _ = R.presegments(pts, breakpoints, keys, order, hole_limit)
    skeys = keys + ["preseg"]
    # points with their presegment feed both the noise estimate and the index: materialise once
    pts = cut_lineage(R.index_series(assigned, skeys, order))
    sd = R.noise_sd(pts.drop("rn", "n"), skeys, order, "baf")
    idx = (null_safe(pts, sd.select(*skeys, "sd"), skeys)
           .withColumn("pen1", F.lit(phasegamma) * F.col("sd")).withColumn("pen2", F.lit(gamma) * F.col("sd")))
    idx = cut_lineage(idx)
    p1 = segment_series(idx, skeys, "baf", phasekmin, "pen1", "temp_baf_segm")
    p1 = phase_flip(p1.select(*skeys, *order, "rn", "n", "baf", "pen2", "temp_baf_segm"))
    p1 = cut_lineage(p1)
    p2 = segment_series(p1, skeys, "baf_phased", kmin, "pen2", "baf_seg", skip=no_segmentation)
    p2 = p2.select(*skeys, *order, "rn", "baf", "baf_phased", "baf_seg", "temp_baf_segm")
    p2 = segment_value_rule(p2, skeys, calc_seg_baf_option)
    return p2.select(*keys, *order, "preseg", "baf", "baf_phased", "baf_seg", "temp_baf_segm")


def phase_flip(df: DataFrame, seg: str = "temp_baf_segm", baf: str = "baf", out: str = "baf_phased") -> DataFrame:
    """SEG-11: BAF as it is where the first pass' segment lies above one half, mirrored elsewhere."""
    return df.withColumn(out, F.when(F.col(seg) > 0.5, F.col(baf)).otherwise(1 - F.col(baf)))
