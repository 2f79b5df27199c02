"""Copy-number calling per BAF segment (CALL-01..09)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.functions.rmath import t_pvalue_two_sided, t_statistic
from baflow.operators.chunks import null_safe, prefix_sums, ranked
from baflow.operators.fit import MANY_COPIES, MINOR_FLOOR, baf_level
from baflow.operators.series import run_ids

KEYS = ["sample_id", "chrom"]

# The six candidate states of a segment, as (major, minor) offsets from
# (y, x) = (floor(nMajor), floor(nMinor)), per BAF case and LogR-priority case, in priority order.
EDGE_OFFSETS = {
    ("above3", True): [(0, 0), (-1, 0), (0, 0), (1, 0), (1, -1), (1, 0)],
    ("above3", False): [(1, 0), (1, -1), (1, 0), (0, 0), (-1, 0), (0, 0)],
    ("above2", True): [(0, 0), (0, -1), (0, 0), (1, 0), (1, -1), (1, 0)],
    ("above2", False): [(1, 0), (1, -1), (1, 0), (0, 0), (0, -1), (0, 0)],
    ("below", True): [(0, 0), (0, -1), (0, 0), (0, 1), (-1, 1), (0, 1)],
    ("below", False): [(0, 1), (-1, 1), (0, 1), (0, 0), (0, -1), (0, 0)],
}


def baf_segments(baf_seg: DataFrame, chrom_order: DataFrame | None = None) -> DataFrame:
    """CALL-01: segments = runs of equal BAFseg inside a chromosome (position order).

    Returns per segment: sample_id, chrom, seg_id, start, end, l (BAFseg of the run, folded to >= 0.5),
    n, mean / sd of phased BAF (for the t-test).
    """
    d = run_ids(baf_seg, KEYS, ["position"], ["baf_seg"], "seg_id")
    seg = d.groupBy("sample_id", "chrom", "seg_id").agg(
        F.min("position").alias("start"), F.max("position").alias("end"),
        F.max_by("baf_seg", "position").alias("__l"), F.count("*").alias("n"),
        F.avg("baf_phased").alias("mean"), F.stddev_samp("baf_phased").alias("sd"))
    return seg.withColumn("l", F.greatest(F.col("__l"), 1 - F.col("__l"))).drop("__l")


def segment_range_mean(segs: DataFrame, points: DataFrame, value: str = "logr", out: str = "logr") -> DataFrame:
    """CALL-02 / JN-10: mean of finite point values with start <= position <= end, per segment; null -> 0.

    Segment starts (before the points of their position) and ends (behind them) are put in one order with the points; the sum and
    count of a segment's points are the differences of the running sums at its two rows. The work is that of ordering points and
    segments once, however long the segments are and whether or not they overlap.
    """
    v = F.col(value)
    fine = points.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = fine.select(*KEYS, F.col("position").cast("long").alias("position"), F.lit(1).alias("__kind"), v.alias("__v"), F.lit(None).cast("long").alias("seg_id"))
    for kind, at in ((0, "start"), (2, "end")):
        rows = rows.unionByName(segs.select(*KEYS, F.col(at).cast("long").alias("position"), F.lit(kind).alias("__kind"),
                                            F.lit(0.0).alias("__v"), F.col("seg_id").cast("long").alias("seg_id")))
    u = prefix_sums(ranked(rows, KEYS, ["position", "__kind"], "__rn", None), KEYS,
                    {"__s": F.col("__v"), "__c": F.when(F.col("__kind") == 1, 1).otherwise(0)}, rn="__rn")
    part = lambda c: F.max(F.when(F.col("__kind") == 2, F.col(c))) - F.max(F.when(F.col("__kind") == 0, F.col(c)))
    means = u.where("__kind <> 1").groupBy(*KEYS, "seg_id").agg(F.try_divide(part("__s"), part("__c")).alias("__mean_v"))
    return null_safe(segs, means, [*KEYS, "seg_id"], "left").withColumn(out, F.coalesce(F.col("__mean_v"), F.lit(0.0))).drop("__mean_v")


def continuous_cn(segs: DataFrame, rho: Column, psi: Column, gamma: float = 1.0) -> DataFrame:
    """CALL-03: continuous nMajor / nMinor; nMinor < 0 is raised to ``MINOR_FLOOR`` with nMajor (``MANY_COPIES`` when l = 1)."""
    f = F.pow(F.lit(2.0), F.col("logr") / F.lit(gamma))
    l = F.col("l")
    maj = (rho - 1 + l * psi * f) / rho
    mn = (rho - 1 + (1 - l) * psi * f) / rho
    d = segs.withColumns({"__cmaj": maj, "__cmin": mn})
    raised = F.when(l == 1, F.lit(MANY_COPIES)).otherwise(F.col("__cmaj") + l * (F.lit(MINOR_FLOOR) - F.col("__cmin")) / (1 - l))
    return d.withColumns({
        "n_major": F.when(F.col("__cmin") < 0, raised).otherwise(F.col("__cmaj")),
        "n_minor": F.when(F.col("__cmin") < 0, F.lit(MINOR_FLOOR)).otherwise(F.col("__cmin"))}).drop("__cmaj", "__cmin")


def edge_candidates(segs: DataFrame, rho: Column) -> DataFrame:
    """CALL-04 / UDF-06: the six candidate states in priority order (array of struct<major, minor>);
    candidates with a negative copy number are null."""
    M, m = F.col("n_major"), F.col("n_minor")
    y, x = F.floor(M), F.floor(m)
    lev2 = baf_level(rho, F.ceil(M), F.ceil(m))
    lev3 = baf_level(rho, F.floor(M), F.floor(m))
    logr_case = (M + m) < x + y + 1
    case = F.when(F.col("l") > lev3, "above3").when(F.col("l") > lev2, "above2").otherwise("below")

    def arr(offsets):
        items = []
        for dy, dx in offsets:
            a, b = y + dy, x + dx
            items.append(F.when((a >= 0) & (b >= 0), F.struct(a.alias("major"), b.alias("minor"))))
        return F.array(*items)

    expr = None
    for (c, lc), offs in EDGE_OFFSETS.items():
        cond = (case == c) & (logr_case if lc else ~logr_case)
        expr = F.when(cond, arr(offs)) if expr is None else expr.when(cond, arr(offs))
    return segs.withColumns({"edges": expr, "ntot": M + m})


def call_states(segs: DataFrame, rho: Column, siglevel: float = 0.05, maxdist: float = 0.01,
                with_pvalue: bool = True) -> DataFrame:
    """CALL-05..07: test level of the first candidate, t statistic and p-value of the phased BAF
    against it (sd null/0 -> p 0; |l - level| < maxdist -> p 1); clonal -> first candidate,
    subclonal (p <= siglevel) -> first non-null candidate."""
    from baflow.session import ship_package
    ship_package(segs.sparkSession)
    first = F.element_at(F.col("edges"), 1)
    # null where rho is 1 and the first candidate has no copies: the level is not defined there
    lev = F.try_divide(1 - rho + rho * first["major"], 2 - 2 * rho + rho * (first["major"] + first["minor"]))
    d = segs.withColumn("test_level", lev)
    d = d.withColumn("t_stat", t_statistic(F.col("n"), F.col("mean"), F.col("sd"), F.col("test_level")))
    nonnull = F.filter(F.col("edges"), lambda e: e.isNotNull())
    sub = F.element_at(F.concat(nonnull, F.filter(F.col("edges"), lambda e: e.isNull())), 1)
    d = d.withColumns({"clonal_major": first["major"], "clonal_minor": first["minor"],
                       "subclonal_major": sub["major"], "subclonal_minor": sub["minor"]})
    if not with_pvalue:
        return d
    p = F.when(F.col("sd").isNull() | (F.col("sd") == 0), F.lit(0.0)).otherwise(
        t_pvalue_two_sided(F.col("n"), F.col("mean"), F.col("sd"), F.col("test_level"), 0.0))
    p = F.when(F.abs(F.col("l") - F.col("test_level")) < maxdist, F.lit(1.0)).otherwise(p)
    d = d.withColumn("pval", p)
    sub_call = F.col("pval") <= siglevel
    return d.withColumns({
        "is_subclonal": sub_call,
        "major": F.when(sub_call, F.col("subclonal_major")).otherwise(F.col("clonal_major")),
        "minor": F.when(sub_call, F.col("subclonal_minor")).otherwise(F.col("clonal_minor"))})


def call_subclones(baf_seg: DataFrame, logr: DataFrame, rho_psi: DataFrame, gamma: float = 1.0,
                   siglevel: float = 0.05, maxdist: float = 0.01) -> DataFrame:
    """CALL-09: copy-number table per segment, 9 columns (+ sample_id, is_subclonal).

    ``rho_psi`` carries (sample_id, method, rho, psi); the FRAC_GENOME row gives rho and the tumour
    psi_t, and psi of all cells = rho * psi_t + 2 (1 - rho).
    """
    fg = rho_psi.filter(F.col("method") == "FRAC_GENOME").select(
        "sample_id", F.col("rho").alias("__rho"), (F.col("rho") * F.col("psi") + 2 * (1 - F.col("rho"))).alias("__psi"))
    segs = segment_range_mean(baf_segments(baf_seg), logr, "value" if "value" in logr.columns else "logr")
    segs = called(segs.join(fg, "sample_id"), gamma, siglevel, maxdist)
    return segs.select(
        "sample_id", F.col("chrom").alias("Chromosome"), F.col("start").alias("Start_Pos"),
        F.col("end").alias("End_Pos"), F.col("l").alias("BAF"), "pval", F.col("logr").alias("LogR"),
        F.col("ntot").alias("Total_Copy_Number"), F.col("major").cast("double").alias("Major_Copy_Number"),
        F.col("minor").cast("double").alias("Minor_Copy_Number"), "is_subclonal")


def called(segs: DataFrame, gamma: float = 1.0, siglevel: float = 0.05, maxdist: float = 0.01) -> DataFrame:
    """CALL-03..07: states and p-values of segments that carry ``__rho`` and ``__psi`` of their sample."""
    rho, psi = F.col("__rho"), F.col("__psi")
    segs = continuous_cn(segs, rho, psi, gamma)
    segs = edge_candidates(segs, rho)
    return call_states(segs, rho, siglevel, maxdist)


def snp_pvalues(baf_seg: DataFrame, calls: DataFrame) -> DataFrame:
    """CALL-08: per-SNP p-value of its segment: ``calls`` (sample_id, chrom, seg_id, pval) joined on the segment's number."""
    d = run_ids(baf_seg, KEYS, ["position"], ["baf_seg"], "seg_id")
    return null_safe(d, calls.select(*KEYS, "seg_id", "pval"), [*KEYS, "seg_id"])
