"""Plot-ready frames (PLT-01..05): the data behind the reference's figures, not the images."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from baflow.functions.chrom import chrom_ord


def segmented_frame(seg: DataFrame) -> DataFrame:
    """PLT-01/03: position in Mb, raw BAF, first-pass fit, side colour, BAFseg and its mirror."""
    return seg.select(
        "sample_id", "chrom", "position", (F.col("position") / 1e6).alias("position_mb"), "baf",
        "temp_baf_segm", (F.col("temp_baf_segm") > 0.5).alias("upper_side"), "baf_seg",
        (1 - F.col("baf_seg")).alias("baf_seg_mirror"))


def haplotype_frame(het: DataFrame) -> DataFrame:
    """PLT-02: BAF and mirror per het SNP with per-chromosome x limits and point size."""
    lim = het.groupBy("sample_id", "chrom").agg(
        F.min("position").alias("x_min"), F.max("position").alias("x_max"), F.count("*").alias("n"))
    lim = lim.withColumn("point_size", F.greatest(F.lit(0.5), F.least(F.lit(3.0), 1000 / F.col("n").cast("double"))))
    return (het.select("sample_id", "chrom", "position", "baf", (1 - F.col("baf")).alias("baf_mirror"))
            .join(lim, ["sample_id", "chrom"]))


def cnv_frame(calls: DataFrame) -> DataFrame:
    """PLT-04: copy-number segments in Mb in natural chromosome order, with colour limits
    floor(min) / ceiling(max) of the total copy number per sample."""
    lim = calls.groupBy("sample_id").agg(F.floor(F.min("Total_Copy_Number")).alias("cn_low"),
                                         F.ceil(F.max("Total_Copy_Number")).alias("cn_high"))
    return (calls.select("sample_id", F.col("Chromosome").alias("chrom"), chrom_ord("Chromosome").alias("chrom_rank"),
                         (F.col("Start_Pos") / 1e6).alias("start_mb"), (F.col("End_Pos") / 1e6).alias("end_mb"),
                         "BAF", "Total_Copy_Number", "Major_Copy_Number", "Minor_Copy_Number")
            .join(lim, "sample_id"))


def breakpoint_frame(breakpoints: DataFrame) -> DataFrame:
    """PLT-01: prior breakpoints in Mb."""
    return breakpoints.select(*[c for c in ("sample_id",) if c in breakpoints.columns], "chrom", (F.col("position") / 1e6).alias("position_mb"))


def cnv_points_frame(het: DataFrame, calls: DataFrame) -> DataFrame:
    """PLT-04: the raw BAF points behind the copy-number segments, in Mb, for the samples that have a call."""
    points = het.select("sample_id", F.regexp_replace("chrom", "^chr", "").alias("chrom"), (F.col("position") / 1e6).alias("position_mb"), "baf")
    return points.join(calls.select("sample_id").distinct(), "sample_id", "left_semi")


def profile_frame(reliability: DataFrame, rounded: bool = True) -> DataFrame:
    """PLT-05 / AG-25: the copy-number profile along the genome: segments end to end by their number of points, with whole
    (``rounded``) or raw copy numbers, their sum, and the confidences."""
    a, b = ("nA", "nB") if rounded else ("nAfull", "nBfull")
    w = Window.partitionBy("sample_id").orderBy("seg_id").rowsBetween(Window.unboundedPreceding, -1)       # segments of one sample
    start = F.coalesce(F.sum("length").over(w), F.lit(0))
    return reliability.select("sample_id", "seg_id", start.alias("x_start"), (start + F.col("length")).alias("x_end"), F.col(a).alias("n_a"),
                              F.col(b).alias("n_b"), (F.col(a) + F.col(b)).alias("n_total"), "confidenceR", "confidenceBAF")


def distance_frame(dist: DataFrame) -> DataFrame:
    """PLT-05: the distance surface (-d, as drawn) over (psi, rho)."""
    return dist.select("sample_id", "i", "j", "psi", "rho", (-F.col("d")).alias("neg_d"))
