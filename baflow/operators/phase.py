"""Genotype calls, VCF projection, phased-variant parsing and heterozygous BAF (PH-01..07)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baflow.operators.pileup import BASES, COUNT_COLS


def known_snps(legend: DataFrame, problem_loci: DataFrame) -> DataFrame:
    """PH-01 / JN-02: legend SNPs minus problem loci on (chrom, position) (left anti join)."""
    return legend.join(problem_loci.select("chrom", "position"), ["chrom", "position"], "left_anti")


def _letter_count(letter: Column, prefix: str = "") -> Column:
    """Count of the given base letter; letters outside ACGT give 0 (UDF-02)."""
    expr = F.lit(0)
    for b, c in reversed(list(zip(BASES, COUNT_COLS))):
        expr = F.when(letter == b, F.col(prefix + c)).otherwise(expr)
    return expr.cast("double")


def snp_baf(counts: DataFrame, snps: DataFrame, kind: str = "tumour") -> DataFrame:
    """PH-02: ALT share at known SNPs from the tumour counts; 0 when there is no depth.

    Loci must be seen in both samples (tumour ⋈ normal, JN-03); the legend is joined once carrying
    id, a0, a1 (JN-04/05 folded, so a duplicated legend position gives k rows, not k²).
    """
    both = (counts.groupBy("sample_id", "chrom", "position")
            .agg(*[F.sum(F.when(F.col("sample_kind") == kind, F.col(c))).alias(c) for c in COUNT_COLS],
                 F.count_if(F.col("sample_kind") != kind).alias("n_other"))
            .filter(F.col("count_a").isNotNull() & (F.col("n_other") > 0)).drop("n_other"))
    j = both.join(snps.select("chrom", "position", "id", "a0", "a1"), ["chrom", "position"])
    ref = _letter_count(F.col("a0"))
    alt = _letter_count(F.col("a1"))
    return j.select("sample_id", "chrom", "position", "id", "a0", "a1", ref.alias("ref_count"), alt.alias("alt_count"),
                    F.when(ref + alt > 0, alt / (ref + alt)).otherwise(F.lit(0.0)).alias("baf"))


def call_genotype(df: DataFrame, het: float = 0.1) -> DataFrame:
    """PH-03: BAF <= 0.1 -> 0/0, strictly between -> 0/1, >= 0.9 -> 1/1."""
    lo, hi = min(het, 1 - het), max(het, 1 - het)
    b = F.col("baf")
    gt = F.when(b <= lo, "0/0").when((b > lo) & (b < hi), "0/1").when(b >= hi, "1/1")
    return df.withColumn("genotype", gt)


def vcf_projection(calls: DataFrame) -> DataFrame:
    """PH-04 / PRJ-05/07: VCF-like columns; constant fields; ``chr`` stripped from CHROM (SNK-03)."""
    return calls.filter(F.col("genotype").isNotNull()).select(
        *[c for c in ("sample_id",) if c in calls.columns],
        F.regexp_replace(F.col("chrom"), "^chr", "").alias("CHROM"), F.col("position").alias("POS"),
        F.lit(".").alias("ID"), F.col("a0").alias("REF"), F.col("a1").alias("ALT"), F.lit(".").alias("QUAL"),
        F.lit("PASS").alias("FILTER"), F.lit(".").alias("INFO"), F.lit("GT").alias("FORMAT"),
        F.col("genotype").alias("SAMP0001"))


def phased_split(phased: DataFrame, gt: str = "gt") -> DataFrame:
    """PH-05 / WN-01: ``a|b`` -> allele1, allele2; synthetic ids numbered per (sample, chrom) by position.

    Splits on ``|`` or ``/`` and takes items 0 and 1 (the reference's empty-alternation split only
    works for one-digit alleles). Numbering is a row_number over a total order, so it is repeatable.
    """
    keys = [c for c in ("sample_id", "chrom") if c in phased.columns]
    parts = F.split(F.col(gt), r"[|/]")
    w = Window.partitionBy(*keys).orderBy("position", "ref", "alt")
    rn = F.row_number().over(w).cast("string")
    return phased.select(
        *keys, F.concat(F.lit("snp_index"), rn).alias("snp_index"), F.concat(F.lit("rs_index"), rn).alias("rs_index"),
        "position", "ref", "alt",
        parts.getItem(0).try_cast("int").alias("allele1"), parts.getItem(1).try_cast("int").alias("allele2"))


def het_baf(counts: DataFrame, haplotypes: DataFrame, min_counts: int = 1, kind: str = "tumour",
            orient_by_phase: bool = False) -> DataFrame:
    """PH-06: ALT share at phased heterozygous loci (allele1 != allele2) with depth >= min_counts.

    ``counts``: pileup rows; ``haplotypes``: (chrom, position, ref, alt, allele1, allele2).
    ``orient_by_phase`` turns the BAF by the phase (1 - BAF when allele1 = 1); off by default, as
    the reference only uses phase to choose loci.
    """
    het = haplotypes.filter(F.col("allele1") != F.col("allele2")).select(
        "chrom", "position", "ref", "alt", "allele1")
    t = counts.filter(F.col("sample_kind") == kind)
    j = t.join(het, ["chrom", "position"])
    ref = _letter_count(F.col("ref"))
    alt = _letter_count(F.col("alt"))
    j = j.withColumn("denom", ref + alt).filter(F.col("denom") >= min_counts)
    baf = F.try_divide(alt, F.col("denom"))          # null at an uncovered locus, which stays when min_counts is 0
    if orient_by_phase:
        baf = F.when(F.col("allele1") == 1, 1 - baf).otherwise(baf)
    return j.select("sample_id", "chrom", "position", baf.alias("baf"))


def panel_files(impute_info: DataFrame, sex: DataFrame, key: str = "sample_id") -> DataFrame:
    """FLT-01: the reference panel's files for each sample of ``sex`` (``sex_call``): all of them, or the pseudoautosomal ones alone where X is covered like
    the autosomes. A sample without an X contig ends the job, as its files cannot be chosen."""
    keys = [key] if key in sex.columns else []
    known = F.coalesce(F.col("x_like_autosomes"), F.raise_error(F.lit("no X contig: the panel's files cannot be chosen")).cast("boolean"))
    who = sex.select(*keys, known.alias("__par_only"), F.lit(1).alias("__one"))          # one row per sample
    j = impute_info.withColumn("__one", F.lit(1)).join(who, "__one").drop("__one")
    return j.where(~F.col("__par_only") | (F.col("is_par") == 1)).select(*keys, *impute_info.columns)
