"""Allele counting at known loci and contig-level QC (SRC-15, SRC-19, QC-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baflow.functions.chrom import AUTOSOMES
from baflow.session import cut_lineage

COUNT_COLS = ["count_a", "count_c", "count_g", "count_t"]
# The four base letters in allele-index order 1..4.
BASES = ["A", "C", "G", "T"]


def pileup_counts(bases: DataFrame, loci: DataFrame, min_baseq: int = 20, min_mapq: int = 35,
                  keys=("sample_id", "sample_kind"), samples: DataFrame | None = None) -> DataFrame:
    """Per-locus A/C/G/T counts and good depth over observations passing both quality limits.

    ``bases``: (sample_id, sample_kind, chrom, position, base, baseq, mapq), one row per observed base.
    ``loci``: (chrom, position, ...). Observations are read once and reduced before anything is joined (one conditional aggregate
    with map-side combine); the samples are those of the reduced rows, or those of ``samples`` (``keys``). Every locus of every
    sample is put out: loci without a good observation have zero counts.
    """
    keys = list(keys)
    good = (F.col("baseq") >= min_baseq) & (F.col("mapq") >= min_mapq)
    aggs = [F.count_if(good & (F.col("base") == b)).cast("int").alias(c) for b, c in zip(BASES, COUNT_COLS)]
    aggs.append(F.count_if(good).cast("int").alias("good_depth"))
    counted = bases.groupBy(*keys, "chrom", "position").agg(*aggs)
    if samples is None:
        counted = cut_lineage(counted)           # read for the samples and for the counts
        samples = counted
    # the list of samples is one row (as long as the cohort), so each locus is repeated without a pair join
    who = samples.select(*keys).distinct().agg(F.collect_set(F.struct(*keys)).alias("__who")).withColumn("__one", F.lit(1))
    places = loci.select("chrom", "position").distinct().withColumn("__one", F.lit(1)).join(who, "__one")
    places = places.select("chrom", "position", F.inline("__who"))
    full = places.join(counted, [*keys, "chrom", "position"], "left")
    return full.select(*keys, "chrom", "position",
                       *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in [*COUNT_COLS, "good_depth"]])


def contig_style(contigs: DataFrame, key: str = "sample_id") -> DataFrame:
    """Chromosome names 1..22, X in the naming style of the input contigs.

    Prefixed style (``chr1``) when any contig name contains ``chr``; one small aggregate per sample,
    then a generated list; nothing reaches the driver.
    """
    keys = [key] if key in contigs.columns else []
    style = contigs.groupBy(*keys).agg(F.max(F.col("chrom").contains("chr")).alias("prefixed"))
    names = F.concat(F.transform(F.sequence(F.lit(1), F.lit(AUTOSOMES)), lambda x: x.cast("string")),
                     F.array(F.lit("X")))
    out = style.select(*keys, "prefixed", F.posexplode(names).alias("pos0", "core"))
    return out.select(*keys, (F.col("pos0") + 1).alias("ordinal"),
                      F.when(F.col("prefixed"), F.concat(F.lit("chr"), F.col("core")))
                      .otherwise(F.col("core")).alias("chrom"))


def sex_call(contig_stats: DataFrame, compat: bool = True, x_name: str = "chrX", tol: float = 0.1,
             key: str = "sample_id") -> DataFrame:
    """Coverage of X against the other contigs (QC-01).

    ``x_like_autosomes`` is true when |ratio(X) - mean ratio(others)| < tol, where ratio is
    mapped / length after dropping contigs whose name has ``_`` and ``chrM``. With ``compat=True`` the
    mean counts every remaining row (also a ``*`` row whose ratio is null), as the reference does.
    """
    keys = [key] if key in contig_stats.columns else []
    c = F.col("chrom")
    kept = contig_stats.filter(~c.contains("_") & (c != "chrM"))
    if not compat:
        kept = kept.filter(c != "*")
    ratio = F.try_divide(F.col("mapped").cast("double"), F.col("length").cast("double"))
    kept = kept.withColumn("ratio", ratio)
    agg = kept.groupBy(*keys).agg(
        F.max(F.when(c == x_name, F.col("ratio"))).alias("x_ratio"),
        F.sum("ratio").alias("ratio_sum"),
        F.count("*").alias("n_contigs"))
    others = F.try_divide(F.col("ratio_sum") - F.col("x_ratio"), (F.col("n_contigs") - 1).cast("double"))
    return agg.select(*keys, "x_ratio", others.alias("others_mean"),
                      (F.abs(F.col("x_ratio") - others) < F.lit(tol)).alias("x_like_autosomes"))
