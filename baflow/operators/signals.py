"""Tumour/normal allele signals: pair counts, depth filter, BAF, LogR (SIG-01..06)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baflow.operators.pileup import COUNT_COLS

TUMOUR, NORMAL = "tumour", "normal"


def _allele(idx: Column, prefix: str) -> Column:
    """Count of allele index 1..4 (A, C, G, T); any other index gives null (never throws)."""
    arr = F.array(*[F.col(f"{prefix}_{c}") for c in COUNT_COLS])
    return F.when(idx.between(1, 4), F.element_at(arr, idx))


def allele_quality(loci: DataFrame) -> DataFrame:
    """UDF-01: per chromosome the loci, and those whose a0 or a1 is no allele index (null or not 1..4).

    ``allele_pair_counts`` gives null counts at the latter, which every filter on depth then drops.
    """
    good = F.coalesce(F.col("a0").between(1, 4) & F.col("a1").between(1, 4), F.lit(False))
    return loci.groupBy("chrom").agg(F.count("*").alias("n_loci"), F.count_if(~good).alias("n_bad_alleles"))


def allele_pair_counts(counts: DataFrame, loci: DataFrame) -> DataFrame:
    """Counts of the reference pair a0/a1 in tumour and normal at each locus (SIG-01).

    ``counts`` is the long pileup table (sample_id, sample_kind, chrom, position, count_*). The
    tumour/normal pairing is one conditional aggregate on (sample_id, chrom, position) -- the same
    clustering as the pileup, so no extra shuffle -- and keeps loci seen in both samples (inner join
    semantics). The loci alleles are joined on (chrom, position).
    """
    aggs = []
    for kind, pre in ((TUMOUR, "mutant"), (NORMAL, "normal")):
        for c in COUNT_COLS:
            aggs.append(F.sum(F.when(F.col("sample_kind") == kind, F.col(c))).cast("int").alias(f"{pre}_{c}"))
    paired = (counts.groupBy("sample_id", "chrom", "position").agg(*aggs)
              .filter(F.col("mutant_count_a").isNotNull() & F.col("normal_count_a").isNotNull()))
    j = paired.join(loci.select("chrom", "position", "a0", "a1"), ["chrom", "position"])
    out = j.select(
        "sample_id", "chrom", "position",
        _allele(F.col("a0"), "mutant").alias("mut_count1"),
        _allele(F.col("a1"), "mutant").alias("mut_count2"),
        _allele(F.col("a0"), "normal").alias("norm_count1"),
        _allele(F.col("a1"), "normal").alias("norm_count2"))
    return out.withColumns({
        "total_normal": F.col("norm_count1") + F.col("norm_count2"),
        "total_tumour": F.col("mut_count1") + F.col("mut_count2")})


def min_depth(df: DataFrame, min_counts: int = 10) -> DataFrame:
    """Keep loci with normal depth >= min_counts and tumour depth >= 1; no filter when min_counts <= 0."""
    if min_counts <= 0:
        return df
    return df.filter((F.col("total_normal") >= min_counts) & (F.col("total_tumour") >= 1))


def hash_side(seed: int = 42) -> Column:
    """Repeatable coin flip per locus: 0 or 1 from a hash of (seed, sample, chrom, position)."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("sample_id"), F.col("chrom"), F.col("position")), F.lit(2)).cast("int")


def baf_side(df: DataFrame, side: Column | None = None, seed: int = 42) -> DataFrame:
    """BAF of one allele of the pair, chosen per locus, the same side for tumour and normal (SIG-03)."""
    s = hash_side(seed) if side is None else side
    d = df.withColumn("side", s.cast("int"))
    return d.withColumns({
        "normal_baf": F.try_divide(F.when(F.col("side") == 0, F.col("norm_count1")).otherwise(F.col("norm_count2"))
                                   .cast("double"), F.col("total_normal").cast("double")),
        "mutant_baf": F.try_divide(F.when(F.col("side") == 0, F.col("mut_count1")).otherwise(F.col("mut_count2"))
                                   .cast("double"), F.col("total_tumour").cast("double"))})


def logr_normalised(df: DataFrame) -> DataFrame:
    """log2 of tumour/normal depth ratio divided by the sample's mean ratio; normal LogR is 0 (SIG-04).
    A sample without a tumour read has a null LogR.

    The mean is a per-sample aggregate joined back (one row per sample), not a driver round trip;
    Spark broadcasts that small side when its measured size is under the broadcast threshold.
    """
    ratio = F.try_divide(F.col("total_tumour").cast("double"), F.col("total_normal").cast("double"))
    d = df.withColumn("depth_ratio", ratio)
    means = d.groupBy("sample_id").agg(F.avg("depth_ratio").alias("mean_ratio"))
    return (d.join(means, "sample_id")
            .withColumn("normal_logr", F.lit(0).cast("int"))
            .withColumn("mutant_logr", F.log2(F.try_divide(F.col("depth_ratio"), F.col("mean_ratio"))))
            .drop("mean_ratio"))


def allele_signal(bases: DataFrame, loci: DataFrame, min_baseq: int = 20, min_mapq: int = 35,
                  min_counts: int = 10, side: Column | None = None, seed: int = 42) -> DataFrame:
    """Flagship: base observations -> per-locus BAF and LogR for tumour and normal (SIG-05/06)."""
    from baflow.operators.pileup import pileup_counts
    from baflow.session import cut_lineage
    counts = pileup_counts(bases, loci, min_baseq, min_mapq)
    # the per-sample mean ratio and the per-locus rows both read the pairs: materialise them once
    pairs = cut_lineage(min_depth(allele_pair_counts(counts, loci), min_counts))
    return logr_normalised(baf_side(pairs, side, seed))


SIGNAL_OUTPUTS = ("normal_baf", "mutant_baf", "normal_logr", "mutant_logr", "allele_counts")


def signal_outputs(sig: DataFrame) -> dict[str, DataFrame]:
    """The five per-sample outputs in tidy form (SNK-02): value column is ``value``."""
    base = ["sample_id", "chrom", "position"]
    return {
        "normal_baf": sig.select(*base, F.col("normal_baf").alias("value")),
        "mutant_baf": sig.select(*base, F.col("mutant_baf").alias("value")),
        "normal_logr": sig.select(*base, F.col("normal_logr").alias("value")),
        "mutant_logr": sig.select(*base, F.col("mutant_logr").alias("value")),
        "allele_counts": sig.select(*base, F.col("mut_count1").alias("count_t1"), F.col("mut_count2").alias("count_t2"),
                                    F.col("norm_count1").alias("count_n1"), F.col("norm_count2").alias("count_n2")),
    }
