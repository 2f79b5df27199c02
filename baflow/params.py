"""Run configuration: reference catalogue by contig style and per-run defaults (SRC-16, PIPE-05)."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from baflow.functions.chrom import AUTOSOMES
from baflow.operators.pileup import contig_style, sex_call
from baflow.sources import io


@dataclass(frozen=True)
class ReferencePaths:
    """Reference tables for one contig naming style; ``{chrom}`` is filled per chromosome."""
    loci_alleles: str
    impute_info: str
    problem_loci: str
    legend: str = ""

    def for_chrom(self, chrom: str) -> "ReferencePaths":
        return ReferencePaths(*(v.replace("{chrom}", chrom) for v in
                                (self.loci_alleles, self.impute_info, self.problem_loci, self.legend)))


@dataclass(frozen=True)
class Catalogue:
    """SRC-16: one set of reference paths per contig style (``chr1`` vs ``1``)."""
    prefixed: ReferencePaths
    plain: ReferencePaths

    def pick(self, is_prefixed: bool) -> ReferencePaths:
        return self.prefixed if is_prefixed else self.plain


def sample_name(path: str) -> str:
    """PIPE-05: sample name from an input path (file name without its extension(s))."""
    base = os.path.basename(path.rstrip("/"))
    return re.sub(r"(\.[A-Za-z0-9]+)+$", "", base) or base


def run_defaults(contig_stats: DataFrame) -> dict[str, DataFrame]:
    """PIPE-05: per-sample defaults -- the X coverage call and the chromosome names in the contig
    naming style of the sample (two small frames keyed by sample_id)."""
    return {"sex": sex_call(contig_stats), "chromosomes": contig_style(contig_stats)}


def reference_tables(spark: SparkSession, catalogue: Catalogue, contig_stats: DataFrame) -> dict[str, DataFrame]:
    """SRC-16 / PIPE-05: the reference tables of a run (``loci``, ``impute_info``, ``problem_loci``), from the paths for the naming style of the
    contigs. One job has one style: samples of both styles are refused. Two booleans reach the driver."""
    key = [c for c in ("sample_id",) if c in contig_stats.columns]
    style = contig_stats.groupBy(*key).agg(F.max(F.col("chrom").contains("chr")).alias("prefixed"))
    low, high = style.agg(F.min("prefixed"), F.max("prefixed")).first()
    if low != high:
        raise ValueError("samples of both contig naming styles (chr1 and 1) cannot share a run")
    paths = catalogue.pick(bool(high))
    names = [("chr" if high else "") + str(c) for c in [*range(1, AUTOSOMES + 1), "X"]]
    return {"loci": io.read_allele_loci(spark, [paths.for_chrom(c).loci_alleles for c in names]),
            "impute_info": io.read_impute_info(spark, paths.impute_info), "problem_loci": io.read_problem_loci(spark, paths.problem_loci)}
