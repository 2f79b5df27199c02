"""Registered queries: genotype and phase (PH-01..07)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from baflow.operators import phase as H
from baflow.operators.pileup import pileup_counts
from baflow.plans.q_signals import CHROM_RANK_SQL, PILEUP_SQL, TP
from baflow.plans.registry import register
from baflow.session import checkpoint_dir
from baflow.sources import io
from baflow.sources import views as V


def _counts(spark, d):
    return pileup_counts(V.bases(spark, d), V.loci(spark, d), TP["min_baseq"], TP["min_mapq"])


def _snp_baf(spark, d):
    return H.snp_baf(_counts(spark, d), H.known_snps(V.snps(spark, d), V.problem(spark, d)))


def _letter(letter, pre=""):
    return (f"CAST(CASE {letter} WHEN 'A' THEN {pre}count_a WHEN 'C' THEN {pre}count_c "
            f"WHEN 'G' THEN {pre}count_g WHEN 'T' THEN {pre}count_t ELSE 0 END AS DOUBLE)")


KNOWN_SQL = """SELECT s.* FROM v_snps s WHERE NOT EXISTS (
  SELECT 1 FROM v_problem p WHERE p.chrom = s.chrom AND p.position = s.position)"""

SNP_BAF_SQL = f"""SELECT sample_id, chrom, position, id, a0, a1, ref_count, alt_count,
  CASE WHEN ref_count + alt_count > 0 THEN alt_count / (ref_count + alt_count) ELSE 0.0 END AS baf
FROM (SELECT b.sample_id, b.chrom, b.position, k.id, k.a0, k.a1, {_letter('k.a0')} AS ref_count, {_letter('k.a1')} AS alt_count
      FROM (SELECT sample_id, chrom, position,
                   sum(CASE WHEN sample_kind = 'tumour' THEN count_a END) AS count_a,
                   sum(CASE WHEN sample_kind = 'tumour' THEN count_c END) AS count_c,
                   sum(CASE WHEN sample_kind = 'tumour' THEN count_g END) AS count_g,
                   sum(CASE WHEN sample_kind = 'tumour' THEN count_t END) AS count_t,
                   count(*) FILTER (WHERE sample_kind <> 'tumour') AS n_other
            FROM counts GROUP BY 1, 2, 3) b
      JOIN known k ON k.chrom = b.chrom AND k.position = b.position
      WHERE b.count_a IS NOT NULL AND b.n_other > 0)"""

GT_SQL = """SELECT *, CASE WHEN baf <= 0.1 THEN '0/0' WHEN baf > 0.1 AND baf < 0.9 THEN '0/1'
  WHEN baf >= 0.9 THEN '1/1' END AS genotype FROM snpbaf"""

PH_CTES = [("counts", PILEUP_SQL), ("known", KNOWN_SQL), ("snpbaf", SNP_BAF_SQL), ("gts", GT_SQL)]

SPLIT_SQL = """SELECT concat('snp_index', CAST(rn AS VARCHAR)) AS snp_index, concat('rs_index', CAST(rn AS VARCHAR)) AS rs_index,
  chrom, position, ref, alt, allele1, allele2
FROM (SELECT chrom, position, ref, alt, row_number() OVER (PARTITION BY chrom ORDER BY position, ref, alt) AS rn,
             TRY_CAST(string_split_regex(gt, '[|/]')[1] AS INT) AS allele1,
             TRY_CAST(string_split_regex(gt, '[|/]')[2] AS INT) AS allele2 FROM v_phased)"""

HET_SQL = f"""SELECT sample_id, chrom, position, alt_count / denom AS baf FROM (
  SELECT c.sample_id, c.chrom, c.position, {_letter('h.alt')} AS alt_count,
         {_letter('h.ref')} + {_letter('h.alt')} AS denom
  FROM counts c JOIN (SELECT * FROM splitp WHERE allele1 <> allele2) h ON h.chrom = c.chrom AND h.position = c.position
  WHERE c.sample_kind = 'tumour') WHERE denom >= {TP['min_counts']}"""


@register("known_snps_anti", sql=KNOWN_SQL)
def q_known_snps_anti(spark, d):
    return H.known_snps(V.snps(spark, d), V.problem(spark, d))


@register("snp_baf", sql="SELECT * FROM snpbaf", ctes=PH_CTES[:3], doubles=["ref_count", "alt_count", "baf"])
def q_snp_baf(spark, d):
    return _snp_baf(spark, d)


@register("genotype_calls", sql="SELECT * FROM gts", ctes=PH_CTES, doubles=["ref_count", "alt_count", "baf"])
def q_genotype_calls(spark, d):
    return H.call_genotype(_snp_baf(spark, d))


@register("vcf_projection", ctes=PH_CTES, sql="""SELECT sample_id, regexp_replace(chrom, '^chr', '') AS CHROM, position AS POS,
  '.' AS ID, a0 AS REF, a1 AS ALT, '.' AS QUAL, 'PASS' AS FILTER, '.' AS INFO, 'GT' AS FORMAT, genotype AS SAMP0001
FROM gts WHERE genotype IS NOT NULL""")
def q_vcf_projection(spark, d):
    return H.vcf_projection(H.call_genotype(_snp_baf(spark, d)))


VCF_NAMES = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", "SAMP0001"]


@register("vcf_export", ctes=PH_CTES, sql=f"""SELECT row_number() OVER (ORDER BY {CHROM_RANK_SQL.format(c='chrom')}, position) AS row,
  regexp_replace(chrom, '^chr', '') AS CHROM, CAST(position AS BIGINT) AS POS, '.' AS ID, a0 AS REF, a1 AS ALT, '.' AS QUAL, 'PASS' AS FILTER, '.' AS INFO,
  'GT' AS FORMAT, genotype AS SAMP0001 FROM gts WHERE genotype IS NOT NULL""")
def q_vcf_export(spark, d):
    """Genotypes written as an ordered VCF and read back: every line at its place in the files."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/vcf-{uuid.uuid4().hex}"
    io.export_vcf(H.vcf_projection(H.call_genotype(_snp_baf(spark, d))).drop("sample_id"), path)
    parts = F.split("line", "\t")
    return io.read_ordered(spark, path).select("row", *[
        parts[k].cast("long" if n == "POS" else "string").alias(n) for k, n in enumerate(VCF_NAMES)])


@register("phased_split", sql=SPLIT_SQL)
def q_phased_split(spark, d):
    return H.phased_split(V.phased(spark, d))


@register("het_baf", sql=HET_SQL, ctes=[("counts", PILEUP_SQL), ("splitp", SPLIT_SQL)], doubles=["baf"])
def q_het_baf(spark, d):
    return H.het_baf(_counts(spark, d), H.phased_split(V.phased(spark, d)), TP["min_counts"])


@register("het_baf_sorted", ctes=[("counts", PILEUP_SQL), ("splitp", SPLIT_SQL), ("het", HET_SQL)],
          doubles=["baf"], sql=f"SELECT *, {CHROM_RANK_SQL.format(c='chrom')} AS chrom_rank FROM het")
def q_het_baf_sorted(spark, d):
    return io.genomic_sort(H.het_baf(_counts(spark, d), H.phased_split(V.phased(spark, d)), TP["min_counts"]))
