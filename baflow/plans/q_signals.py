"""Registered queries: allele counting, signals, contig QC."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from baflow.functions.chrom import chrom_ord
from baflow.operators import pileup as P
from baflow.operators import signals as S
from baflow.plans.registry import register
from baflow.session import checkpoint_dir
from baflow.sources import io
from baflow.sources import views as V

TP = V.TEST_PARAMS
CHROM_RANK_SQL = ("CASE WHEN regexp_extract({c}, '^(?:chr)?(\\d+|X)$', 1) = 'X' THEN 100 "
                  "ELSE TRY_CAST(NULLIF(regexp_extract({c}, '^(?:chr)?(\\d+|X)$', 1), '') AS INT) END")

PILEUP_SQL = f"""SELECT w.sample_id, w.sample_kind, l.chrom, l.position,
  CAST(count(*) FILTER (WHERE base = 'A') AS INT) AS count_a, CAST(count(*) FILTER (WHERE base = 'C') AS INT) AS count_c,
  CAST(count(*) FILTER (WHERE base = 'G') AS INT) AS count_g, CAST(count(*) FILTER (WHERE base = 'T') AS INT) AS count_t,
  CAST(count(base) AS INT) AS good_depth
FROM (SELECT DISTINCT chrom, position FROM v_loci) l
CROSS JOIN (SELECT DISTINCT sample_id, sample_kind FROM v_bases) w
LEFT JOIN v_bases b ON b.chrom = l.chrom AND b.position = l.position AND b.sample_id = w.sample_id
  AND b.sample_kind = w.sample_kind AND b.baseq >= {TP['min_baseq']} AND b.mapq >= {TP['min_mapq']}
GROUP BY 1, 2, 3, 4"""


def _pick(idx, pre):
    return (f"CASE {idx} WHEN 1 THEN {pre}_count_a WHEN 2 THEN {pre}_count_c "
            f"WHEN 3 THEN {pre}_count_g WHEN 4 THEN {pre}_count_t END")


PAIRS_SQL = f"""SELECT p.sample_id, p.chrom, p.position,
  {_pick('l.a0', 'mutant')} AS mut_count1, {_pick('l.a1', 'mutant')} AS mut_count2,
  {_pick('l.a0', 'normal')} AS norm_count1, {_pick('l.a1', 'normal')} AS norm_count2,
  {_pick('l.a0', 'normal')} + {_pick('l.a1', 'normal')} AS total_normal,
  {_pick('l.a0', 'mutant')} + {_pick('l.a1', 'mutant')} AS total_tumour
FROM (SELECT sample_id, chrom, position,
        CAST(sum(CASE WHEN sample_kind = 'tumour' THEN count_a END) AS INT) AS mutant_count_a,
        CAST(sum(CASE WHEN sample_kind = 'tumour' THEN count_c END) AS INT) AS mutant_count_c,
        CAST(sum(CASE WHEN sample_kind = 'tumour' THEN count_g END) AS INT) AS mutant_count_g,
        CAST(sum(CASE WHEN sample_kind = 'tumour' THEN count_t END) AS INT) AS mutant_count_t,
        CAST(sum(CASE WHEN sample_kind = 'normal' THEN count_a END) AS INT) AS normal_count_a,
        CAST(sum(CASE WHEN sample_kind = 'normal' THEN count_c END) AS INT) AS normal_count_c,
        CAST(sum(CASE WHEN sample_kind = 'normal' THEN count_g END) AS INT) AS normal_count_g,
        CAST(sum(CASE WHEN sample_kind = 'normal' THEN count_t END) AS INT) AS normal_count_t
      FROM counts GROUP BY 1, 2, 3) p
JOIN v_loci l ON l.chrom = p.chrom AND l.position = p.position
WHERE p.mutant_count_a IS NOT NULL AND p.normal_count_a IS NOT NULL"""

DEPTH_SQL = f"SELECT * FROM pairs WHERE total_normal >= {TP['min_counts']} AND total_tumour >= 1"

SIDE_SQL = f"""SELECT *, CASE WHEN total_normal = 0 THEN NULL ELSE CAST(CASE WHEN side = 0 THEN norm_count1 ELSE norm_count2 END AS DOUBLE) / total_normal END AS normal_baf,
  CASE WHEN total_tumour = 0 THEN NULL ELSE CAST(CASE WHEN side = 0 THEN mut_count1 ELSE mut_count2 END AS DOUBLE) / total_tumour END AS mutant_baf
FROM (SELECT *, CAST(({CHROM_RANK_SQL.format(c='chrom')} + position) % 2 AS INT) AS side FROM depth)"""

LOGR_SQL = """SELECT d.*, 0 AS normal_logr, log2(d.depth_ratio / m.mean_ratio) AS mutant_logr
FROM (SELECT *, CASE WHEN total_normal = 0 THEN NULL ELSE CAST(total_tumour AS DOUBLE) / total_normal END AS depth_ratio FROM {src}) d
JOIN (SELECT sample_id, avg(CASE WHEN total_normal = 0 THEN NULL ELSE CAST(total_tumour AS DOUBLE) / total_normal END) AS mean_ratio
      FROM {src} GROUP BY 1) m ON d.sample_id = m.sample_id"""

SIG_CTES = [("counts", PILEUP_SQL), ("pairs", PAIRS_SQL), ("depth", DEPTH_SQL), ("sided", SIDE_SQL)]


def test_side():
    """Fixture side rule (chrom rank + position) % 2, repeatable in SQL; production uses a hash."""
    return (chrom_ord("chrom") + F.col("position")) % 2


def _counts(spark, d):
    return P.pileup_counts(V.bases(spark, d), V.loci(spark, d), TP["min_baseq"], TP["min_mapq"])


def _pairs(spark, d):
    return S.allele_pair_counts(_counts(spark, d), V.loci(spark, d))


def _depth(spark, d):
    return S.min_depth(_pairs(spark, d), TP["min_counts"])


@register("allele_signal", headline=True, doubles=["normal_baf", "mutant_baf", "mutant_logr"], ctes=SIG_CTES,
          sql="SELECT sample_id, chrom, position, normal_baf, mutant_baf, mutant_logr FROM ("
              + LOGR_SQL.format(src="sided") + ")")
def q_allele_signal(spark, d):
    sig = S.allele_signal(V.bases(spark, d), V.loci(spark, d), TP["min_baseq"], TP["min_mapq"],
                          TP["min_counts"], side=test_side())
    return sig.select("sample_id", "chrom", "position", "normal_baf", "mutant_baf", "mutant_logr")


@register("pileup_counts", sql=PILEUP_SQL)
def q_pileup_counts(spark, d):
    return _counts(spark, d)


@register("allele_pair_counts", sql="SELECT * FROM pairs", ctes=SIG_CTES[:2])
def q_allele_pair_counts(spark, d):
    return _pairs(spark, d)


@register("min_depth", sql="SELECT * FROM depth", ctes=SIG_CTES[:3])
def q_min_depth(spark, d):
    return _depth(spark, d)


@register("baf_side", sql="SELECT * FROM sided", ctes=SIG_CTES, doubles=["normal_baf", "mutant_baf"])
def q_baf_side(spark, d):
    return S.baf_side(_depth(spark, d), side=test_side())


@register("logr_normalised", sql=LOGR_SQL.format(src="depth"), ctes=SIG_CTES[:3],
          doubles=["depth_ratio", "mutant_logr"])
def q_logr_normalised(spark, d):
    return S.logr_normalised(_depth(spark, d))


@register("loci_alleles_union", doubles=[],
          sql=f"SELECT chrom, {CHROM_RANK_SQL.format(c='chrom')} AS chrom_rank, position, a0, a1 FROM v_loci")
def q_loci_alleles_union(spark, d):
    """Loci written as one allele file per chromosome and read back as one table."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/loci-{uuid.uuid4().hex}"
    io.write_per_chrom(V.loci(spark, d).select("chrom", "position", "a0", "a1"), path, "alleles_")
    chroms = [f"chr{c}" for c in [*range(1, 23), "X", "Y"]]                    # there is none for Y
    lo = io.read_allele_loci(spark, [f"{path}/file=alleles_{c}.txt" for c in chroms])
    return io.genomic_sort(lo).select("chrom", "chrom_rank", "position", "a0", "a1")


@register("sex_call", doubles=["x_ratio", "others_mean"], sql="""
SELECT x_ratio, CASE WHEN n_contigs = 1 THEN NULL ELSE (ratio_sum - x_ratio) / CAST(n_contigs - 1 AS DOUBLE) END AS others_mean,
       abs(x_ratio - CASE WHEN n_contigs = 1 THEN NULL ELSE (ratio_sum - x_ratio) / CAST(n_contigs - 1 AS DOUBLE) END) < 0.1 AS x_like_autosomes
FROM (SELECT max(CASE WHEN chrom = 'chrX' THEN ratio END) AS x_ratio, sum(ratio) AS ratio_sum, count(*) AS n_contigs
      FROM (SELECT chrom, CASE WHEN length = 0 THEN NULL ELSE CAST(mapped AS DOUBLE) / CAST(length AS DOUBLE) END AS ratio
            FROM v_contigs WHERE NOT contains(chrom, '_') AND chrom <> 'chrM'))""")
def q_sex_call(spark, d):
    return P.sex_call(V.contigs(spark, d))


@register("contig_style", sql="""
SELECT CAST(i AS INT) AS ordinal, CASE WHEN p.prefixed THEN 'chr' ELSE '' END || CASE WHEN i = 23 THEN 'X' ELSE CAST(i AS VARCHAR) END AS chrom
FROM range(1, 24) t(i) CROSS JOIN (SELECT bool_or(contains(chrom, 'chr')) AS prefixed FROM v_contigs) p""")
def q_contig_style(spark, d):
    return P.contig_style(V.contigs(spark, d)).select("ordinal", "chrom")
