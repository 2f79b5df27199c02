"""Registered queries: clonal refinement, reliability, and the rho/psi table (FIT-09..21)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from baflow.operators import fit as T
from baflow.plans.q_fit import COARSE, OPT_CTES, P, RUN_CTES, _dist1, matched
from baflow.plans import sql_clonal as C
from baflow.plans.registry import register
from baflow.plans.sql_fit import D, bounds_sql
from baflow.sources import views as V


def clonal_segments(spark, d):
    """v_segments with a segment index (1-based, genome order) and length > 1."""
    s = V.segments(spark, d).filter(F.col("length") > 1)
    w = Window.partitionBy("sample_id").orderBy("chrom", "day")
    return s.withColumn("seg_idx", F.row_number().over(w)).select(
        "sample_id", "seg_idx", "b", "r", "length", "size", "mean", "sd")


def fine_spec(spark, d):
    return T.clonal_grid_spec(T.new_bounds(T.ascat_optimum(_dist1(spark, d), P), P))


FINE_CTES = OPT_CTES + [("nb", bounds_sql("opt", P)), ("fs", f"""SELECT *, CAST(floor((psi_max - psi_min) / psi_by + {D(1e-10)}) + 1 AS INT) AS n_psi,
  CAST(floor((rho_max - rho_min) / rho_by + {D(1e-10)}) + 1 AS INT) AS n_rho
FROM (SELECT *, (psi_max - psi_min) / 100 AS psi_by, (rho_max - rho_min) / 100 AS rho_by FROM nb)"""),
    ("fc", """SELECT sample_id, CAST(c AS INT) // n_rho AS i, CAST(c AS INT) % n_rho AS j,
  psi_min + (CAST(c AS INT) // n_rho) * psi_by AS psi, rho_min + (CAST(c AS INT) % n_rho) * rho_by AS rho
FROM fs, range(0, n_psi * n_rho) t(c)"""),
    ("cs", "SELECT * FROM v_segments WHERE length > 1 AND b > 0.51")]


@register("clonal_distance_2", ctes=FINE_CTES, doubles=["psi", "rho", "d"], sql="""
SELECT fc.sample_id, fc.i, fc.j, fc.psi, fc.rho, CASE WHEN a.n > 0 THEN a.s2 / a.n ELSE 0.0 END AS d
FROM fc LEFT JOIN (SELECT sample_id, count(*) AS n, sum(pow(b - mean, 2)) AS s2 FROM cs GROUP BY 1) a ON a.sample_id = fc.sample_id""")
def q_clonal_distance_2(spark, d):
    return T.clonal_distance(clonal_segments(spark, d), fine_spec(spark, d), 2, P).select(
        "sample_id", "i", "j", "psi", "rho", "d")


@register("clonal_distance_3", ctes=FINE_CTES, doubles=["psi", "rho", "d"], sql="""
SELECT fc.sample_id, fc.i, fc.j, fc.psi, fc.rho, CASE WHEN a.g > 0 THEN a.s3 / a.g ELSE 0.0 END AS d
FROM fc LEFT JOIN (SELECT sample_id, sum(CAST(size AS DOUBLE)) AS g, sum(CAST(size AS DOUBLE) * pow(b - mean, 2)) AS s3 FROM cs GROUP BY 1) a
ON a.sample_id = fc.sample_id""")
def q_clonal_distance_3(spark, d):
    return T.clonal_distance(clonal_segments(spark, d), fine_spec(spark, d), 3, P).select(
        "sample_id", "i", "j", "psi", "rho", "d")


DAY_CTES = FINE_CTES + [
    ("ca", "SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY chrom, day) AS seg_idx FROM v_segments WHERE length > 1"),
    ("crit", C.critical_sql("ca")),
    ("grid", "SELECT s.*, c.i, c.j, c.psi, c.rho FROM ca s JOIN fc c ON c.sample_id = s.sample_id WHERE s.b > 0.51"),
    ("at_opt", "SELECT s.*, o.rho, o.psi FROM ca s JOIN opt o ON o.sample_id = s.sample_id")]
_CELL = "SELECT g.sample_id, g.i, g.j, g.psi, g.rho, f.n_psi, f.n_rho, g.d, {} AS minimise FROM ({}) g JOIN fs f ON f.sample_id = g.sample_id"
DISTANCES = {
    0: _CELL.format("false", f"""SELECT sample_id, i, j, psi, rho, sum(CASE WHEN clonal THEN CAST(size AS DOUBLE) ELSE 0 END) / sum(CAST(size AS DOUBLE)) AS d
FROM ({C.clonal_sql('grid', 'crit')}) GROUP BY ALL"""),
    1: _CELL.format("true", f"""SELECT sample_id, i, j, psi, rho, CASE WHEN sum(included) > 0 THEN sum(tvar * tvar) / sum(included) ELSE 0.0 END AS d
FROM ({C.std_error_sql('grid')}) GROUP BY ALL"""),
    # one candidate state for each segment, so every ratio is 0
    4: _CELL.format("false", f"SELECT sample_id, i, j, psi, rho, sum(ln_ratio) AS d FROM ({C.likelihood_sql('grid', False)}) GROUP BY ALL"),
}


for _c in (0, 1, 4):
    def _mk(c):
        @register(f"clonal_distance_{c}", ctes=DAY_CTES, doubles=["psi", "rho", "d"], sql=DISTANCES[c])
        def _q(spark, d):
            return T.clonal_distance(clonal_segments(spark, d), fine_spec(spark, d), c, P)
        return _q
    _mk(_c)


@register("centroid_optimum", ctes=FINE_CTES + [
    ("c3", """SELECT fc.*, CASE WHEN a.g > 0 THEN a.s3 / a.g ELSE 0.0 END AS d FROM fc LEFT JOIN (
  SELECT sample_id, sum(CAST(size AS DOUBLE)) AS g, sum(CAST(size AS DOUBLE) * pow(b - mean, 2)) AS s3 FROM cs GROUP BY 1) a
  ON a.sample_id = fc.sample_id"""),
    ("gm", "SELECT c3.*, min(d) OVER (PARTITION BY sample_id) AS gmin FROM c3"),
    ("op", "SELECT * FROM gm WHERE d = gmin"),
    ("ct", "SELECT sample_id, median(i) AS ci, median(j) AS cj, count(*) AS n_optima FROM op GROUP BY 1")],
    doubles=["psi", "rho", "goodness"], sql=f"""SELECT o.sample_id, o.i, o.j, o.psi, least(o.rho, {D(1.0)}) AS rho, o.gmin AS goodness, c.n_optima
FROM op o JOIN ct c ON c.sample_id = o.sample_id
QUALIFY row_number() OVER (PARTITION BY o.sample_id ORDER BY pow(o.i - c.ci, 2) + pow(o.j - c.cj, 2) ASC, o.i DESC, o.j DESC) = 1""")
def q_centroid_optimum(spark, d):
    cd = T.clonal_distance(clonal_segments(spark, d), fine_spec(spark, d), 3, P)
    return T.centroid_optimum(cd).select("sample_id", "i", "j", "psi", "rho", "goodness", "n_optima")


def _planted_point(spark, d):
    return T.ascat_optimum(_dist1(spark, d), P).select("sample_id", "rho", "psi")


@register("segment_clonal", ctes=DAY_CTES, doubles=["pval"], sql=f"""SELECT sample_id, seg_idx, tmaj AS nmaj_test, tmin AS nmin_test,
  {C.pvalue_sql()} AS pval, tmaj = tmin AS balanced, kept AND {C.pvalue_sql()} > {C.SIGLEVEL} AS is_clonal FROM ({C.tested_sql('at_opt')})""")
def q_segment_clonal(spark, d):
    rows = clonal_segments(spark, d).join(_planted_point(spark, d), "sample_id")
    return T.segment_clonal(rows, P.gamma, P.siglevel_baf, P.maxdist_baf).select(
        "sample_id", "seg_idx", "nmaj_test", "nmin_test", "pval", "balanced", "is_clonal")


@register("std_error", ctes=DAY_CTES, doubles=["tvar"], sql=f"SELECT sample_id, seg_idx, tvar, included FROM ({C.std_error_sql('at_opt')})")
def q_std_error(spark, d):
    rows = clonal_segments(spark, d).join(_planted_point(spark, d), "sample_id")
    return T.standardised_error(rows, P.gamma).select("sample_id", "seg_idx", "tvar", "included")


@register("ln_ratio", ctes=DAY_CTES, doubles=["likelihood", "ln_ratio"],
          sql=f"SELECT sample_id, seg_idx, likelihood, ln_ratio FROM ({C.likelihood_sql('at_opt', False)})")
def q_ln_ratio(spark, d):
    rows = clonal_segments(spark, d).join(_planted_point(spark, d), "sample_id")
    return T.ln_likelihood_ratio(rows, P.gamma, read_depth=30).select("sample_id", "seg_idx", "likelihood", "ln_ratio")


@register("ref_segment_refine")
def q_ref_segment_refine(spark, d):
    segs = clonal_segments(spark, d)
    cen = T.centroid_optimum(T.clonal_distance(segs, fine_spec(spark, d), 0, P))
    return T.ref_segment_refine(segs, T.reference_segment(segs, cen, P), P)


@register("psi_t", ctes=DAY_CTES + [("pt", C.psi_t_sql("at_opt"))], doubles=["psi_t"], sql="SELECT sample_id, psi_t FROM pt")
def q_psi_t(spark, d):
    return T.psi_t(clonal_segments(spark, d), _planted_point(spark, d), P)


@register("reliability", ctes=OPT_CTES, doubles=["nAfull", "nBfull", "nA", "nB", "backTransformedR", "backTransformedBAF",
                                                  "confidenceR", "confidenceBAF"], sql=f"""
SELECT sample_id, seg_id, nAfull, nBfull, nA, nB, backTransformedR, backTransformedBAF,
  CASE WHEN abs(backTransformedR) > 0.15 THEN least({D(100.0)}, greatest({D(0.0)}, 100 * (1 - CASE WHEN abs(r) = 0 THEN NULL ELSE abs(backTransformedR - r) / abs(r) END))) END AS confidenceR,
  CASE WHEN backTransformedBAF <> 0.5 THEN least({D(100.0)}, greatest({D(0.0)}, CASE WHEN b = 0.5 THEN {D(100.0)} ELSE 100 * (1 - abs(backTransformedBAF - b) / abs(b - 0.5)) END)) END AS confidenceBAF
FROM (SELECT *, {D(1.0)} * log2((rho * (nA + nB) + (1 - rho) * 2) / ((1 - rho) * 2 + rho * psi)) AS backTransformedR,
             (1 - rho + rho * nB) / (2 - 2 * rho + rho * (nA + nB)) AS backTransformedBAF
      FROM (SELECT *, greatest(round_even(nAfull, 0), {D(0.0)}) AS nA, greatest(round_even(nBfull, 0), {D(0.0)}) AS nB
            FROM (SELECT p.sample_id, p.seg_id, p.b, p.r, o.rho, o.psi,
                         (o.rho - 1 - (p.b - 1) * (pow({D(2.0)}, p.r / {D(1.0)}) * ((1 - o.rho) * 2 + o.rho * o.psi))) / o.rho AS nAfull,
                         (o.rho - 1 + p.b * (pow({D(2.0)}, p.r / {D(1.0)}) * ((1 - o.rho) * 2 + o.rho * o.psi))) / o.rho AS nBfull
                  FROM v_planted p JOIN opt o ON o.sample_id = p.sample_id)))""")
def q_reliability(spark, d):
    rel = T.reliability(V.planted(spark, d), _planted_point(spark, d), P.gamma)
    return rel.select("sample_id", "seg_id", "nAfull", "nBfull", "nA", "nB", "backTransformedR", "backTransformedBAF",
                      "confidenceR", "confidenceBAF")


FIT_CTES = RUN_CTES + [
    ("rseg_all", """SELECT r.*, p.size, p.mean, p.sd FROM runs r JOIN (
  SELECT sample_id, baf_seg AS b, count(*) AS size, avg(baf_phased) AS mean, stddev_samp(baf_phased) AS sd FROM matched GROUP BY 1, 2) p
ON p.sample_id = r.sample_id AND p.b = r.b"""),
    ("rseg", "SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY seg_id) AS seg_idx FROM rseg_all WHERE length > 1")] + C.fit_ctes("rseg", P, COARSE)


@register("run_clonal", ctes=FIT_CTES, doubles=C.RUN_DOUBLES, sql="SELECT * FROM rc")
def q_run_clonal(spark, d):
    return T.fit_copy_number(matched(spark, d), P)["run_clonal"]


@register("rho_psi", ctes=FIT_CTES, doubles=["rho", "psi", "ploidy", "distance"], sql="SELECT * FROM rho_psi")
def q_rho_psi(spark, d):
    return T.fit_copy_number(matched(spark, d), P)["rho_psi"]
