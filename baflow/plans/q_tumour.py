"""Registered queries: the clonal fit on samples of known purity with planted clonal and mixed segments (FIT-09..21, CALL-05..09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from baflow.operators import call as K
from baflow.operators import fit as T
from baflow.operators import plot_frames as PF
from baflow.plans import sql_clonal as C
from baflow.plans.q_fit import COARSE, P
from baflow.plans.registry import register
from baflow.session import cut_lineage
from baflow.sources import views as V

SEG_CTES = [
    ("tseg_all", """SELECT sample_id, row_number() OVER (PARTITION BY sample_id ORDER BY CAST(chrom AS INT), segno) AS seg_id, baf_seg AS b, avg(logr) AS r,
  count(*) AS length, count(*) AS size, avg(baf_phased) AS mean, stddev_samp(baf_phased) AS sd FROM v_tumseg GROUP BY sample_id, chrom, segno, baf_seg"""),
    ("tseg", "SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY seg_id) AS seg_idx FROM tseg_all WHERE length > 1")]
FIT_CTES = SEG_CTES + C.fit_ctes("tseg", P, COARSE)


def matched(spark, d):
    s = V.tumour_segmented(spark, d)
    keys = ["sample_id", "chrom", "position"]
    return T.match_signals(s.select(*keys, "baf_phased", "baf_seg"), s.select(*keys, F.col("baf_phased").alias("value")),
                           s.select(*keys, F.col("logr").alias("value")))


def segments(spark, d):
    return cut_lineage(T.index_segments(T.segment_info(matched(spark, d)).filter(F.col("length") > 1)))


def fitted(spark, d):
    return T.fit_copy_number(matched(spark, d), P)


def at_optimum(spark, d):
    """Segments with the purity and ploidy that the first grid search finds for their sample."""
    m = matched(spark, d)
    segs = T.index_segments(T.segment_info(m).filter(F.col("length") > 1))
    first = T.make_segments(m.withColumn("__b1", 1 - F.col("baf_seg")), "logr_seg", "__b1", "run_id")
    opt = T.ascat_optimum(T.distance_grid(first, COARSE, 1), P)
    return segs.join(opt.select("sample_id", "rho", "psi"), "sample_id")


AT_OPT = [("at_opt", "SELECT s.*, o.rho, o.psi FROM tseg s JOIN opt o ON o.sample_id = s.sample_id")]


@register("tumour_segments", ctes=SEG_CTES, doubles=["b", "r", "mean", "sd"],
          sql="SELECT sample_id, seg_idx, b, r, length, size, mean, sd FROM tseg")
def q_tumour_segments(spark, d):
    return segments(spark, d).select("sample_id", "seg_idx", "b", "r", "length", "size", "mean", "sd")


@register("segment_clonal_test", ctes=FIT_CTES + AT_OPT, doubles=["pval"], sql=f"""SELECT sample_id, seg_idx, tmaj AS nmaj_test, tmin AS nmin_test,
  {C.pvalue_sql()} AS pval, tmaj = tmin AS balanced, kept AND {C.pvalue_sql()} > {C.SIGLEVEL} AS is_clonal FROM ({C.tested_sql('at_opt')})""")
def q_segment_clonal_test(spark, d):
    return T.segment_clonal(at_optimum(spark, d), P.gamma, P.siglevel_baf, P.maxdist_baf).select(
        "sample_id", "seg_idx", "nmaj_test", "nmin_test", "pval", "balanced", "is_clonal")


@register("segment_std_error", ctes=FIT_CTES + AT_OPT, doubles=["tvar"],
          sql=f"SELECT sample_id, seg_idx, tvar, included FROM ({C.std_error_sql('at_opt')})")
def q_segment_std_error(spark, d):
    return T.standardised_error(at_optimum(spark, d), P.gamma).select("sample_id", "seg_idx", "tvar", "included")


for _name, _corners in (("segment_likelihood", False), ("segment_likelihood_corners", True)):
    def _mk(name, corners):
        @register(name, ctes=FIT_CTES + AT_OPT, doubles=["likelihood", "ln_ratio"],
                  sql=f"SELECT sample_id, seg_idx, likelihood, ln_ratio FROM ({C.likelihood_sql('at_opt', corners)})")
        def _q(spark, d):
            rows = T.ln_likelihood_ratio(at_optimum(spark, d), P.gamma, candidates="corners" if corners else "nearest")
            return rows.select("sample_id", "seg_idx", "likelihood", "ln_ratio")
    _mk(_name, _corners)


def _grid(spark, d, choice):
    m = matched(spark, d)
    segs = cut_lineage(T.index_segments(T.segment_info(m).filter(F.col("length") > 1)))
    first = T.make_segments(m.withColumn("__b1", 1 - F.col("baf_seg")), "logr_seg", "__b1", "run_id")
    opt = T.ascat_optimum(T.distance_grid(first, COARSE, 1), P)
    return segs, cut_lineage(T.clonal_distance(segs, T.clonal_grid_spec(T.new_bounds(opt, P)), choice, P))


@register("tumour_distance_0", ctes=FIT_CTES, doubles=["psi", "rho", "d"], sql="SELECT sample_id, i, j, psi, rho, d FROM d0")
def q_tumour_distance_0(spark, d):
    return _grid(spark, d, 0)[1].select("sample_id", "i", "j", "psi", "rho", "d")


@register("tumour_distance_1", ctes=FIT_CTES, doubles=["psi", "rho", "d"], sql=f"""SELECT sample_id, i, j, psi, rho,
  CASE WHEN sum(included) > 0 THEN sum(tvar * tvar) / sum(included) ELSE 0.0 END AS d FROM ({C.std_error_sql('grid')}) GROUP BY ALL""")
def q_tumour_distance_1(spark, d):
    return _grid(spark, d, 1)[1].select("sample_id", "i", "j", "psi", "rho", "d")


CEN_OUT = ["sample_id", "i", "j", "psi", "rho", "goodness", "n_optima", "ref_seg", "ref_maj", "ref_min"]


@register("reference_segment", ctes=FIT_CTES, doubles=["psi", "rho", "goodness"], sql=f"SELECT {', '.join(CEN_OUT)} FROM cen")
def q_reference_segment(spark, d):
    segs, grid = _grid(spark, d, 0)
    return T.reference_segment(segs, T.centroid_optimum(grid), P).select(*CEN_OUT)


@register("tumour_psi_t", ctes=FIT_CTES, doubles=["psi_t"], sql="SELECT sample_id, psi_t FROM pt")
def q_tumour_psi_t(spark, d):
    segs, grid = _grid(spark, d, 0)
    return T.psi_t(segs, T.centroid_optimum(grid).select("sample_id", "rho", "psi"), P)


@register("tumour_profile", ctes=FIT_CTES + AT_OPT, doubles=["n_a", "n_b", "n_total"], sql="""SELECT sample_id, seg_id, x_end - length AS x_start, x_end, n_a, n_b, n_a + n_b AS n_total
FROM (SELECT *, CAST(sum(length) OVER (PARTITION BY sample_id ORDER BY seg_id) AS BIGINT) AS x_end,
  greatest(round_even((rho - 1 - ((1 - b) - 1) * pow(2.0::DOUBLE, r) * ((1 - rho) * 2 + rho * psi)) / rho, 0), 0.0) AS n_a,
  greatest(round_even((rho - 1 + (1 - b) * pow(2.0::DOUBLE, r) * ((1 - rho) * 2 + rho * psi)) / rho, 0), 0.0) AS n_b FROM at_opt)""")
def q_tumour_profile(spark, d):
    rows = at_optimum(spark, d).withColumn("b", 1 - F.col("b"))
    rel = T.reliability(rows.drop("rho", "psi"), rows.select("sample_id", "rho", "psi").distinct(), P.gamma)
    return PF.profile_frame(rel).drop("confidenceR", "confidenceBAF")


@register("tumour_run_clonal", ctes=FIT_CTES, doubles=C.RUN_DOUBLES, sql="SELECT * FROM rc")
def q_tumour_run_clonal(spark, d):
    return fitted(spark, d)["run_clonal"]


@register("tumour_rho_psi", ctes=FIT_CTES, doubles=["rho", "psi", "ploidy", "distance"], sql="SELECT * FROM rho_psi")
def q_tumour_rho_psi(spark, d):
    return fitted(spark, d)["rho_psi"]
