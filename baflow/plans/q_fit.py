"""Registered queries: signal alignment, grid search, optima, clonal refinement (FIT-01..21)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from baflow.operators import fit as T
from baflow.plans.registry import register
from baflow.plans.sql_fit import D, bounds_sql, cells_sql, distance_sql, minima_sql, optimum_sql
from baflow.sources import views as V

P = T.FitParams()
COARSE = T.coarse_grid_spec(P)
COARSE_CELLS = cells_sql(COARSE["psi_min"], 0.05, 89, COARSE["rho_min"], 0.01, 97)


def planted(spark, d):
    return V.planted(spark, d).select("sample_id", F.col("seg_id").alias("seg_idx"), "b", "r", "length")


# ---------------------------------------------------------------- alignment and runs

def matched(spark, d):
    s = V.series(spark, d)
    baf = s.select("sample_id", "chrom", "position", "event_id", F.col("baf").alias("value"))
    logr = s.select("sample_id", "chrom", "position", "event_id", F.col("logr").alias("value"))
    return T.match_signals(V.baf_segmented(spark, d), baf, logr, tiebreak="event_id")


def _first(src, cols):
    return (f"SELECT sample_id, replace(chrom, 'chr', '') AS chrom, position, {cols} FROM {src} "
            f"QUALIFY row_number() OVER (PARTITION BY sample_id, replace(chrom, 'chr', ''), position ORDER BY event_id) = 1")


MATCH_CTES = [
    ("ms", _first("v_bafseg", "baf_phased, baf_seg")),
    ("mb", _first("(SELECT * FROM v_series WHERE baf IS NOT NULL)", "baf")),
    ("ml", _first("(SELECT * FROM v_series WHERE logr IS NOT NULL)", "logr")),
    ("mj", """SELECT s.*, b.baf, l.logr FROM ms s JOIN mb b USING (sample_id, chrom, position) JOIN ml l USING (sample_id, chrom, position)"""),
    ("mc", """SELECT *, CASE WHEN lag(baf_seg) OVER w IS NULL OR lag(baf_seg) OVER w <> baf_seg THEN 1 ELSE 0 END AS chg
FROM mj WINDOW w AS (PARTITION BY sample_id, chrom ORDER BY position)"""),
    ("mr", """SELECT * EXCLUDE (chg), sum(chg) OVER (PARTITION BY sample_id, chrom ORDER BY position
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id FROM mc"""),
    ("matched", "SELECT *, avg(logr) OVER (PARTITION BY sample_id, chrom, run_id) AS logr_seg FROM mr"),
]
RANK = ("CASE WHEN regexp_extract(chrom, '^(?:chr)?(\\d+|X)$', 1) = 'X' THEN 100 "
        "ELSE TRY_CAST(NULLIF(regexp_extract(chrom, '^(?:chr)?(\\d+|X)$', 1), '') AS INT) END")
RUN_CTES = MATCH_CTES + [
    ("gc", f"""SELECT *, CASE WHEN lag(logr_seg) OVER w IS NULL OR lag(logr_seg) OVER w <> logr_seg
  OR lag(baf_seg) OVER w <> baf_seg THEN 1 ELSE 0 END AS chg
FROM matched WINDOW w AS (PARTITION BY sample_id ORDER BY {RANK} NULLS FIRST, chrom, position)"""),
    ("gr", f"""SELECT *, sum(chg) OVER (PARTITION BY sample_id ORDER BY {RANK} NULLS FIRST, chrom, position
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg_id FROM gc"""),
    ("runs", "SELECT sample_id, seg_id, first(logr_seg) AS r, first(baf_seg) AS b, count(*) AS length FROM gr GROUP BY 1, 2"),
]


@register("match_signals", ctes=MATCH_CTES, doubles=["baf_phased", "baf_seg", "baf", "logr", "logr_seg"],
          sql="SELECT * FROM matched")
def q_match_signals(spark, d):
    return matched(spark, d)


@register("segment_logr_mean", ctes=MATCH_CTES, doubles=["mean_logr"],
          sql="SELECT sample_id, chrom, run_id, count(*) AS n, avg(logr) AS mean_logr FROM matched GROUP BY 1, 2, 3")
def q_segment_logr_mean(spark, d):
    return matched(spark, d).groupBy("sample_id", "chrom", "run_id").agg(F.count("*").alias("n"),
                                                                          F.avg("logr").alias("mean_logr"))


@register("run_segments", ctes=RUN_CTES, doubles=["r", "b"], sql="SELECT * FROM runs")
def q_run_segments(spark, d):
    return T.make_segments(matched(spark, d), "logr_seg", "baf_seg")


@register("segment_info", ctes=RUN_CTES, doubles=["r", "b", "mean", "sd"], sql="""SELECT r.*, p.size, p.mean, p.sd FROM runs r JOIN (
  SELECT sample_id, baf_seg AS b, count(*) AS size, avg(baf_phased) AS mean, stddev_samp(baf_phased) AS sd FROM matched GROUP BY 1, 2) p
ON p.sample_id = r.sample_id AND p.b = r.b""")
def q_segment_info(spark, d):
    return T.segment_info(matched(spark, d))


# ---------------------------------------------------------------- grid distances

DIST_OUT = "sample_id, i, j, psi, rho, d"
for _c in range(4):
    def _mk(c):
        @register(f"distance_choice{c}", ctes=distance_sql("v_planted", COARSE_CELLS, c), doubles=["psi", "rho", "d"],
                  sql=f"SELECT {DIST_OUT} FROM dist")
        def _q(spark, d):
            return T.distance_grid(planted(spark, d), COARSE, c).select("sample_id", "i", "j", "psi", "rho", "d")
        return _q
    _mk(_c)


@register("distance_grid", ctes=distance_sql("v_planted", COARSE_CELLS, 1), doubles=["psi", "rho", "d", "ploidy"],
          sql=f"SELECT {DIST_OUT}, ploidy FROM dist")
def q_distance_grid(spark, d):
    return T.distance_grid(planted(spark, d), COARSE, 1).select("sample_id", "i", "j", "psi", "rho", "d", "ploidy")


LM_OUT = "sample_id, i, j, psi, rho, dm, ploidy, percentzero, perczero_abb, goodness, accepted"
LM_DOUBLES = ["psi", "rho", "dm", "ploidy", "percentzero", "perczero_abb", "goodness"]


def _dist1(spark, d):
    return T.distance_grid(planted(spark, d), COARSE, 1)


@register("local_minima", ctes=distance_sql("v_planted", COARSE_CELLS, 1) + minima_sql("dist", False, P),
          doubles=LM_DOUBLES, sql=f"SELECT {LM_OUT} FROM lm")
def q_local_minima(spark, d):
    return T.local_minima(_dist1(spark, d), P).select(*LM_OUT.split(", "))


def _fb_ctes():
    return [(n.replace("lm", "fb"), s.replace("lm_", "fb_")) for n, s in minima_sql("dist", True, P)]


@register("local_minima_fallback", ctes=distance_sql("v_planted", COARSE_CELLS, 1) + _fb_ctes(),
          doubles=LM_DOUBLES, sql=f"SELECT {LM_OUT} FROM fb")
def q_local_minima_fallback(spark, d):
    return T.local_minima(_dist1(spark, d), P, fallback=True).select(*LM_OUT.split(", "))


OPT_CTES = (distance_sql("v_planted", COARSE_CELLS, 1) + minima_sql("dist", False, P) + _fb_ctes()
            + optimum_sql("lm", "fb", "v_planted"))


@register("ascat_optimum", ctes=OPT_CTES, doubles=["psi", "rho", "ploidy", "goodness"], sql="SELECT * FROM opt")
def q_ascat_optimum(spark, d):
    return T.ascat_optimum(_dist1(spark, d), P)


@register("new_bounds", ctes=OPT_CTES, doubles=["psi_min", "psi_max", "rho_min", "rho_max"], sql=bounds_sql("opt", P))
def q_new_bounds(spark, d):
    return T.new_bounds(T.ascat_optimum(_dist1(spark, d), P), P)


@register("clonal_grid", ctes=OPT_CTES + [("nb", bounds_sql("opt", P))], doubles=["psi", "rho"], sql=f"""
SELECT sample_id, CAST(c AS INT) // n_rho AS i, CAST(c AS INT) % n_rho AS j,
  psi_min + (CAST(c AS INT) // n_rho) * psi_by AS psi, rho_min + (CAST(c AS INT) % n_rho) * rho_by AS rho
FROM (SELECT *, CAST(floor((psi_max - psi_min) / psi_by + {D(1e-10)}) + 1 AS INT) AS n_psi,
             CAST(floor((rho_max - rho_min) / rho_by + {D(1e-10)}) + 1 AS INT) AS n_rho
      FROM (SELECT *, (psi_max - psi_min) / 100 AS psi_by, (rho_max - rho_min) / 100 AS rho_by FROM nb)) g,
     range(0, n_psi * n_rho) t(c)""")
def q_clonal_grid(spark, d):
    spec = T.clonal_grid_spec(T.new_bounds(T.ascat_optimum(_dist1(spark, d), P), P))
    seed = spec.select("sample_id")
    return T.with_grid(seed, spec).select("sample_id", "i", "j", "psi", "rho")
