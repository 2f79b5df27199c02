"""Registered queries: copy-number calling (CALL-01..09) and plot frames (PLT-01..05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from baflow.operators import call as K
from baflow.operators import fit as T
from baflow.operators import plot_frames as PF
from baflow.plans.q_clonal import _planted_point
from baflow.plans.q_fit import COARSE_CELLS, OPT_CTES, P, _dist1
from baflow.plans.registry import register
from baflow.plans.sql_clonal import tail_sql
from baflow.plans.sql_fit import D, distance_sql
from baflow.sources import views as V


def _segs(spark, d):
    bs = V.baf_segmented(spark, d)
    logr = V.series(spark, d).select("sample_id", "chrom", "position", "logr")
    return K.segment_range_mean(K.baf_segments(bs), logr, "logr")


def _point(spark, d):
    pt = _planted_point(spark, d)
    return pt.select("sample_id", F.col("rho").alias("__rho"),
                     (F.col("rho") * F.col("psi") + 2 * (1 - F.col("rho"))).alias("__psi"))


def _cn(spark, d):
    s = _segs(spark, d).join(_point(spark, d), "sample_id")
    return K.continuous_cn(s, F.col("__rho"), F.col("__psi"), 1.0)


def _edges(spark, d):
    return K.edge_candidates(_cn(spark, d), F.col("__rho"))


CALL_CTES = OPT_CTES + [
    ("cb", """SELECT *, CASE WHEN lag(baf_seg) OVER w IS NULL OR lag(baf_seg) OVER w <> baf_seg THEN 1 ELSE 0 END AS chg
FROM v_bafseg WINDOW w AS (PARTITION BY sample_id, chrom ORDER BY position)"""),
    ("cr", """SELECT *, sum(chg) OVER (PARTITION BY sample_id, chrom ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg_id FROM cb"""),
    ("cs0", """SELECT sample_id, chrom, seg_id, min(position) AS start, max(position) AS "end", arg_max(baf_seg, position) AS l0,
  count(*) AS n, avg(baf_phased) AS mean, stddev_samp(baf_phased) AS sd FROM cr GROUP BY 1, 2, 3"""),
    ("segs", """SELECT s.* EXCLUDE (l0), greatest(s.l0, 1 - s.l0) AS l, coalesce(m.lr, 0.0) AS logr FROM cs0 s LEFT JOIN (
  SELECT s.sample_id, s.chrom, s.seg_id, avg(p.logr) AS lr FROM cs0 s JOIN v_series p
  ON p.sample_id = s.sample_id AND p.chrom = s.chrom AND p.position BETWEEN s.start AND s."end"
  WHERE p.logr IS NOT NULL AND NOT isnan(p.logr) AND abs(p.logr) < 'inf'::DOUBLE GROUP BY 1, 2, 3) m
  ON m.sample_id = s.sample_id AND m.chrom = s.chrom AND m.seg_id = s.seg_id"""),
    ("cn0", """SELECT s.*, o.rho AS rr, o.rho * o.psi + 2 * (1 - o.rho) AS pp,
  (o.rho - 1 + s.l * (o.rho * o.psi + 2 * (1 - o.rho)) * pow(2.0, s.logr / 1.0)) / o.rho AS cmaj0,
  (o.rho - 1 + (1 - s.l) * (o.rho * o.psi + 2 * (1 - o.rho)) * pow(2.0, s.logr / 1.0)) / o.rho AS cmin0
FROM segs s JOIN opt o ON o.sample_id = s.sample_id"""),
    ("cn", f"""SELECT * EXCLUDE (cmaj0, cmin0),
  CASE WHEN cmin0 < 0 THEN (CASE WHEN l = 1 THEN {D(1000.0)} ELSE cmaj0 + l * ({D(0.01)} - cmin0) / (1 - l) END) ELSE cmaj0 END AS n_major,
  CASE WHEN cmin0 < 0 THEN {D(0.01)} ELSE cmin0 END AS n_minor FROM cn0"""),
]


# The six candidate states of the reference's table as (major, minor) offsets, by BAF case and LogR case.
CANDIDATES = {
    "above3": ([(0, 0), (-1, 0), (0, 0), (1, 0), (1, -1), (1, 0)], [(1, 0), (1, -1), (1, 0), (0, 0), (-1, 0), (0, 0)]),
    "above2": ([(0, 0), (0, -1), (0, 0), (1, 0), (1, -1), (1, 0)], [(1, 0), (1, -1), (1, 0), (0, 0), (0, -1), (0, 0)]),
    "below": ([(0, 0), (0, -1), (0, 0), (0, 1), (-1, 1), (0, 1)], [(0, 1), (-1, 1), (0, 1), (0, 0), (0, -1), (0, 0)]),
}


def _lev(maj, mn):
    return (f"CASE WHEN ({maj}) = 0 AND ({mn}) = 0 THEN 0.5 ELSE (1 - rr + rr * ({maj})) / "
            f"(2 - 2 * rr + rr * (({maj}) + ({mn}))) END")


def _edge_sql() -> str:
    y, x = "CAST(floor(n_major) AS BIGINT)", "CAST(floor(n_minor) AS BIGINT)"
    case = (f"CASE WHEN l > {_lev('floor(n_major)', 'floor(n_minor)')} THEN 'above3' "
            f"WHEN l > {_lev('ceil(n_major)', 'ceil(n_minor)')} THEN 'above2' ELSE 'below' END")
    logr = f"(n_major + n_minor < {x} + {y} + 1)"
    parts = []
    for k in range(6):
        maj, mn = [], []
        for c, both in CANDIDATES.items():
            for offs, no in zip(both, ("", "NOT "), strict=True):
                dy, dx = offs[k]
                cond = f"ecase = '{c}' AND {no}logr_case"
                maj.append(f"WHEN {cond} THEN y + ({dy})")
                mn.append(f"WHEN {cond} THEN x + ({dx})")
        parts.append(f"SELECT sample_id, chrom, seg_id, {k} AS k, CASE {' '.join(maj)} END AS mj, CASE {' '.join(mn)} END AS mi FROM ec")
    body = " UNION ALL ".join(parts)
    return (f"SELECT sample_id, chrom, seg_id, k, CASE WHEN mj >= 0 AND mi >= 0 THEN mj END AS major, "
            f"CASE WHEN mj >= 0 AND mi >= 0 THEN mi END AS minor FROM ({body})"), case, logr, y, x


EDGE_SQL, ECASE, ELOGR, EY, EX = _edge_sql()
EDGE_CTES = CALL_CTES + [("ec", f"SELECT *, {ECASE} AS ecase, {ELOGR} AS logr_case, {EY} AS y, {EX} AS x FROM cn"),
                         ("edges", EDGE_SQL)]
STATE_CTES = EDGE_CTES + [
    ("st", """SELECT c.sample_id, c.chrom, c.seg_id, c.n, c.mean, c.sd, c.l, c.rr,
  max(CASE WHEN e.k = 0 THEN e.major END) AS clonal_major, max(CASE WHEN e.k = 0 THEN e.minor END) AS clonal_minor,
  arg_min(e.major, e.k) FILTER (WHERE e.major IS NOT NULL) AS subclonal_major,
  arg_min(e.minor, e.k) FILTER (WHERE e.major IS NOT NULL) AS subclonal_minor
FROM cn c JOIN edges e ON e.sample_id = c.sample_id AND e.chrom = c.chrom AND e.seg_id = c.seg_id GROUP BY ALL"""),
    ("st2", """SELECT *, (1 - rr + rr * clonal_major) / (2 - 2 * rr + rr * (clonal_major + clonal_minor)) AS test_level FROM st"""),
    ("st3", """SELECT *, CASE WHEN sd = 0 THEN NULL ELSE (mean - test_level) * sqrt(CAST(n AS DOUBLE)) / sd END AS t_stat FROM st2"""),
]


@register("segment_range_logr", ctes=CALL_CTES, doubles=["l", "mean", "sd", "logr"],
          sql='SELECT sample_id, chrom, seg_id, start, "end", n, mean, sd, l, logr FROM segs')
def q_segment_range_logr(spark, d):
    return _segs(spark, d).select("sample_id", "chrom", "seg_id", "start", "end", "n", "mean", "sd", "l", "logr")


@register("continuous_cn", ctes=CALL_CTES, doubles=["l", "logr", "n_major", "n_minor"],
          sql="SELECT sample_id, chrom, seg_id, l, logr, n_major, n_minor FROM cn")
def q_continuous_cn(spark, d):
    return _cn(spark, d).select("sample_id", "chrom", "seg_id", "l", "logr", "n_major", "n_minor")


@register("edge_candidates", ctes=EDGE_CTES, sql="SELECT * FROM edges")
def q_edge_candidates(spark, d):
    e = _edges(spark, d)
    return e.select("sample_id", "chrom", "seg_id", F.posexplode("edges").alias("k", "e")).select(
        "sample_id", "chrom", "seg_id", "k", F.col("e.major").alias("major"), F.col("e.minor").alias("minor"))


@register("call_states", ctes=STATE_CTES, doubles=["test_level"], sql="""SELECT sample_id, chrom, seg_id, clonal_major, clonal_minor,
  subclonal_major, subclonal_minor, test_level FROM st3""")
def q_call_states(spark, d):
    s = K.call_states(_edges(spark, d), F.col("__rho"), with_pvalue=False)
    return s.select("sample_id", "chrom", "seg_id", "clonal_major", "clonal_minor", "subclonal_major",
                    "subclonal_minor", "test_level")


@register("segment_t_stat", ctes=STATE_CTES, doubles=["mean", "sd", "test_level", "t_stat"],
          sql="SELECT sample_id, chrom, seg_id, n, mean, sd, test_level, t_stat FROM st3")
def q_segment_t_stat(spark, d):
    s = K.call_states(_edges(spark, d), F.col("__rho"), with_pvalue=False)
    return s.select("sample_id", "chrom", "seg_id", "n", "mean", "sd", "test_level", "t_stat")


def _rho_psi(spark, d):
    pt = _planted_point(spark, d)
    return pt.select("sample_id", F.lit("FRAC_GENOME").alias("method"), "rho", "psi")


PVAL_CTES = STATE_CTES + [
    ("pv", f"""SELECT *, CASE WHEN abs(l - test_level) < 0.01 THEN 1.0 WHEN sd IS NULL OR sd = 0 THEN 0.0
  ELSE {tail_sql('t_stat', 'CAST(n - 1 AS DOUBLE)')} END AS pval FROM st3"""),
    ("calls", """SELECT c.sample_id, c.chrom AS Chromosome, c.start AS Start_Pos, c."end" AS End_Pos, c.l AS BAF, p.pval, c.logr AS LogR,
  c.n_major + c.n_minor AS Total_Copy_Number, CAST(CASE WHEN p.pval <= 0.05 THEN p.subclonal_major ELSE p.clonal_major END AS DOUBLE) AS Major_Copy_Number,
  CAST(CASE WHEN p.pval <= 0.05 THEN p.subclonal_minor ELSE p.clonal_minor END AS DOUBLE) AS Minor_Copy_Number, p.pval <= 0.05 AS is_subclonal
FROM cn c JOIN pv p ON p.sample_id = c.sample_id AND p.chrom = c.chrom AND p.seg_id = c.seg_id""")]
CN_DOUBLES = ["BAF", "pval", "LogR", "Total_Copy_Number"]


@register("copy_number", ctes=PVAL_CTES, doubles=CN_DOUBLES, sql="SELECT * FROM calls")
def q_copy_number(spark, d):
    bs = V.baf_segmented(spark, d)
    logr = V.series(spark, d).select("sample_id", "chrom", "position", "logr")
    return K.call_subclones(bs, logr, _rho_psi(spark, d))


@register("snp_pvalues", ctes=PVAL_CTES, doubles=["pval"],
          sql="SELECT r.sample_id, r.chrom, r.event_id, r.seg_id, p.pval FROM cr r JOIN pv p USING (sample_id, chrom, seg_id)")
def q_snp_pvalues(spark, d):
    calls = K.call_states(_edges(spark, d), F.col("__rho"))
    return K.snp_pvalues(V.baf_segmented(spark, d), calls).select("sample_id", "chrom", "event_id", "seg_id", "pval")


# ------------------------------------------------------------------ plot frames

@register("plot_haplotype", doubles=["baf", "baf_mirror", "point_size"], sql="""SELECT h.sample_id, h.chrom, h.position, h.baf, 1 - h.baf AS baf_mirror,
  l.x_min, l.x_max, l.n, greatest(0.5, least(3.0, 1000 / CAST(l.n AS DOUBLE))) AS point_size
FROM v_series h JOIN (SELECT sample_id, chrom, min(position) AS x_min, max(position) AS x_max, count(*) AS n FROM v_series GROUP BY 1, 2) l
ON l.sample_id = h.sample_id AND l.chrom = h.chrom""")
def q_plot_haplotype(spark, d):
    return PF.haplotype_frame(V.series(spark, d).select("sample_id", "chrom", "position", "baf"))


@register("plot_segments", doubles=["position_mb", "baf", "temp_baf_segm", "baf_seg", "baf_seg_mirror"], sql="""
SELECT sample_id, chrom, position, position / 1e6 AS position_mb, baf, temp_baf_segm, temp_baf_segm > 0.5 AS upper_side,
  baf_seg, 1 - baf_seg AS baf_seg_mirror
FROM (SELECT s.sample_id, s.chrom, s.position, s.baf, avg(s.baf) OVER (PARTITION BY s.sample_id, s.chrom, CAST(floor(s.position / 86400) AS INT)) AS temp_baf_segm,
             b.baf_seg FROM v_series s JOIN v_bafseg b ON b.sample_id = s.sample_id AND b.chrom = s.chrom AND b.event_id = s.event_id)""")
def q_plot_segments(spark, d):
    from pyspark.sql import Window
    s = V.series(spark, d)
    w = Window.partitionBy("sample_id", "chrom", F.floor(F.col("position") / 86400).cast("int"))
    s = s.withColumn("temp_baf_segm", F.avg("baf").over(w))
    b = V.baf_segmented(spark, d).select("sample_id", "chrom", "event_id", "baf_seg")
    return PF.segmented_frame(s.join(b, ["sample_id", "chrom", "event_id"]))


@register("plot_cnv", ctes=PVAL_CTES, doubles=["start_mb", "end_mb", "BAF", "Total_Copy_Number"], sql="""SELECT sample_id, Chromosome AS chrom,
  CAST(NULL AS INT) AS chrom_rank, Start_Pos / 1e6 AS start_mb, End_Pos / 1e6 AS end_mb, BAF, Total_Copy_Number, Major_Copy_Number, Minor_Copy_Number,
  CAST(floor(min(Total_Copy_Number) OVER (PARTITION BY sample_id)) AS BIGINT) AS cn_low, CAST(ceil(max(Total_Copy_Number) OVER (PARTITION BY sample_id)) AS BIGINT) AS cn_high
FROM calls""")
def q_plot_cnv(spark, d):
    return PF.cnv_frame(q_copy_number(spark, d))


@register("plot_distance", ctes=distance_sql("v_planted", COARSE_CELLS, 1),
    doubles=["psi", "rho", "neg_d"], sql="SELECT sample_id, i, j, psi, rho, -d AS neg_d FROM dist")
def q_plot_distance(spark, d):
    return PF.distance_frame(_dist1(spark, d))


@register("pipeline_copy_number")
def q_pipeline_copy_number(spark, d):
    """PIPE-01 end to end on the fixture: base observations -> copy-number table."""
    from baflow.plans.pipeline import RunParams, run
    from baflow.plans.q_signals import TP, test_side
    tables = {"bases": V.bases(spark, d), "loci": V.loci(spark, d), "phased": V.phased(spark, d),
              "contig_stats": V.contigs(spark, d)}
    params = RunParams(min_baseq=TP["min_baseq"], min_mapq=TP["min_mapq"], min_counts=TP["min_counts"],
                       het_min_counts=TP["min_counts"])
    return run(tables, params, side=test_side())["copy_number"]
