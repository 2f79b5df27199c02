"""Registered queries: Potts segmentation and the phased-BAF segmentation pipeline (SEG-07..14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from baflow.operators import segment as G
from baflow.operators import series as R
from baflow.operators.chunks import null_safe
from baflow.plans.q_series import MARKS, NOISE_CTES, PRESEG_CTES
from baflow.plans.registry import register
from baflow.plans.sql_segment import potts, two_pass_ctes, value_ctes
from baflow.sources import views as V

KEYS = ["sample_id", "chrom"]
ORDER = ["position", "event_id"]
KS = "sample_id, chrom"
KSP = "sample_id, chrom, preseg"
LIMIT = V.TEST_PARAMS["hole_limit"]


def _with_penalty(spark, d, factor=3.0):
    s = V.series(spark, d).select(*KEYS, *ORDER, "baf")
    sd = R.noise_sd(s, KEYS, ORDER, "baf")
    return R.index_series(null_safe(s, sd.select(*KEYS, "sd"), KEYS), KEYS, ORDER).withColumn("pen", F.lit(factor) * F.col("sd"))


def _summary(df, value="fit"):
    return (df.groupBy(*KEYS, "seg_idx")
            .agg(F.min("rn").alias("start_rn"), F.max("rn").alias("end_rn"), F.count("*").alias("n_points"),
                 F.first(value).alias("mean")))


def _potts_ctes(factor: float):
    return MARKS + NOISE_CTES + [("pen", f"""SELECT k.sample_id, k.chrom, {factor} * greatest(coalesce(m.mad, 0.0), 0.09) AS gamma
FROM (SELECT DISTINCT {KS} FROM v_series) k LEFT JOIN mad m ON m.sample_id = k.sample_id AND m.chrom = k.chrom""")]


@register("potts_segments", doubles=["mean"], ctes=_potts_ctes(3.0), sql=potts(KS, "m_mk", "pen"))
def q_potts_segments(spark, d):
    return _summary(G.potts_fit(_with_penalty(spark, d), KEYS, "baf", 3, "pen"))


@register("potts_segments_fine", doubles=["mean"], ctes=_potts_ctes(0.25), sql=potts(KS, "m_mk", "pen"))
def q_potts_segments_fine(spark, d):
    """A penalty small enough for many breaks in every series; parts of 500 blocks hand on their live starts."""
    return _summary(G.potts_fit(_with_penalty(spark, d, 0.25), KEYS, "baf", 3, "pen", part=500))


DAYMEAN_SQL = f"""SELECT *, avg(baf) OVER (PARTITION BY {KS}, CAST(floor(position / 86400) AS INT)) AS seg_mean FROM v_series"""


def _daymean(spark, d):
    s = V.series(spark, d).withColumn("day", F.floor(F.col("position") / 86400).cast("int"))
    return null_safe(s, s.groupBy(*KEYS, "day").agg(F.avg("baf").alias("seg_mean")), [*KEYS, "day"])


@register("phase_flip", doubles=["baf", "baf_phased"], ctes=[("dm", DAYMEAN_SQL)],
          sql="SELECT sample_id, chrom, event_id, baf, CASE WHEN seg_mean > 0.5 THEN baf ELSE 1 - baf END AS baf_phased FROM dm")
def q_phase_flip(spark, d):
    return G.phase_flip(_daymean(spark, d), "seg_mean").select(*KEYS, "event_id", "baf", "baf_phased")


RULE_CTES = [("dm", DAYMEAN_SQL),
             ("ph", f"""SELECT sample_id, chrom, event_id, position, CASE WHEN seg_mean > 0.5 THEN baf ELSE 1 - baf END AS baf_phased,
  row_number() OVER (PARTITION BY {KS} ORDER BY position, event_id) AS rn FROM dm"""),
             ("sg", f"""SELECT *, avg(baf_phased) OVER (PARTITION BY {KS}, CAST(floor(position / 86400) AS INT)) AS baf_seg FROM ph""")]
RULE_SQL = "SELECT sample_id, chrom, event_id, baf_phased, baf_seg FROM sv_v"


def _value_rule(spark, d, option):
    s = R.index_series(G.phase_flip(_daymean(spark, d), "seg_mean"), KEYS, ORDER)
    means = s.groupBy(*KEYS, "day").agg(F.avg("baf_phased").alias("baf_seg"))
    s = null_safe(s, means, [*KEYS, "day"])
    return G.segment_value_rule(s, KEYS, option).select(*KEYS, "event_id", "baf_phased", "baf_seg")


@register("segment_value_rule", doubles=["baf_phased", "baf_seg"], ctes=RULE_CTES + value_ctes("sg", KS, "sv", 3), sql=RULE_SQL)
def q_segment_value_rule(spark, d):
    return _value_rule(spark, d, 3)


@register("segment_value_median", doubles=["baf_phased", "baf_seg"], ctes=RULE_CTES + value_ctes("sg", KS, "sv", 1), sql=RULE_SQL)
def q_segment_value_median(spark, d):
    return _value_rule(spark, d, 1)


# presegments of a whole recording are joined with their signal; the rest of the twin knows only (keys, position, event_id, baf)
TWO_PASS = PRESEG_CTES + [("sig", """SELECT a.sample_id, a.chrom, a.preseg, a.position, a.event_id, s.baf FROM asg a JOIN v_series s
  ON a.sample_id = s.sample_id AND a.chrom = s.chrom AND a.event_id = s.event_id""")]
TWO_PASS_SQL = "SELECT sample_id, chrom, position, event_id, preseg, baf, baf_phased, baf_seg, temp_baf_segm FROM t_out_v"
TWO_PASS_DOUBLES = ["baf", "baf_phased", "baf_seg", "temp_baf_segm"]


def _two_pass(spark, d, **kw):
    s = V.series(spark, d).select(*KEYS, *ORDER, "baf")
    return G.segment_baf_phased(s, V.breakpoints(spark, d), hole_limit=LIMIT, keys=KEYS, order=ORDER, **kw)


@register("segment_baf_phased", doubles=TWO_PASS_DOUBLES, ctes=TWO_PASS + two_pass_ctes("sig", KSP), sql=TWO_PASS_SQL)
def q_segment_baf_phased(spark, d):
    return _two_pass(spark, d)


@register("segment_baf_phased_fine", doubles=TWO_PASS_DOUBLES, sql=TWO_PASS_SQL,
          ctes=TWO_PASS + two_pass_ctes("sig", KSP, gamma=0.3, phasegamma=0.2, option=1))
def q_segment_baf_phased_fine(spark, d):
    """Small penalties (breaks in most presegments, flips in both directions) and the median as the segment's value."""
    return _two_pass(spark, d, gamma=0.3, phasegamma=0.2, calc_seg_baf_option=1)
