"""Registered queries: ordered-series operators on ``v_series`` (one series per event type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from baflow.operators import series as R
from baflow.plans.registry import register
from baflow.plans.sql_series import mark_ctes, runmed_ctes
from baflow.sources import views as V

KEYS = ["sample_id", "chrom"]
ORDER = ["position", "event_id"]
KS = "sample_id, chrom"
KMIN = 3
LIMIT = V.TEST_PARAMS["hole_limit"]

IDX_SQL = f"""SELECT sample_id, chrom, event_id, position, baf AS x,
  row_number() OVER (PARTITION BY {KS} ORDER BY position, event_id) AS rn, count(*) OVER (PARTITION BY {KS}) AS n
FROM v_series"""
MARKS = [("idx", IDX_SQL)] + mark_ctes("idx", KS, KMIN)


def indexed(spark, d):
    s = V.series(spark, d).select(*KEYS, "event_id", "position", F.col("baf").alias("x"))
    return R.index_series(s, KEYS, ORDER)


def filtered(spark, d):
    return R.filters(indexed(spark, d), KEYS, "x", KMIN)


def marked(spark, d):
    return R.mark_breakpoints(indexed(spark, d), KEYS, "x", KMIN)


@register("big_holes", sql=f"""SELECT sample_id, chrom, event_id, position, gap,
  sum(CASE WHEN gap >= {LIMIT} THEN 1 ELSE 0 END) OVER (PARTITION BY {KS} ORDER BY position, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hole_id
FROM (SELECT *, position - lag(position) OVER (PARTITION BY {KS} ORDER BY position, event_id) AS gap FROM v_series)""")
def q_big_holes(spark, d):
    s = V.series(spark, d).select(*KEYS, "event_id", "position")
    return R.big_holes(s, KEYS, ORDER, LIMIT)


PRESEG_CTES = [
    ("pts", "SELECT sample_id, chrom, position, event_id FROM v_series"),
    ("info", """SELECT p.sample_id, p.chrom, p.p1, b.b1, b.m FROM (SELECT sample_id, chrom, min(position) AS p1 FROM pts GROUP BY 1, 2) p
LEFT JOIN (SELECT sample_id, chrom, min(position) AS b1, count(*) AS m FROM v_breakpoints GROUP BY 1, 2) b
ON p.sample_id = b.sample_id AND p.chrom = b.chrom"""),
    ("used", """SELECT b.sample_id, b.chrom, b.position FROM v_breakpoints b JOIN info i ON i.sample_id = b.sample_id AND i.chrom = b.chrom
WHERE NOT coalesce(i.p1 >= i.b1 AND i.m > 1 AND b.position = i.b1, false)"""),
    ("nu", "SELECT sample_id, chrom, count(*) AS m_used FROM used GROUP BY 1, 2"),
    ("u", """SELECT sample_id, chrom, position, event_id, 1 AS kind FROM pts
UNION ALL SELECT sample_id, chrom, position, NULL AS event_id, 2 AS kind FROM used"""),
    ("g", f"""SELECT *, coalesce(sum(CASE WHEN kind = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY {KS} ORDER BY position, kind, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bp_group FROM u"""),
    ("gh", f"""SELECT g.sample_id, g.chrom, g.position, g.event_id, g.bp_group, coalesce(nu.m_used, 0) AS m_used,
  g.position - lag(g.position) OVER (PARTITION BY g.sample_id, g.chrom, g.bp_group ORDER BY g.position, g.event_id) AS gap
FROM g LEFT JOIN nu ON nu.sample_id = g.sample_id AND nu.chrom = g.chrom WHERE g.kind = 1"""),
    ("gi", f"""SELECT *, sum(CASE WHEN (m_used = 0 OR bp_group < m_used) AND gap >= {LIMIT} THEN 1 ELSE 0 END)
  OVER (PARTITION BY sample_id, chrom, bp_group ORDER BY position, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hole_id FROM gh"""),
    ("asg", f"""SELECT sample_id, chrom, position, event_id,
  dense_rank() OVER (PARTITION BY {KS} ORDER BY bp_group, hole_id) - 1 AS preseg FROM gi"""),
]


@register("presegments", ctes=PRESEG_CTES, sql="""SELECT a.sample_id, a.chrom, a.preseg,
  CASE WHEN a.preseg = 0 AND i.p1 >= i.b1 THEN i.b1 ELSE a.start END AS start, a."end", a.n_points
FROM (SELECT sample_id, chrom, preseg, min(position) AS start, max(position) AS "end", count(*) AS n_points FROM asg GROUP BY 1, 2, 3) a
LEFT JOIN info i ON i.sample_id = a.sample_id AND i.chrom = a.chrom""")
def q_presegments(spark, d):
    s = V.series(spark, d).select(*KEYS, "event_id", "position")
    _, table = R.presegments(s, V.breakpoints(spark, d), KEYS, ORDER, LIMIT)
    return table


NOISE_CTES = [
    ("f", f"""SELECT sample_id, chrom, event_id, position, x,
  row_number() OVER (PARTITION BY {KS} ORDER BY position, event_id) AS rn, count(*) OVER (PARTITION BY {KS}) AS n
FROM (SELECT sample_id, chrom, event_id, position, CASE WHEN baf < 0.5 THEN baf ELSE 1 - baf END AS x FROM v_series) WHERE x <> 0""")] \
    + runmed_ctes("f", KS) + [
    ("dif", f"SELECT *, x - rm AS dif, median(x - rm) OVER (PARTITION BY {KS}) AS md FROM r_rm"),
    ("mad", f"SELECT sample_id, chrom, {1.4826} * median(abs(dif - md)) AS mad FROM dif GROUP BY 1, 2")]


@register("noise_sd", doubles=["sd", "mad_raw"], ctes=NOISE_CTES,
    sql="""SELECT k.sample_id, k.chrom, greatest(coalesce(m.mad, 0.0), 0.09) AS sd, m.mad AS mad_raw
FROM (SELECT DISTINCT sample_id, chrom FROM v_series) k LEFT JOIN mad m ON m.sample_id = k.sample_id AND m.chrom = k.chrom""")
def q_noise_sd(spark, d):
    return R.noise_sd(V.series(spark, d), KEYS, ORDER, "baf")


@register("running_median", doubles=["x", "rm"], ctes=[("f", IDX_SQL)] + runmed_ctes("f", KS),
          sql="SELECT sample_id, chrom, event_id, rn, x, rm FROM r_rm")
def q_running_median(spark, d):
    return R.running_median(indexed(spark, d), KEYS, "x", "rm").select(*KEYS, "event_id", "rn", "x", "rm")


@register("highpass_costs", doubles=["cost1", "cost2"], ctes=MARKS[:3],
          sql="SELECT sample_id, chrom, event_id, rn, cost1, cost2 FROM m_hp")
def q_highpass_costs(spark, d):
    return filtered(spark, d).select(*KEYS, "event_id", "rn", "cost1", "cost2")


@register("rolling_max7", doubles=["cost1", "test1"], ctes=MARKS[:4],
          sql="SELECT sample_id, chrom, event_id, rn, cost1, test1 FROM m_rm")
def q_rolling_max7(spark, d):
    return filtered(spark, d).select(*KEYS, "event_id", "rn", "cost1", "test1")


@register("short_seg_filter", doubles=["short_ab", "test2"], ctes=MARKS[:4],
          sql="SELECT sample_id, chrom, event_id, rn, short_ab, test2 FROM m_rm")
def q_short_seg_filter(spark, d):
    return filtered(spark, d).select(*KEYS, "event_id", "rn", "short_ab", "test2")


@register("running_sums", doubles=["s", "sq"], ctes=[("idx", IDX_SQL)], sql=f"""SELECT sample_id, chrom, event_id, rn,
  sum(x) OVER w AS s, sum(x * x) OVER w AS sq FROM idx
WINDOW w AS (PARTITION BY {KS} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_running_sums(spark, d):
    x = R.cumsum(R.cumsum(indexed(spark, d), KEYS, "x", "s"), KEYS, "x", "sq", square=True)
    return x.select(*KEYS, "event_id", "rn", "s", "sq")


@register("breakpoint_marks", doubles=["limit1", "limit2", "limit3"], ctes=MARKS,
          sql="SELECT sample_id, chrom, event_id, rn, mark, limit1, limit2, limit3 FROM m_mk")
def q_breakpoint_marks(spark, d):
    return marked(spark, d).select(*KEYS, "event_id", "rn", "mark", "limit1", "limit2", "limit3")


@register("block_compaction", doubles=["sm", "sq"], ctes=MARKS + [
    ("blk", f"""SELECT *, coalesce(sum(CAST(mark AS INT)) OVER (PARTITION BY {KS} ORDER BY rn
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_id FROM m_mk""")],
    sql="""SELECT sample_id, chrom, block_id, count(*) AS nr, sum(x) AS sm, sum(x * x) AS sq, max(rn) AS end_rn, first(n) AS n
FROM blk GROUP BY 1, 2, 3""")
def q_block_compaction(spark, d):
    return R.compact(R.block_ids(marked(spark, d), KEYS), KEYS, "x")
