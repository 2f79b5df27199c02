"""SQL (DuckDB) text of the clonal refinement, from its definitions (nothing is taken from ``operators``)."""

from __future__ import annotations

from baflow.plans.sql_fit import D, bounds_sql, cells_sql, distance_sql, minima_sql, optimum_sql

RUN_DOUBLES = ["psi_grid", "rho_without_ref", "goodness_grid", "ploidy_without_ref", "psi_t", "distance_without_ref", "psi_ref", "rho_ref", "ploidy_ref",
               "distance", "psi_without_ref"]
UNINFORMATIVE, SIGLEVEL, MAXDIST, DEPTH = 0.51, 0.05, 0.01, 30


def tail_sql(t: str, df: str) -> str:
    """Two-sided tail probability of Student's t for whole ``df`` as a finite series in cos(theta)^2, theta = atan(t / sqrt(df))."""
    c2 = f"({df} / ({df} + ({t}) * ({t})))"
    theta = f"atan(abs({t}) / sqrt({df}))"
    even = (f"sin({theta}) * coalesce(list_sum(list_transform(range(0, CAST({df} AS BIGINT) // 2), "
            f"lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1) + k * ln({c2})))), 0) / sqrt(pi())")
    odd = (f"2 / pi() * ({theta} + sin({theta}) * cos({theta}) * coalesce(list_sum(list_transform(range(0, (CAST({df} AS BIGINT) - 1) // 2), "
           f"lambda k: exp(lgamma(k + 1) - lgamma(k + 1.5) + k * ln({c2})))), 0) * sqrt(pi()) / 2)")
    return f"greatest(0.0, 1 - CASE WHEN CAST({df} AS BIGINT) % 2 = 0 THEN {even} ELSE {odd} END)"


def critical_sql(src: str) -> str:
    """(size, tcrit) for each distinct size: halving the interval in which the tail probability crosses the level."""
    return f"""SELECT size, (lo + hi) / 2 AS tcrit FROM (WITH RECURSIVE h AS (
  SELECT size, {D(0.0)} AS lo, {D(1000.0)} AS hi, 0 AS k FROM (SELECT DISTINCT size FROM {src})
  UNION ALL SELECT size, CASE WHEN p > {SIGLEVEL} THEN (lo + hi) / 2 ELSE lo END, CASE WHEN p > {SIGLEVEL} THEN hi ELSE (lo + hi) / 2 END, k + 1
  FROM (SELECT *, {tail_sql('((lo + hi) / 2)', 'CAST(size - 1 AS DOUBLE)')} AS p FROM h WHERE k < 60))
SELECT * FROM h WHERE k = 60)"""


def level(maj: str, mnr: str, rho: str = "rho") -> str:
    return f"CASE WHEN {maj} = 0 AND {mnr} = 0 THEN 0.5 ELSE (1 - {rho} + {rho} * {maj}) / (2 - 2 * {rho} + {rho} * ({maj} + {mnr})) END"


def tested_sql(src: str) -> str:
    """``src`` (b, r, size, sd, rho, psi, ...) with the tested state tmaj, tmin, its level lev, and ``kept`` (major copy number raised by less than 1)."""
    k = f"(pow({D(2.0)}, coalesce(r, 0.0)) * ((1 - rho) * 2 + rho * psi))"
    return f"""SELECT * EXCLUDE (na, nb, maj0, min0, maj, mnr, x, y, by_r, low, m1, m2), CASE WHEN m1 >= 0 AND m2 >= 0 THEN CAST(m1 AS BIGINT) END AS tmaj,
  CASE WHEN m1 >= 0 AND m2 >= 0 THEN CAST(m2 AS BIGINT) END AS tmin, CASE WHEN m1 >= 0 AND m2 >= 0 THEN {level('m1', 'm2')} END AS lev, maj - maj0 < 1 AS kept
FROM (SELECT *, CASE WHEN low OR by_r THEN y ELSE y + 1 END AS m1, CASE WHEN low AND NOT by_r THEN x + 1 ELSE x END AS m2
FROM (SELECT *, maj + mnr < x + y + 1 AS by_r,
    b <= {level('floor(maj)', 'floor(mnr)')} AND b <= {level('ceil(maj)', 'ceil(mnr)')} AS low
FROM (SELECT *, floor(mnr) AS x, floor(maj) AS y
FROM (SELECT *, CASE WHEN min0 < 0 THEN (CASE WHEN b = 1 OR maj0 + b * (0.01 - min0) / (1 - b) < 0 THEN {D(1000.0)} ELSE maj0 + b * (0.01 - min0) / (1 - b) END)
      ELSE maj0 END AS maj, CASE WHEN min0 < 0 THEN {D(0.01)} ELSE min0 END AS mnr
FROM (SELECT *, greatest(na, nb) AS maj0, least(na, nb) AS min0
FROM (SELECT *, round((rho - 1 - (b - 1) * {k}) / rho, 10) AS na, round((rho - 1 + b * {k}) / rho, 10) AS nb FROM {src}))))))"""


def clonal_sql(src: str, crit: str) -> str:
    """``tested_sql`` rows with ``clonal``: near the level or |t| below the critical value."""
    return f"""SELECT t.*, coalesce(t.kept AND t.sd <> 0 AND (abs(t.b - t.lev) < {MAXDIST}
  OR abs(t.b - t.lev) * sqrt(CAST(t.size AS DOUBLE)) / t.sd < c.tcrit), false) AS clonal
FROM ({tested_sql(src)}) t JOIN {crit} c ON c.size = t.size"""


def pvalue_sql() -> str:
    """p-value of a tested row (b, size, sd, lev)."""
    t = "((b - lev) * sqrt(CAST(size AS DOUBLE)) / sd)"
    return (f"CASE WHEN sd = 0 THEN 0.0 WHEN abs(b - lev) < {MAXDIST} THEN 1.0 ELSE {tail_sql(t, 'CAST(size - 1 AS DOUBLE)')} END")


def std_error_sql(src: str) -> str:
    """``src`` (b, r, size, mean, sd, rho, psi, ...) with tvar and included."""
    f = f"pow({D(2.0)}, coalesce(r, 0.0))"
    corners = "[[floor(mm), ceil(mn)], [ceil(mm), ceil(mn)], [floor(mm), floor(mn)], [ceil(mm), floor(mn)]]"
    return f"""SELECT * EXCLUDE (mm, mn, levels, best, mu),
  CASE WHEN size > 0 AND sd <> 0 AND len(levels) > 0 THEN (mean - mu) * sqrt(CAST(size AS DOUBLE)) / sd ELSE 0.0 END AS tvar,
  CASE WHEN size > 0 AND sd <> 0 AND len(levels) > 0 THEN 1 ELSE 0 END AS included
FROM (SELECT *, CASE WHEN len(levels) >= 3 AND best = 0.5 AND levels[2] = 0.5 AND levels[3] = 0.5 THEN 0.5 ELSE best END AS mu
FROM (SELECT *, levels[list_position(list_transform(levels, lambda l: abs(l - b)), list_min(list_transform(levels, lambda l: abs(l - b))))] AS best
FROM (SELECT *, list_transform(list_filter({corners}, lambda c: 2 - 2 * rho + rho * (c[1] + c[2]) <> 0),
    lambda c: (1 - rho + rho * c[1]) / (2 - 2 * rho + rho * (c[1] + c[2]))) AS levels
FROM (SELECT *, CASE WHEN m1 < 0 OR m1 IS NULL OR isnan(m1) THEN {D(0.01)} ELSE m1 END AS mm, CASE WHEN m2 < 0 OR m2 IS NULL OR isnan(m2) THEN {D(0.01)} ELSE m2 END AS mn
FROM (SELECT *, (rho - 1 + b * psi * {f}) / rho AS m1, (rho - 1 + (1 - b) * psi * {f}) / rho AS m2 FROM {src})))))"""


def likelihood_sql(src: str, corners: bool) -> str:
    """``src`` (b, r, size, mean, rho, psi, ...) with the binomial likelihood of the best candidate state and the log ratio of the best two."""
    f = f"pow({D(2.0)}, coalesce(r, 0.0))"
    states = "[[floor(maj), floor(mnr)], [floor(maj), ceil(mnr)], [ceil(maj), floor(mnr)], [ceil(maj), ceil(mnr)]]"
    if not corners:
        near = (f"maj + mnr < floor(maj) + floor(mnr) + 1", f"b <= {level('floor(maj)', 'floor(mnr)')} AND b <= {level('ceil(maj)', 'ceil(mnr)')}")
        states = (f"[[CASE WHEN ({near[0]}) OR ({near[1]}) THEN floor(maj) ELSE floor(maj) + 1 END, "
                  f"CASE WHEN ({near[1]}) AND NOT ({near[0]}) THEN floor(mnr) + 1 ELSE floor(mnr) END]]")
    ll = "(CASE WHEN k = 0 THEN 0 WHEN p <= 0 THEN '-inf'::DOUBLE ELSE k * ln(p) END + CASE WHEN n - k = 0 THEN 0 WHEN p >= 1 THEN '-inf'::DOUBLE ELSE (n - k) * ln(1 - p) END)"
    return f"""SELECT * EXCLUDE (maj, mnr, n, k, lls), exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + lls[1]) AS likelihood,
  CASE WHEN len(lls) < 2 OR isinf(lls[1]) THEN 0.0 ELSE lls[1] - lls[2] END AS ln_ratio
FROM (SELECT *, list_reverse_sort(list_transform(list_transform({states}, lambda c:
    least(greatest((1 - rho + rho * c[1]) / (2 - 2 * rho + rho * (c[1] + c[2])), 0.0), 1.0)), lambda p: {ll})) AS lls
FROM (SELECT *, least(greatest(round_even(mean * n, 0), 0.0), n) AS k
FROM (SELECT * EXCLUDE (m1, m2), {DEPTH} * CAST(size AS DOUBLE) AS n, CASE WHEN m2 < 0 THEN
    (CASE WHEN b = 1 OR m1 + b * (0.01 - m2) / (1 - b) < 0 THEN {D(1000.0)} ELSE m1 + b * (0.01 - m2) / (1 - b) END) ELSE m1 END AS maj,
    CASE WHEN m2 < 0 THEN {D(0.01)} ELSE m2 END AS mnr
FROM (SELECT *, (rho - 1 + b * psi * {f}) / rho AS m1, (rho - 1 + (1 - b) * psi * {f}) / rho AS m2 FROM {src}))))"""


def psi_t_sql(src: str, crit_level: float = SIGLEVEL) -> str:
    """(sample_id, psi_t) of ``src`` (segments with rho, psi of their sample, length)."""
    pt = f"((rho * (tmaj + tmin) + 2 - 2 * rho) / pow({D(2.0)}, r) - 2 * (1 - rho)) / rho"
    return f"""SELECT sample_id, sum(CASE WHEN c THEN {pt} * length END) / sum(CASE WHEN c THEN length END) AS psi_t
FROM (SELECT *, coalesce(kept AND {pvalue_sql()} > {crit_level}, false) AS c FROM ({tested_sql(src)})) GROUP BY sample_id"""


def ploidy_sql(src: str) -> str:
    """(sample_id, ploidy) of ``src`` (segments with rho, psi of their sample, length)."""
    k = f"(pow({D(2.0)}, r) * ((1 - rho) * 2 + rho * psi))"
    return f"""SELECT sample_id, sum(((rho - 1 - (b - 1) * {k}) / rho + (rho - 1 + b * {k}) / rho) * length) / sum(length) AS ploidy
FROM {src} GROUP BY sample_id"""


def fit_ctes(segs: str, p, coarse: dict, prefix: str = "") -> list[tuple[str, str]]:
    """CTEs of the whole fit from ``segs`` (sample_id, seg_idx, b, r, length, size, mean, sd): ``opt``, ``fc`` (fine cells), ``d0``, ``cen``, ``rc``, ``rho_psi``."""
    fb = [(n.replace("lm", "fb"), s.replace("lm_", "fb_")) for n, s in minima_sql("dist", True, p)]
    cells = cells_sql(coarse["psi_min"], 0.05, 89, coarse["rho_min"], 0.01, 97)
    return ([("asegs", f"SELECT sample_id, 1 - b AS b, r, length FROM {segs}_all")] + distance_sql("asegs", cells, 1) + minima_sql("dist", False, p) + fb
            + optimum_sql("lm", "fb", "asegs") + [
        ("nb", bounds_sql("opt", p)),
        ("fs", f"""SELECT *, CAST(floor((psi_max - psi_min) / psi_by + {D(1e-10)}) + 1 AS INT) AS n_psi,
  CAST(floor((rho_max - rho_min) / rho_by + {D(1e-10)}) + 1 AS INT) AS n_rho
FROM (SELECT *, (psi_max - psi_min) / 100 AS psi_by, (rho_max - rho_min) / 100 AS rho_by FROM nb)"""),
        ("fc", """SELECT sample_id, CAST(c AS INT) // n_rho AS i, CAST(c AS INT) % n_rho AS j,
  psi_min + (CAST(c AS INT) // n_rho) * psi_by AS psi, rho_min + (CAST(c AS INT) % n_rho) * rho_by AS rho
FROM fs, range(0, n_psi * n_rho) t(c)"""),
        ("informative", f"SELECT * FROM {segs} WHERE b > {UNINFORMATIVE}"),
        ("crit", critical_sql(segs)),
        ("grid", "SELECT s.*, c.i, c.j, c.psi, c.rho FROM informative s JOIN fc c ON c.sample_id = s.sample_id"),
        ("d0", f"""SELECT sample_id, i, j, psi, rho, sum(CASE WHEN clonal THEN CAST(size AS DOUBLE) ELSE 0 END) / sum(CAST(size AS DOUBLE)) AS d
FROM ({clonal_sql('grid', 'crit')}) GROUP BY ALL"""),
        ("scored", "SELECT *, max(round(d, 10)) OVER (PARTITION BY sample_id) AS top FROM d0"),
        ("tied", "SELECT *, median(i) OVER w AS ci, median(j) OVER w AS cj, count(*) OVER w AS n_optima, max(d) OVER w AS gmax "
                 "FROM scored WHERE round(d, 10) = top WINDOW w AS (PARTITION BY sample_id)"),
        ("cen0", """SELECT sample_id, i, j, psi, least(rho, 1.0) AS rho, rho AS rho_raw, gmax AS goodness, n_optima FROM tied
QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY pow(i - ci, 2) + pow(j - cj, 2), i DESC, j DESC) = 1"""),
        ("at_cen", "SELECT s.*, c.psi, c.rho_raw AS rho FROM informative s JOIN cen0 c ON c.sample_id = s.sample_id"),
        ("ref0", f"""SELECT sample_id, seg_idx AS ref_seg, tmaj AS ref_maj, tmin AS ref_min FROM ({clonal_sql('at_cen', 'crit')})
WHERE clonal AND tmaj <> tmin QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY size DESC, seg_idx) = 1"""),
        ("cen", "SELECT c.*, coalesce(r.ref_seg, 0) AS ref_seg, r.ref_maj, r.ref_min FROM cen0 c LEFT JOIN ref0 r ON r.sample_id = c.sample_id"),
        ("rp", f"""SELECT *, (pow({D(2.0)}, -r) * (2 + rho * (ref_maj + ref_min - 2)) - 2 * (1 - rho)) / rho AS psi
FROM (SELECT c.sample_id, s.r, c.ref_maj, c.ref_min, (2 * s.b - 1) / (2 * s.b - s.b * (c.ref_maj + c.ref_min) - 1 + c.ref_maj) AS rho
      FROM cen c JOIN {segs} s ON s.sample_id = c.sample_id AND s.seg_idx = c.ref_seg)"""),
        ("rpl", ploidy_sql(f"(SELECT s.*, q.rho, q.psi FROM {segs} s JOIN rp q ON q.sample_id = s.sample_id)")),
        ("ref", """SELECT p.sample_id, CASE WHEN p.rho > 0 THEN p.psi END AS psi, CASE WHEN p.rho > 0 THEN p.rho END AS rho,
  CASE WHEN p.rho > 0 THEN l.ploidy END AS ploidy FROM rp p JOIN rpl l ON l.sample_id = p.sample_id
UNION ALL SELECT sample_id, 2.0, 1.0, 2.0 FROM cen WHERE ref_seg = 0"""),
        ("at_ref", "SELECT s.*, q.psi, q.rho FROM informative s JOIN ref q ON q.sample_id = s.sample_id WHERE q.rho IS NOT NULL"),
        ("dref", f"""SELECT sample_id, sum(CASE WHEN clonal THEN CAST(size AS DOUBLE) ELSE 0 END) / sum(CAST(size AS DOUBLE)) AS d
FROM ({clonal_sql('at_ref', 'crit')}) GROUP BY sample_id"""),
        ("wo", ploidy_sql(f"(SELECT s.*, c.rho_raw AS rho, c.psi FROM {segs} s JOIN cen c ON c.sample_id = s.sample_id)")),
        ("pt", psi_t_sql(f"(SELECT s.*, c.rho, c.psi FROM {segs} s JOIN cen c ON c.sample_id = s.sample_id)")),
        ("rc0", """SELECT c.sample_id, c.psi AS psi_grid, c.rho AS rho_without_ref, c.goodness AS goodness_grid, c.n_optima, w.ploidy AS ploidy_without_ref,
  t.psi_t, (SELECT max(d) FROM d0 WHERE d0.sample_id = c.sample_id) AS distance_without_ref, q.psi AS psi_ref, q.rho AS rho_ref, q.ploidy AS ploidy_ref,
  CASE WHEN c.ref_seg = 0 THEN 1.0 WHEN q.rho IS NULL THEN 'inf'::DOUBLE ELSE x.d END AS distance, coalesce(t.psi_t, c.psi) AS psi_without_ref
FROM cen c JOIN wo w ON w.sample_id = c.sample_id LEFT JOIN pt t ON t.sample_id = c.sample_id
LEFT JOIN ref q ON q.sample_id = c.sample_id LEFT JOIN dref x ON x.sample_id = c.sample_id"""),
        ("rc", f"""SELECT *, coalesce(rho_ref IS NOT NULL AND psi_ref BETWEEN {p.min_ploidy} AND {p.max_ploidy} AND rho_ref BETWEEN {p.min_rho} AND {p.max_rho}
  AND distance > distance_without_ref, false) AS is_ref_better FROM rc0"""),
        ("rho_psi", """SELECT sample_id, status, 'ASCAT' AS method, rho, psi, ploidy, NULL::DOUBLE AS distance, NULL::BOOLEAN AS is_best FROM opt
UNION ALL SELECT r.sample_id, o.status, 'FRAC_GENOME', rho_without_ref, psi_without_ref, ploidy_without_ref, distance_without_ref, NOT is_ref_better
  FROM rc r JOIN opt o ON o.sample_id = r.sample_id
UNION ALL SELECT r.sample_id, o.status, 'REF_SEG', rho_ref, psi_ref, ploidy_ref, r.distance, is_ref_better FROM rc r JOIN opt o ON o.sample_id = r.sample_id"""),
    ])
