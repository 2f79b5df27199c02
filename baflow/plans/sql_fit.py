"""DuckDB text for the fit stage, following ``operators/fit.py`` formula by formula."""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format


def cells_sql(psi_min, psi_by, n_psi, rho_min, rho_by, n_rho) -> str:
    return (f"SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, {D(psi_min)} + i * {D(psi_by)} AS psi, "
            f"{D(rho_min)} + j * {D(rho_by)} AS rho, {n_psi} AS n_psi, {n_rho} AS n_rho "
            f"FROM range(0, {n_psi}) a(i) CROSS JOIN range(0, {n_rho}) b(j)")


def nab(b="b", r="r", rho="rho", psi="psi", gamma=1.0):
    k = f"(pow({D(2.0)}, {r} / {D(gamma)}) * ((1 - {rho}) * 2 + {rho} * {psi}))"
    return f"({rho} - 1 - ({b} - 1) * {k}) / {rho}", f"({rho} - 1 + {b} * {k}) / {rho}"


def distance_sql(segs: str, cells: str, choice: int, gamma=1.0, thr=0.51) -> list[tuple[str, str]]:
    """CTEs ``dx`` (rows) and ``dist`` (per cell) for distance choice 0..3."""
    na, nb = nab(gamma=gamma)
    dev = lambda x: f"({x} - greatest(round_even({x}, 0), {D(0.0)}))"
    half = lambda x: f"pow({D(0.5)} - abs({dev(x)}), 2)"
    both = f"({half('na')} + {half('nb')})"
    hom = "(na < 0.5 AND nb < 0.5 AND na >= 0 AND nb >= 0)"
    info = f"CASE WHEN b <= {D(thr)} THEN {D(0.05)} ELSE {D(1.0)} END"
    not_half = f"CASE WHEN b = 0.5 THEN {D(0.0)} ELSE {D(1.0)} END"
    zero = f"(CASE WHEN round_even(na, 0) = 0 THEN w ELSE {D(0.0)} END + CASE WHEN round_even(nb, 0) = 0 THEN w ELSE {D(0.0)} END)"
    d = {0: "CASE WHEN sa < sb THEN d0a ELSE d0b END", 1: "CASE WHEN sa < sb THEN d1a ELSE d1b END", 2: "d2", 3: "d3"}[choice]
    return [
        ("dx", f"""SELECT s.sample_id, c.*, s.b, s.r, s.w, s.cnt, {na} AS na, {nb} AS nb
FROM (SELECT sample_id, b, r, count(*) AS cnt, CAST(sum(length) AS DOUBLE) AS w FROM {segs} GROUP BY ALL) s
CROSS JOIN ({cells}) c"""),
        ("dagg", f"""SELECT sample_id, i, j, psi, rho, n_psi, n_rho, sum(na * cnt) AS sa, sum(nb * cnt) AS sb,
  sum(pow({dev('na')}, 2) * w * {info}) AS d0a, sum(pow({dev('nb')}, 2) * w * {info}) AS d0b,
  sum({half('na')} * w) AS d1a, sum({half('nb')} * w) AS d1b, 0.5 * sum({both} * w) AS d2,
  0.5 * sum(CASE WHEN {hom} THEN {both} * 4 * w * 2 ELSE {both} * w END) AS d3,
  sum((na + nb) * w) AS cn_w, sum(w) AS sw, sum({zero}) AS z, sum({zero} * {not_half}) AS zab,
  sum(w * {not_half}) AS wab, sum({D(0.25)} * w) AS max_dist
FROM dx GROUP BY ALL"""),
        ("dist", f"""SELECT sample_id, i, j, psi, rho, n_psi, n_rho, {d} AS d, {'true' if choice == 0 else 'false'} AS minimise,
  cn_w / sw AS ploidy, z / sw AS percentzero,
  CASE WHEN wab = 0 THEN {D(0.0)} ELSE zab / wab END AS perczero_abb, max_dist FROM dagg"""),
    ]


def minima_sql(src: str, fallback: bool, p) -> list[tuple[str, str]]:
    """CTEs ``lm_*`` for strict 7x7 local minima with goodness and acceptance (fallback variant)."""
    dm = "CASE WHEN minimise THEN d ELSE -d END"
    if fallback:
        dm = f"CASE WHEN rho > 1 THEN {D(1e20)} ELSE {dm} END"
    if fallback:
        ok = (f"ploidy > {D(p.min_ploidy)} AND ploidy < {D(p.max_ploidy)} AND rho >= {D(p.min_rho)} "
              f"AND goodness >= {D(p.min_goodness)}")
    else:
        ok = (f"ploidy >= {D(p.min_ploidy)} AND ploidy <= {D(p.max_ploidy)} AND rho >= {D(p.min_rho)} "
              f"AND goodness >= {D(p.min_goodness)} AND (percentzero > 0.01 OR perczero_abb > 0.1)")
    wi = "PARTITION BY sample_id, j ORDER BY i"
    wj = "PARTITION BY sample_id, i ORDER BY j"
    return [
        ("lm_a", f"SELECT *, {dm} AS dm FROM {src}"),
        ("lm_b", f"""SELECT *, min(dm) OVER ({wi} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS col_all,
  min(dm) OVER ({wi} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS col_up,
  min(dm) OVER ({wi} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS col_dn FROM lm_a"""),
        ("lm_c", f"""SELECT *, min(col_all) OVER ({wj} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS lft,
  min(col_all) OVER ({wj} ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS rgt FROM lm_b"""),
        ("lm_d", f"""SELECT * EXCLUDE (col_all, col_up, col_dn, lft, rgt),
  CASE WHEN minimise THEN (1 - dm / max_dist) * 100 ELSE -dm / max_dist * 100 END AS goodness
FROM lm_c WHERE i >= 3 AND i <= n_psi - 4 AND j >= 3 AND j <= n_rho - 4 AND least(lft, rgt, col_up, col_dn) > dm"""),
        ("lm", f"SELECT *, ({ok}) AS accepted FROM lm_d"),
    ]


def optimum_sql(strict_src: str, fb_src: str, samples: str) -> list[tuple[str, str]]:
    return [
        ("cand", f"""SELECT * FROM {strict_src} WHERE accepted
UNION ALL SELECT * FROM {fb_src} f WHERE accepted AND f.sample_id NOT IN (SELECT sample_id FROM {strict_src} WHERE accepted)"""),
        ("best", """SELECT sample_id, psi, rho, ploidy, goodness, count(*) OVER (PARTITION BY sample_id) AS n_optima
FROM cand QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY dm ASC, i DESC, j DESC) = 1"""),
        ("opt", f"""SELECT s.sample_id, b.psi, CASE WHEN b.rho > 1 THEN {D(1.0)} ELSE b.rho END AS rho, b.ploidy, b.goodness, coalesce(b.n_optima, 0) AS n_optima,
  CASE WHEN coalesce(b.n_optima, 0) > 0 THEN CAST(b.n_optima AS VARCHAR) || ' copy number solutions found'
       ELSE 'no copy number solutions found' END AS status
FROM (SELECT DISTINCT sample_id FROM {samples}) s LEFT JOIN best b ON b.sample_id = s.sample_id"""),
    ]


def bounds_sql(opt: str, p) -> str:
    pr = 0.1 * (p.max_ploidy - p.min_ploidy)
    return f"""SELECT sample_id,
  CASE WHEN psi - 0.5 * {D(pr)} < {D(p.min_ploidy)} THEN {D(p.min_ploidy)} WHEN psi + 0.5 * {D(pr)} > {D(p.max_ploidy)} THEN {D(p.max_ploidy - pr)} ELSE psi - 0.5 * {D(pr)} END AS psi_min,
  CASE WHEN psi - 0.5 * {D(pr)} < {D(p.min_ploidy)} THEN {D(p.min_ploidy + pr)} WHEN psi + 0.5 * {D(pr)} > {D(p.max_ploidy)} THEN {D(p.max_ploidy)} ELSE psi + 0.5 * {D(pr)} END AS psi_max,
  CASE WHEN rho - 0.5 * (0.1 * rho) < {D(p.min_rho)} THEN {D(p.min_rho)} WHEN rho + 0.5 * (0.1 * rho) > {D(p.max_rho)} THEN {D(p.max_rho)} - 0.1 * rho ELSE rho - 0.5 * (0.1 * rho) END AS rho_min,
  CASE WHEN rho - 0.5 * (0.1 * rho) < {D(p.min_rho)} THEN {D(p.min_rho)} + 0.1 * rho WHEN rho + 0.5 * (0.1 * rho) > {D(p.max_rho)} THEN {D(p.max_rho)} ELSE rho + 0.5 * (0.1 * rho) END AS rho_max
FROM {opt} WHERE psi IS NOT NULL AND rho IS NOT NULL"""
