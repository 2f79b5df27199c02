"""SQL (DuckDB) text for the ordered-series operators, mirroring ``operators/series.py`` step by step."""

from __future__ import annotations

D = "CAST({} AS DOUBLE)".format


def q7(src: str, keys: str, value: str, inset: str, prob: str, out: str) -> str:
    """Type-7 quantile of ``value`` over rows where ``inset`` holds, by ranks (same rule as Spark)."""
    return f"""SELECT * EXCLUDE (__in, __cnt, __rk, __h, __lo, __xlo, __xhi),
  CASE WHEN __h - __lo > 0 AND __xhi <> __xlo THEN (1 - (__h - __lo)) * __xlo + (__h - __lo) * __xhi ELSE __xlo END AS {out}
FROM (SELECT *, max(CASE WHEN __in AND __rk = __lo THEN {value} END) OVER (PARTITION BY {keys}) AS __xlo,
                max(CASE WHEN __in AND __rk = __lo + 1 THEN {value} END) OVER (PARTITION BY {keys}) AS __xhi
      FROM (SELECT *, floor(__h) AS __lo
            FROM (SELECT *, {D(1.0)} + (__cnt - 1) * ({prob}) AS __h
                  FROM (SELECT *, sum(CASE WHEN __in THEN 1 ELSE 0 END) OVER (PARTITION BY {keys}) AS __cnt,
                               row_number() OVER (PARTITION BY {keys}, __in ORDER BY {value}) AS __rk
                        FROM (SELECT *, ({inset}) AS __in FROM {src})))))"""


def mark_ctes(src: str, keys: str, kmin: int, prefix: str = "m") -> list[tuple[str, str]]:
    """CTEs computing cost1/test1/cost2/short_ab/test2/limits/mark from ``src`` (keys, rn, n, x)."""
    k = kmin
    w = f"PARTITION BY {keys} ORDER BY rn"
    S = lambda o: ("S" if o == 0 else (f"lead(S, {o}) OVER (PARTITION BY {keys} ORDER BY rn)" if o > 0
                                        else f"lag(S, {-o}, {D(0.0)}) OVER (PARTITION BY {keys} ORDER BY rn)"))
    hp = lambda L: f"abs(4 * S - {S(-3 * L)} - {S(-2 * L)} - {S(2 * L)} - {S(3 * L)})"
    m_len = f"(n - {3 * k} + 1)"
    frac1 = frac2 = D(0.15)
    p = prefix
    ctes = [
        (f"{p}_cs", f"SELECT *, sum(x) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS S FROM {src}"),
        (f"{p}_hp", f"""SELECT *,
  CASE WHEN rn >= 24 AND rn <= n - 24 THEN {hp(8)} ELSE {D(0.0)} END AS cost1,
  CASE WHEN rn >= 3 AND rn <= n - 3 THEN {hp(1)} ELSE {D(0.0)} END AS cost2,
  CASE WHEN rn <= {m_len} THEN abs(3 * ({S(2 * k - 1)} - {S(k - 1)}) - ({S(3 * k - 1)} - {S(-1)})) END AS short_ab
FROM {p}_cs"""),
        (f"{p}_rm", f"""SELECT *,
  CASE WHEN rn >= 4 AND rn <= n - 3 THEN max(cost1) OVER ({w} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) ELSE {D(0.0)} END AS test1,
  CASE WHEN rn >= 4 AND rn <= {m_len} - 3 THEN max(short_ab) OVER ({w} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) ELSE {D(0.0)} END AS test2
FROM {p}_hp"""),
        (f"{p}_c1", f"""SELECT *, sum(CASE WHEN cost1 >= {D(0.9)} * test1 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys}) AS cnt1,
  sum(CASE WHEN rn <= {m_len} AND short_ab >= {D(0.9)} * test2 THEN 1 ELSE 0 END) OVER (PARTITION BY {keys}) AS cnt3
FROM {p}_rm"""),
        (f"{p}_q1", q7(f"{p}_c1", keys, "cost1", f"cost1 >= {D(0.9)} * test1",
                       f"1 - least({D(0.8)}, {frac1} * n / cnt1)", "limit1")),
        (f"{p}_q2", q7(f"{p}_q1", keys, "cost2", "rn >= 3 AND rn <= n - 3", f"1 - {frac2}", "limit2")),
        (f"{p}_q3", q7(f"{p}_q2", keys, "short_ab", f"rn <= {m_len} AND short_ab >= {D(0.9)} * test2",
                       f"1 - least({D(0.8)}, {D(0.02)} * {m_len} / cnt3)", "limit3")),
        (f"{p}_h1", f"""SELECT * EXCLUDE (cnt1, cnt3), (rn <= {m_len} AND short_ab > limit3 AND short_ab > {D(0.9)} * test2) AS mark_h1
FROM {p}_q3"""),
        (f"{p}_mk", f"""SELECT * EXCLUDE (mark_h1), CASE WHEN rn = n THEN true
  WHEN rn <= {k - 1} OR (rn >= n - {k} + 1 AND rn <= n - 1) THEN false
  WHEN (rn >= {k} AND rn <= 23) OR (rn >= n - 23 AND rn <= n - {k}) THEN true
  ELSE (coalesce(cost1 > limit1 AND cost1 > {D(0.9)} * test1, false)
        OR coalesce(rn >= 3 AND rn <= n - 3 AND cost2 > limit2, false)
        OR coalesce(lag(mark_h1, {k - 1}) OVER ({w}), false)
        OR coalesce(lag(mark_h1, {2 * k - 1}) OVER ({w}), false)) END AS mark
FROM {p}_h1"""),
    ]
    return ctes


def runmed_ctes(src: str, keys: str, prefix: str = "r", half: int = 25) -> list[tuple[str, str]]:
    """CTEs for R runmed(x, 51, endrule = 'median') over ``src`` (keys, rn, n, x) -> column ``rm``."""
    p = prefix
    w = f"PARTITION BY {keys} ORDER BY rn"
    return [
        (f"{p}_h", f"""SELECT *, CAST(floor((least({2 * half + 1}, CASE WHEN n % 2 = 0 THEN n - 1 ELSE n END) - 1) / 2) AS INT) AS hh
FROM {src}"""),
        (f"{p}_c", f"""SELECT *, CASE WHEN rn > hh AND rn <= n - hh THEN (CASE
    WHEN hh = {half} THEN median(x) OVER ({w} ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)
    WHEN n % 2 = 1 THEN median(x) OVER (PARTITION BY {keys})
    WHEN rn = hh + 1 THEN median(CASE WHEN rn <= n - 1 THEN x END) OVER (PARTITION BY {keys})
    ELSE median(CASE WHEN rn >= 2 THEN x END) OVER (PARTITION BY {keys}) END) ELSE x END AS res,
  n - rn + 1 AS rev
FROM {p}_h"""),
        (f"{p}_hd", f"""SELECT {keys}, CAST((rn + 1) / 2 AS INT) AS ti,
  median(res) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS smh, rn AS src_rn
FROM {p}_c WHERE rn <= 2 * hh - 1 QUALIFY src_rn % 2 = 1"""),
        (f"{p}_tl", f"""SELECT {keys}, n - CAST((rev + 1) / 2 AS INT) + 1 AS ti,
  median(res) OVER (PARTITION BY {keys} ORDER BY rev ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS smt, rev AS src_rev
FROM {p}_c WHERE rev <= 2 * hh - 1 QUALIFY src_rev % 2 = 1"""),
        (f"{p}_sm", f"""SELECT c.*, CASE WHEN c.rn >= 2 AND c.rn <= c.hh AND c.hh >= 2 THEN hd.smh
  WHEN c.rn >= c.n - c.hh + 1 AND c.rn <= c.n - 1 AND c.hh >= 2 THEN tl.smt ELSE c.res END AS sm
FROM {p}_c c LEFT JOIN {p}_hd hd ON {' AND '.join(f'hd.{k.strip()} = c.{k.strip()}' for k in keys.split(','))} AND hd.ti = c.rn
LEFT JOIN {p}_tl tl ON {' AND '.join(f'tl.{k.strip()} = c.{k.strip()}' for k in keys.split(','))} AND tl.ti = c.rn"""),
        (f"{p}_rm", f"""SELECT * EXCLUDE (hh, res, rev, sm, s2, s3, t2, t3), CASE
  WHEN hh >= 1 AND rn = 1 THEN greatest(least(x, s2), least(greatest(x, s2), 3 * s2 - 2 * s3))
  WHEN hh >= 1 AND rn = n THEN greatest(least(x, t2), least(greatest(x, t2), 3 * t2 - 2 * t3))
  ELSE sm END AS rm
FROM (SELECT *, lead(sm, 1) OVER ({w}) AS s2, lead(sm, 2) OVER ({w}) AS s3,
             lag(sm, 1) OVER ({w}) AS t2, lag(sm, 2) OVER ({w}) AS t3 FROM {p}_sm)"""),
    ]
