"""SQL (DuckDB) text of the Potts partition and of the two-pass phased segmentation, from their definitions."""

from __future__ import annotations

from baflow.plans.sql_series import mark_ctes, runmed_ctes


def on(a: str, b: str, keys: str) -> str:
    return " AND ".join(f"{a}.{k.strip()} = {b}.{k.strip()}" for k in keys.split(","))


def of(a: str, keys: str) -> str:
    return ", ".join(f"{a}.{k.strip()}" for k in keys.split(","))


def potts(keys: str, marks: str, penalty: str, kmin: int = 3) -> str:
    """Segments (keys, seg_idx, start_rn, end_rn, n_points, mean) of every series, by plain recursion over all starts:
    F(e) = min over s of F(s) + SSE(s, e) + gamma. ``marks`` has keys, rn, x, mark; ``penalty`` has keys, gamma."""
    return f"""SELECT * FROM (WITH RECURSIVE
blocks AS (SELECT {keys}, block_id, CAST(count(*) AS DOUBLE) AS nr, sum(x) AS sm, sum(x * x) AS sq FROM
  (SELECT *, coalesce(sum(CAST(mark AS INT)) OVER (PARTITION BY {keys} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
   AS block_id FROM {marks}) GROUP BY {keys}, block_id),
sums AS (SELECT {keys}, block_id, sum(nr) OVER w AS nr, sum(sm) OVER w AS sm, sum(sq) OVER w AS sq FROM blocks
  WINDOW w AS (PARTITION BY {keys} ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cum AS (SELECT {of('s', keys)}, count(*) AS k, list_prepend(0.0::DOUBLE, list(nr ORDER BY block_id)) AS n,
  list_prepend(0.0::DOUBLE, list(sm ORDER BY block_id)) AS s, list_prepend(0.0::DOUBLE, list(sq ORDER BY block_id)) AS q,
  first(p.gamma) AS gamma FROM sums s JOIN {penalty} p ON {on('p', 's', keys)} GROUP BY {of('s', keys)}),
rec AS (SELECT {keys}, CAST(0 AS BIGINT) AS e, [-gamma] AS cost, [CAST(0 AS BIGINT)] AS prev FROM cum
  UNION ALL SELECT {keys}, e + 1, list_append(cost, list_min(v)), list_append(prev, CAST(list_position(v, list_min(v)) - 1 AS BIGINT))
  FROM (SELECT r.*, list_transform(range(0, r.e + 1), lambda i: CASE
      WHEN i = 0 OR (c.n[r.e + 2] >= {2 * kmin} AND c.n[r.e + 2] - c.n[i + 1] >= {kmin})
      THEN r.cost[i + 1] + c.q[r.e + 2] - c.q[i + 1] - pow(c.s[r.e + 2] - c.s[i + 1], 2) / (c.n[r.e + 2] - c.n[i + 1]) + c.gamma
      ELSE 1e300 END) AS v
    FROM rec r JOIN cum c ON {on('c', 'r', keys)} WHERE r.e < c.k)),
back AS (SELECT {of('r', keys)}, r.prev, c.k AS e, r.prev[c.k + 1] AS s FROM rec r JOIN cum c ON {on('c', 'r', keys)} WHERE r.e = c.k
  UNION ALL SELECT {keys}, prev, s, prev[s + 1] FROM back WHERE s > 0)
SELECT {of('b', keys)}, row_number() OVER (PARTITION BY {of('b', keys)} ORDER BY b.e) - 1 AS seg_idx,
  CAST(c.n[b.s + 1] AS BIGINT) + 1 AS start_rn, CAST(c.n[b.e + 1] AS BIGINT) AS end_rn,
  CAST(c.n[b.e + 1] - c.n[b.s + 1] AS BIGINT) AS n_points, (c.s[b.e + 1] - c.s[b.s + 1]) / (c.n[b.e + 1] - c.n[b.s + 1]) AS mean
FROM back b JOIN cum c ON {on('c', 'b', keys)})"""


def noise_ctes(src: str, keys: str, prefix: str) -> list[tuple[str, str]]:
    """``{prefix}_sd`` (keys, sd) from ``src`` (keys, position, event_id, baf)."""
    p = prefix
    return [(f"{p}_f", f"""SELECT {keys}, event_id, position, x, row_number() OVER (PARTITION BY {keys} ORDER BY position, event_id) AS rn,
  count(*) OVER (PARTITION BY {keys}) AS n
FROM (SELECT {keys}, event_id, position, CASE WHEN baf < 0.5 THEN baf ELSE 1 - baf END AS x FROM {src}) WHERE x <> 0""")] \
        + runmed_ctes(f"{p}_f", keys, f"{p}r") + [
        (f"{p}_d", f"SELECT *, x - rm AS dif, median(x - rm) OVER (PARTITION BY {keys}) AS md FROM {p}r_rm"),
        (f"{p}_m", f"SELECT {keys}, 1.4826 * median(abs(dif - md)) AS mad FROM {p}_d GROUP BY {keys}"),
        (f"{p}_sd", f"""SELECT {of('k', keys)}, greatest(coalesce(m.mad, 0.0), 0.09) AS sd
FROM (SELECT DISTINCT {keys} FROM {src}) k LEFT JOIN {p}_m m ON {on('m', 'k', keys)}""")]


def pass_ctes(src: str, keys: str, prefix: str, factor: float, sd: str, kmin: int = 3) -> list[tuple[str, str]]:
    """``{prefix}_fit``: the rows of ``src`` (keys, rn, n, x) with the mean of their segment as ``fit``."""
    p = prefix
    return [(f"{p}_long", f"SELECT * FROM {src} WHERE n >= {2 * kmin}")] + mark_ctes(f"{p}_long", keys, kmin, f"{p}m") + [
        (f"{p}_pen", f"SELECT {keys}, {factor} * sd AS gamma FROM {sd}"),
        (f"{p}_seg", potts(keys, f"{p}m_mk", f"{p}_pen", kmin)),
        (f"{p}_fit", f"""SELECT s.*, CASE WHEN s.n < {2 * kmin} THEN avg(s.x) OVER (PARTITION BY {of('s', keys)}) ELSE g.mean END AS fit
FROM {src} s LEFT JOIN {p}_seg g ON {on('g', 's', keys)} AND s.rn BETWEEN g.start_rn AND g.end_rn""")]


def value_ctes(src: str, keys: str, prefix: str, option: int) -> list[tuple[str, str]]:
    """``{prefix}_v``: ``src`` (keys, rn, baf_seg, baf_phased) with the value of each run of equal ``baf_seg``."""
    p = prefix
    value = "med" if option == 1 else "CASE WHEN med IN (0.0, 1.0) THEN baf_seg ELSE med END"
    return [(f"{p}_c", f"""SELECT *, CASE WHEN lag(baf_seg) OVER w IS NULL OR lag(baf_seg) OVER w <> baf_seg THEN 1 ELSE 0 END AS chg
FROM {src} WINDOW w AS (PARTITION BY {keys} ORDER BY rn)"""),
            (f"{p}_r", f"""SELECT *, sum(chg) OVER (PARTITION BY {keys} ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM {p}_c"""),
            (f"{p}_v", f"""SELECT * EXCLUDE (chg, run, med) REPLACE ({value} AS baf_seg)
FROM (SELECT *, median(baf_phased) OVER (PARTITION BY {keys}, run) AS med FROM {p}_r)""")]


def two_pass_ctes(src: str, keys: str, gamma: float = 10.0, phasegamma: float = 3.0, option: int = 3, prefix: str = "t") -> list[tuple[str, str]]:
    """``{prefix}_out_v``: the phased segmentation of ``src`` (keys, position, event_id, baf); keys hold the presegment."""
    p = prefix
    order = f"PARTITION BY {keys} ORDER BY position, event_id"
    return [(f"{p}_idx", f"""SELECT {keys}, event_id, position, baf, baf AS x, row_number() OVER ({order}) AS rn,
  count(*) OVER (PARTITION BY {keys}) AS n FROM {src}""")] + noise_ctes(src, keys, f"{p}n") \
        + pass_ctes(f"{p}_idx", keys, f"{p}a", phasegamma, f"{p}n_sd") + [
        (f"{p}_flip", f"""SELECT * EXCLUDE (fit) REPLACE (CASE WHEN fit > 0.5 THEN baf ELSE 1 - baf END AS x), fit AS temp_baf_segm
FROM {p}a_fit""")] + pass_ctes(f"{p}_flip", keys, f"{p}b", gamma, f"{p}n_sd") + [
        (f"{p}_out", f"SELECT * EXCLUDE (x, fit), x AS baf_phased, fit AS baf_seg FROM {p}b_fit")] + value_ctes(f"{p}_out", keys, f"{p}_out", option)
