"""DuckDB text of the fixture views (FIXTURES.md §2) and a helper that prefixes them as CTEs.

The oracle statements in ``oracle.py`` reference these names; ``with_views`` adds exactly the
views a statement needs, in dependency order.
"""

from __future__ import annotations

import re

# The view definitions of FIXTURES.md §2 (DuckDB dialect), plus a constant sample id.
VIEWS: dict[str, str] = {
    "v_loci": """SELECT p_partkey AS locus, CAST(p_partkey % 23 + 1 AS INT) AS chrom_ord,
       CASE WHEN p_partkey % 23 = 22 THEN 'chrX' ELSE concat('chr', CAST(p_partkey % 23 + 1 AS VARCHAR)) END AS chrom,
       CAST(floor(p_partkey / 23) AS INT) * 1000 + 1 AS position,
       CAST(1 + p_size % 4 AS INT) AS a0, CAST(1 + (p_size + 1 + p_partkey % 3) % 4 AS INT) AS a1
FROM part""",
    "v_bases_raw": """SELECT l_partkey AS locus, CASE WHEN l_linenumber <= 4 THEN 'tumour' ELSE 'normal' END AS sample_kind,
       substr('ACGT', CAST(1 + (l_orderkey + l_suppkey) % 4 AS INT), 1) AS base,
       CAST(l_quantity AS INT) AS baseq, CAST(l_orderkey % 60 AS INT) AS mapq
FROM lineitem""",
    "v_bases": """SELECT 'S1' AS sample_id, b.sample_kind, l.chrom, l.position, b.base, b.baseq, b.mapq
FROM v_bases_raw b JOIN v_loci l ON b.locus = l.locus""",
    "v_phased": """SELECT locus, chrom, position, substr('ACGT', a0, 1) AS ref, substr('ACGT', a1, 1) AS alt,
       CASE locus % 4 WHEN 0 THEN '0|1' WHEN 1 THEN '1|0' WHEN 2 THEN '0|0' ELSE '1|1' END AS gt FROM v_loci""",
    "v_problem": "SELECT chrom, position FROM v_loci WHERE locus % 17 = 0",
    "v_snps": """SELECT concat('rs', CAST(locus AS VARCHAR)) AS id, chrom, position,
       substr('ACGT', a0, 1) AS a0, substr('ACGT', a1, 1) AS a1 FROM v_loci""",
    "v_series": """SELECT 'S1' AS sample_id, event_type AS chrom, event_id,
       datediff('second', TIMESTAMP '2024-01-01 00:00:00', ts) AS position,
       value / (value + 50.0) AS baf, log2((value + 1.0) / 50.0) AS logr FROM events""",
    "v_breakpoints": "SELECT sample_id, chrom, position FROM v_series WHERE event_id % 500 = 0",
    "v_segments": """SELECT sample_id, chrom, day, greatest(mean, 1 - mean) AS b, r, length, length AS size, mean, sd FROM (
  SELECT sample_id, chrom, CAST(floor(position / 86400) AS INT) AS day, avg(baf) AS mean, avg(logr) AS r,
         count(*) AS length, stddev_samp(baf) AS sd FROM v_series GROUP BY 1, 2, 3)""",
    "v_planted": """SELECT 'S1' AS sample_id, seg_id, length, nmaj, nmin,
       (CAST(0.3 AS DOUBLE) + CAST(0.7 AS DOUBLE) * nmaj) / (CAST(0.6 AS DOUBLE) + CAST(0.7 AS DOUBLE) * (nmaj + nmin)) AS b,
       log2((CAST(0.6 AS DOUBLE) + CAST(0.7 AS DOUBLE) * (nmaj + nmin)) / (CAST(0.6 AS DOUBLE) + CAST(0.7 AS DOUBLE) * psi_true)) AS r
FROM (SELECT p_partkey AS seg_id, CAST(20 + p_size AS INT) AS length,
             CASE p_partkey % 5 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 1 END AS nmaj,
             CASE p_partkey % 5 WHEN 1 THEN 0 ELSE 1 END AS nmin FROM part) st
CROSS JOIN (SELECT CAST(sum(length * (nmaj + nmin)) AS DOUBLE) / CAST(sum(length) AS DOUBLE) AS psi_true
            FROM (SELECT CAST(20 + p_size AS INT) AS length,
                         CASE p_partkey % 5 WHEN 2 THEN 2 WHEN 3 THEN 3 ELSE 1 END AS nmaj,
                         CASE p_partkey % 5 WHEN 1 THEN 0 ELSE 1 END AS nmin FROM part)) pl""",
    "v_bafseg": """SELECT sample_id, chrom, position, event_id, baf_phased,
       avg(baf_phased) OVER (PARTITION BY sample_id, chrom, CAST(floor(position / 86400) AS INT)) AS baf_seg
FROM (SELECT *, CASE WHEN avg(baf) OVER (PARTITION BY sample_id, chrom, CAST(floor(position / 86400) AS INT)) > 0.5
                     THEN baf ELSE 1 - baf END AS baf_phased FROM v_series)""",
    "v_contigs": """SELECT l.chrom, CAST(max(l.position) AS BIGINT) AS length,
       CAST(CASE WHEN l.chrom = 'chrX' THEN floor(count(*) / 2) ELSE count(*) END AS BIGINT) AS mapped,
       CAST(0 AS BIGINT) AS unmapped
FROM v_loci l JOIN v_bases_raw b ON l.locus = b.locus GROUP BY l.chrom
UNION ALL SELECT 'chrM', 16569, 900, 0 UNION ALL SELECT 'chr1_alt', 500, 9, 0 UNION ALL SELECT '*', 0, 0, 77""",
    "v_tumour": """SELECT sample_id, CAST(c AS VARCHAR) AS chrom, position, segno, state,
       (1 - rho + rho * maj) / (2 - 2 * rho + rho * (maj + mnr)) + 0.12::DOUBLE * (h / 1009.0::DOUBLE - 0.5) AS baf_phased,
       log2((2 - 2 * rho + rho * (maj + mnr)) / (2 - 2 * rho + rho * psi)) + 0.3::DOUBLE * ((h * 31 % 1009) / 1009.0::DOUBLE - 0.5) AS logr
FROM (SELECT *, avg(maj + mnr) OVER (PARTITION BY sample_id) AS psi
FROM (SELECT *, ([1.0, 2.0, 1.0, 2.0, 3.0, 2.0, 1.6]::DOUBLE[])[state + 1] AS maj, ([1.0, 1.0, 0.0, 2.0, 1.0, 0.0, 1.0]::DOUBLE[])[state + 1] AS mnr,
  ([0.75, 0.6, 0.85]::DOUBLE[])[CAST(substr(sample_id, 2, 1) AS INT)] AS rho
FROM (SELECT *, CAST((c * 2 + segno * 3) % 7 AS INT) AS state
FROM (SELECT *, CAST(position // 2048 AS INT) AS segno
FROM (SELECT concat('S', CAST(l_suppkey % 3 + 1 AS VARCHAR)) AS sample_id, CAST(l_orderkey % 22 + 1 AS INT) AS c, (l_orderkey // 22) * 8 + l_linenumber AS position,
  min((l_orderkey * 7919 + l_linenumber * 104729 + l_suppkey * 1299709) % 1009) AS h FROM lineitem GROUP BY 1, 2, 3)))))""",
    "v_tumseg": "SELECT *, avg(baf_phased) OVER (PARTITION BY sample_id, chrom, segno) AS baf_seg FROM v_tumour",
}

_ORDER = list(VIEWS)


def _needed(sql: str) -> list[str]:
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(VIEWS[name])

    visit(sql)
    return [n for n in _ORDER if n in seen]


def with_views(sql: str, ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with the fixture views it mentions and any extra ``(name, sql)`` CTEs."""
    extra = ctes or []
    text = sql + " ".join(s for _, s in extra)
    parts = [f"{n} AS ({VIEWS[n]})" for n in _needed(text)]
    parts += [f"{n} AS ({s})" for n, s in extra]
    return ("WITH " + ",\n".join(parts) + "\n" + sql) if parts else sql
