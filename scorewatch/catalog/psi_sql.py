"""SQL for PSI and KS, spelled out bucket by bucket for every group."""

from __future__ import annotations

from collections.abc import Sequence


def _long(table: str, numeric: Sequence[str], by: str) -> str:
    parts = [f"SELECT {by}'{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {table} WHERE {c} IS NOT NULL" for c in numeric]
    return " UNION ALL ".join(parts)


def psi_ctes(
    numeric: Sequence[str] = (), categorical: Sequence[str] = (), by: str | None = None,
    ref: str = "ref", cur: str = "cur", prefix: str = "",
) -> str:
    """CTEs ending in ``{prefix}psi(grp, feature, psi)``; ``by`` is an expression of the current side."""
    x = prefix
    grp = by or "0"
    ctes = []
    shares_r, shares_c = [], []
    if numeric:
        ctes.append(f"""
{x}rv AS ({_long(ref, numeric, '')}),
{x}cv AS ({_long(cur, numeric, grp + ' AS grp, ')}),
{x}rs AS (SELECT feature, list_sort(list(v)) AS vs, count(*) AS n, count(DISTINCT v) AS d FROM {x}rv GROUP BY feature),
{x}rq AS (SELECT feature, vs, n, least(10, d) AS q FROM {x}rs WHERE d > 1),
{x}rp AS (SELECT feature, vs, n, q, unnest(range(0, q + 1)) AS i FROM {x}rq),
{x}rh AS (SELECT feature, vs, (n - 1) * (CASE WHEN i = q THEN 1.0::DOUBLE ELSE i * (1.0::DOUBLE / q) END) AS h FROM {x}rp),
{x}re AS (SELECT feature, vs[CAST(floor(h) AS BIGINT) + 1] AS a, vs[CAST(ceil(h) AS BIGINT) + 1] AS b, h - floor(h) AS t FROM {x}rh),
{x}edges AS (SELECT feature, list_sort(list_distinct(list(
      CASE WHEN t >= 0.5 THEN b - (b - a) * (1 - t) ELSE a + (b - a) * t END))) AS es FROM {x}re GROUP BY feature),
{x}rb AS (SELECT feature, CASE WHEN v = es[1] THEN 1 ELSE len(list_filter(es, lambda e: e < v)) END AS b, len(es) AS m
       FROM {x}rv JOIN {x}edges USING (feature)),
{x}cb AS (SELECT grp, feature, CASE WHEN v = es[1] THEN 1 ELSE len(list_filter(es, lambda e: e < v)) END AS b, len(es) AS m
       FROM {x}cv JOIN {x}edges USING (feature))""")
        shares_r.append(f"SELECT feature, CAST(b AS VARCHAR) AS k FROM {x}rb WHERE b >= 1 AND b < m")
        shares_c.append(f"SELECT grp, feature, CAST(b AS VARCHAR) AS k FROM {x}cb WHERE b >= 1 AND b < m")
    for c in categorical:
        shares_r.append(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS k FROM {ref} WHERE {c} IS NOT NULL")
        shares_c.append(f"SELECT {grp} AS grp, '{c}' AS feature, CAST({c} AS VARCHAR) AS k FROM {cur} WHERE {c} IS NOT NULL")
    names = ", ".join(f"('{c}')" for c in (*numeric, *categorical))
    ctes.append(f"""
{x}rk AS (SELECT feature, k, count(*) AS n FROM ({' UNION ALL '.join(shares_r)}) GROUP BY feature, k),
{x}ck AS (SELECT grp, feature, k, count(*) AS n FROM ({' UNION ALL '.join(shares_c)}) GROUP BY grp, feature, k),
{x}rshare AS (SELECT feature, k, n / CAST(sum(n) OVER (PARTITION BY feature) AS DOUBLE) AS r FROM {x}rk),
{x}cshare AS (SELECT grp, feature, k, n / CAST(sum(n) OVER (PARTITION BY grp, feature) AS DOUBLE) AS c FROM {x}ck),
{x}seen AS (SELECT DISTINCT grp, feature FROM {x}cshare),
{x}grid AS (SELECT grp, feature, k FROM {x}seen JOIN {x}rshare USING (feature) UNION SELECT grp, feature, k FROM {x}cshare),
{x}terms AS (SELECT g.grp, g.feature, coalesce(c, 1e-6::DOUBLE) AS c, coalesce(r, 1e-6::DOUBLE) AS r
       FROM {x}grid g LEFT JOIN {x}rshare s ON g.feature = s.feature AND g.k = s.k
       LEFT JOIN {x}cshare t ON g.grp = t.grp AND g.feature = t.feature AND g.k = t.k),
{x}sums AS (SELECT grp, feature, sum((c - r) * ln(c / r)) AS psi FROM {x}terms GROUP BY grp, feature),
{x}groups AS (SELECT DISTINCT {grp} AS grp FROM {cur}),
{x}psi AS (SELECT g.grp, f.feature, coalesce(CASE WHEN f.feature IN (SELECT feature FROM {x}rshare) THEN s.psi END, 0.0::DOUBLE) AS psi
       FROM {x}groups g CROSS JOIN (VALUES {names}) f(feature)
       LEFT JOIN {x}sums s ON s.grp = g.grp AND s.feature = f.feature)""")
    return ",".join(ctes)


def ks_ctes(numeric: Sequence[str], ref: str = "ref", cur: str = "cur") -> str:
    """CTEs ending in ``ks(feature, ks)``."""
    return f"""
kp AS (SELECT feature, v, sum(r) AS r, sum(c) AS c FROM (
         SELECT feature, v, 1 AS r, 0 AS c FROM ({_long(ref, numeric, '')})
         UNION ALL SELECT feature, v, 0, 1 FROM ({_long(cur, numeric, '')})) GROUP BY feature, v),
kc AS (SELECT feature,
         CAST(sum(r) OVER w AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY feature) AS DOUBLE)
       - CAST(sum(c) OVER w AS DOUBLE) / CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS gap
       FROM kp WINDOW w AS (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT feature, max(abs(gap)) AS ks FROM kc GROUP BY feature)"""
