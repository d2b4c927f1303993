"""SQL of the principal lenses for the checking engine, written from their rules and not from the lenses' text.

Where a lens uses windows this uses lookups of single rows, and money is whole cents here.
"""

from __future__ import annotations

_L = """l AS (SELECT l_orderkey AS invoice, o_custkey AS brand, l_linenumber % 2 AS odd, CAST(date_trunc('month', l_shipdate) AS DATE) AS m, CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))), 2) * 100 AS HUGEINT) AS c,
  l_returnflag IN ('A', 'N') AS base, l_linestatus = 'F' AS paid FROM lineitem, orders WHERE l_orderkey = o_orderkey)"""
_MONTHS = "12 * (year({a}) - year({b})) + month({a}) - month({b})"
_BANDS = f"CASE WHEN {_MONTHS.format(a='x.m', b='f.m')} < 12 THEN 10 WHEN {_MONTHS.format(a='x.m', b='f.m')} < 18 THEN 6 ELSE 3 END"
_CELL = f"""{_L}, x AS (SELECT brand, odd, m, sum(c) FILTER (WHERE base AND paid) AS got, sum(c) FILTER (WHERE base) AS billed, sum(c) FILTER (WHERE NOT base) AS back, count(*) AS n FROM l GROUP BY ALL), f AS (SELECT brand, min(m) AS m FROM l WHERE base GROUP BY ALL),
r AS (SELECT x.*, CASE WHEN f.m IS NULL THEN 10 ELSE {_BANDS} END AS pct FROM x LEFT JOIN f ON f.brand = x.brand)"""
_OWED = f"""{_CELL}, o AS (SELECT brand, sum((coalesce(got, 0) * pct + 50) // 100) AS owed, sum(got) AS got FROM r GROUP BY brand), k AS (SELECT o.*, (SELECT CAST(round(c_acctbal * 100) AS HUGEINT) FROM customer WHERE c_custkey = o.brand AND c_acctbal > 0) AS paid FROM o)"""

_WORD = "CASE event_type WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 3 WHEN 'view' THEN 4 WHEN 'error' THEN 5 END"
_GRADE = "1 + (value >= 20)::INT + (value >= 40)::INT + (value >= 60)::INT + (value >= 80)::INT + (value >= 95)::INT"

_GRID = f"""{_L}, a AS (SELECT brand, m, sum(c) AS c FROM l WHERE base AND paid GROUP BY ALL), g AS (SELECT f.brand, CAST(s.m AS DATE) AS m FROM (SELECT brand, min(m) AS lo FROM a GROUP BY brand) f, LATERAL (SELECT unnest(generate_series(f.lo, (SELECT max(m) FROM a), INTERVAL 1 MONTH)) AS m) s),
p AS (SELECT g.brand, g.m, a.c, b.m AS before, y.c AS last FROM g LEFT JOIN a ON a.brand = g.brand AND a.m = g.m ASOF LEFT JOIN a b ON b.brand = g.brand AND b.m < g.m LEFT JOIN a y ON y.brand = g.brand AND y.m = CAST(g.m - INTERVAL 1 MONTH AS DATE)),
q AS (SELECT *, CASE WHEN before IS NOT NULL THEN 12 * (year(m) - year(before)) + month(m) - month(before) END AS gap FROM p),
s AS (SELECT brand, m, c, CASE WHEN c > 0 THEN CASE WHEN gap IS NULL THEN 'new' WHEN gap >= 4 THEN 're_engaged' WHEN 2 * c <= last THEN 'at_risk' ELSE 'producing' END WHEN gap >= 6 THEN 'churned' WHEN gap >= 3 THEN 'dormant' ELSE 'quiet' END AS state FROM q)"""

SQL = {
    "ledger_monthly": f"""WITH {_CELL} SELECT r.brand, CASE odd WHEN 1 THEN 'A' ELSE 'B' END AS product, CAST(r.m AS VARCHAR) AS month, CAST(got AS DOUBLE) / 100 AS collected, CAST(billed AS DOUBLE) / 100 AS billed, CAST(back AS DOUBLE) / 100 AS refunded, n AS n_lines,
CAST(pct AS DOUBLE) / 100 AS rate, CAST((got * pct + 50) // 100 AS DOUBLE) / 100 AS fee FROM r""",
    "claim_floor": f"""WITH {_OWED} SELECT brand, CAST(got AS DOUBLE) / 100 AS collected, CAST(owed AS DOUBLE) / 100 AS owed, CAST(paid AS DOUBLE) / 100 AS paid, CAST(CASE WHEN owed > coalesce(paid, 0) THEN owed - coalesce(paid, 0) ELSE 0 END AS DOUBLE) / 100 AS claim FROM k""",
    "status_grid": f"WITH {_GRID} SELECT brand, CAST(m AS VARCHAR) AS month, state, CAST(c AS DOUBLE) / 100 AS collected FROM s",
    "status_latest": f"WITH {_GRID} SELECT brand, CAST(max(m) AS VARCHAR) AS month, arg_max(state, m) AS state FROM s GROUP BY brand",
    "movement": f"""WITH {_GRID}, w AS (SELECT s.*, b.state AS was FROM s LEFT JOIN s b ON b.brand = s.brand AND b.m = CAST(s.m - INTERVAL 1 MONTH AS DATE)), n AS (SELECT m, sum((state = 'new')::INT) AS a, sum((state = 're_engaged')::INT) AS r, sum((state = 'churned' AND coalesce(was, '') <> 'churned')::INT) AS c FROM w GROUP BY m)
SELECT CAST(m AS VARCHAR) AS month, CAST(a AS BIGINT) AS added, CAST(r AS BIGINT) AS re_engaged, CAST(c AS BIGINT) AS churned, CAST(a + r - c AS BIGINT) AS net FROM n""",
    "cohort_retention": f"""WITH {_L}, a AS (SELECT brand, m FROM l WHERE base AND paid GROUP BY ALL), b AS (SELECT *, (SELECT min(m) FROM a z WHERE z.brand = a.brand) AS c FROM a)
SELECT CAST(c AS VARCHAR) AS cohort, {_MONTHS.format(a='m', b='c')} AS months_since, count(*) AS retained, (SELECT count(DISTINCT brand) FROM b y WHERE y.c = b.c) AS cohort_size, round(count(*) / (SELECT count(DISTINCT brand) FROM b y WHERE y.c = b.c), 6) AS share FROM b GROUP BY c, m""",
    "verdict": f"""WITH s AS (SELECT user_id AS brand, event_type AS signal, {_WORD} AS word, {_GRADE} AS grade FROM events WHERE event_type IN ('purchase', 'signup', 'click', 'view', 'error')),
b AS (SELECT brand FROM s UNION SELECT c_custkey FROM customer WHERE c_acctbal < -800 OR c_acctbal > 9500),
x AS (SELECT brand, (SELECT CASE WHEN c_acctbal < 0 THEN 'no' ELSE 'yes' END FROM customer WHERE c_custkey = brand AND (c_acctbal < -800 OR c_acctbal > 9500)) AS person, (SELECT list(DISTINCT word) FROM s WHERE s.brand = b.brand AND grade = 6) AS top,
  (SELECT max(grade) FROM s WHERE s.brand = b.brand) AS rank, (SELECT nullif(count(*), 0) FROM s WHERE s.brand = b.brand) AS n, (SELECT string_agg(signal, ', ' ORDER BY signal) FROM (SELECT DISTINCT signal FROM s WHERE s.brand = b.brand AND grade >= 5)) AS evidence FROM b)
SELECT brand, CASE WHEN person IS NOT NULL THEN person WHEN list_has_any(coalesce(top, []), [1, 2]) THEN 'yes' WHEN list_contains(coalesce(top, []), 5) THEN 'no' ELSE 'unknown' END AS verdict,
CASE WHEN person IS NOT NULL THEN 'human' WHEN list_contains(coalesce(top, []), 1) THEN 'definitive' WHEN list_contains(coalesce(top, []), 2) THEN 'claimed' WHEN list_contains(coalesce(top, []), 5) THEN 'legal' ELSE 'research' END AS tier, rank, n, evidence FROM x""",
    "ar_aging": f"""WITH {_OWED}, t AS (SELECT k.brand, owed - coalesce(paid, 0) AS claim, (SELECT min(m) FROM x WHERE x.brand = k.brand AND got > 0) AS oldest FROM k), u AS (SELECT *, {_MONTHS.format(a="DATE '2001-12-01'", b='oldest')} AS months FROM t WHERE claim > 0 AND oldest IS NOT NULL)
SELECT brand, CAST(claim AS DOUBLE) / 100 AS claim, CAST(oldest AS VARCHAR) AS oldest, months, CASE WHEN months > 6 THEN '6+' WHEN months > 3 THEN '3-6' WHEN months > 1 THEN '1-3' ELSE '0-1' END AS bucket FROM u""",
    "concentration": f"""WITH {_L}, b AS (SELECT m, brand, sum(c) AS c FROM l WHERE base AND paid GROUP BY ALL), w AS (SELECT m, l_suppkey AS k, sum(c) AS c FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, l_suppkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))), 2) * 100 AS HUGEINT) AS c
  FROM lineitem SEMI JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R' AND l_linestatus = 'F') GROUP BY ALL), g AS (SELECT m, sum(c) AS total, list(c ORDER BY c DESC) AS cs FROM b GROUP BY m), h AS (SELECT m, list(c ORDER BY c DESC) AS cs FROM w GROUP BY m)
SELECT CAST(g.m AS VARCHAR) AS month, round(CAST(g.cs[1] AS DOUBLE) / CAST(total AS DOUBLE), 6) AS top1, round(CAST(list_sum(g.cs[1:5]) AS DOUBLE) / CAST(total AS DOUBLE), 6) AS top5, round(CAST(list_sum(h.cs[1:3]) AS DOUBLE) / CAST(total AS DOUBLE), 6) AS partners3 FROM g JOIN h ON g.m = h.m""",
}
