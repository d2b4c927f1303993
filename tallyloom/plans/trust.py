"""Trust lenses: invariants, coverage, integrity, freshness, close gates and period states."""

from __future__ import annotations

from .money import CLAIM, LINES, PAID, _ledger, money, ratio

LENSES: dict = {}
NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def lens(f):
    LENSES[f.__name__] = f
    return f


def _status(good: str = "0.90", fair: str = "0.50") -> str:
    return f"CASE WHEN total = 0 THEN 'empty' WHEN passed >= {good} * total THEN 'ok' WHEN passed >= {fair} * total THEN 'warn' ELSE 'fail' END"


CHECKS = """c AS (SELECT 'orphan_lines' AS name, count(*) AS total, count(o_orderkey) AS passed FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL SELECT 'orphan_invoices', count(*), count(c_custkey) FROM orders LEFT JOIN customer ON o_custkey = c_custkey
UNION ALL SELECT 'ledger_grain_unique', count(*), count(*) FILTER (WHERE n = 1) FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) g
UNION ALL SELECT 'discount_in_range', count(*), count(*) FILTER (WHERE l_discount BETWEEN 0 AND 1) FROM lineitem
UNION ALL SELECT 'event_value_known', count(*), count(value) FROM events
UNION ALL SELECT 'nation_has_region', count(*), count(r_regionkey) FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""


@lens
def invariants(d):
    """Checks that must fail on no row."""
    return f"WITH {CHECKS} SELECT name, passed, total, total - passed AS failed, {ratio('passed', 'total')} AS pct, CASE WHEN passed = total THEN 'ok' ELSE 'fail' END AS status FROM c"


@lens
def money_invariants(d):
    """Ledger invariants as counts of violations."""
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}
SELECT 'grain_unique' AS name, count(*) AS violations FROM (SELECT brand, product, month FROM ledger GROUP BY brand, product, month HAVING count(*) > 1) g
UNION ALL SELECT 'rate_on_ladder', count(*) FROM ledger WHERE rate NOT IN (0.10, 0.06, 0.03) UNION ALL SELECT 'claim_not_negative', count(*) FROM claim WHERE claim < 0
UNION ALL SELECT 'collected_within_billed', count(*) FROM ledger WHERE collected > billed UNION ALL SELECT 'unknown_not_zero', count(*) FROM ledger WHERE collected = 0"""


@lens
def coverage(d):
    return f"""WITH c AS (SELECT 'documents_labelled' AS name, count(*) AS total, count(l.doc_id) AS passed FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id UNION ALL SELECT 'customers_with_invoice', count(*), count(o.k) FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON c_custkey = o.k
UNION ALL SELECT 'customers_with_events', count(*), count(e.k) FROM customer LEFT JOIN (SELECT DISTINCT user_id AS k FROM events) e ON c_custkey = e.k) SELECT name, passed, total, {ratio('passed', 'total')} AS pct, {_status()} AS status FROM c"""


@lens
def integrity(d):
    """Canaries, relations that must not be empty, and reconciliations."""
    return f"""WITH {LINES}, t AS (SELECT sum(amount) AS total, max(amount) AS single FROM line)
SELECT 'canary_total' AS name, CASE WHEN total > 100000000000 THEN 'fail' ELSE 'ok' END AS status FROM t UNION ALL SELECT 'canary_single', CASE WHEN single > 50000000 THEN 'fail' ELSE 'ok' END FROM t
UNION ALL SELECT 'orders_not_empty', CASE WHEN count(*) > 0 THEN 'ok' ELSE 'fail' END FROM orders UNION ALL SELECT 'events_not_empty', CASE WHEN count(*) > 0 THEN 'ok' ELSE 'fail' END FROM events
UNION ALL SELECT 'lines_match_invoices', CASE WHEN (SELECT count(*) FROM line) = (SELECT count(*) FROM lineitem) THEN 'ok' ELSE 'fail' END UNION ALL SELECT 'suppliers_known', CASE WHEN (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) = 0 THEN 'ok' ELSE 'fail' END"""


FEEDS = """f AS (SELECT event_type AS feed, 'scheduled' AS kind, max(ts) AS last_at FROM events GROUP BY event_type UNION ALL SELECT CAST('invoices' AS STRING), 'manual', max(o_orderdate) FROM orders UNION ALL SELECT 'lines', 'manual', max(l_shipdate) FROM lineitem)"""


@lens
def source_freshness(d):
    """Hours since each feed's last record against its allowance."""
    return f"""WITH {FEEDS}, h AS (SELECT *, {d.hours(NOW, 'last_at')} AS hours FROM f)
SELECT feed, kind, round(hours, 4) AS hours, CASE WHEN kind = 'manual' THEN 'when filed' ELSE '3 h' END AS sla, CASE WHEN kind = 'manual' THEN 'manual' WHEN hours <= 3 THEN 'fresh' WHEN hours <= 24 THEN 'stale' ELSE 'very stale' END AS status FROM h"""


@lens
def freshness_registry(d):
    return f"""WITH {FEEDS}, r AS (SELECT 'click' AS feed, 26 AS threshold, true AS blocks UNION ALL SELECT 'purchase', 26, true UNION ALL SELECT 'invoices', 840, false)
SELECT f.feed, r.threshold, coalesce(r.blocks, false) AS blocks, CASE WHEN r.threshold IS NULL THEN 'unregistered' WHEN {d.hours(NOW, 'f.last_at')} <= r.threshold THEN 'current' ELSE 'late' END AS status FROM f LEFT JOIN r ON f.feed = r.feed"""


@lens
def freshness_decay(d):
    """100 halved with each half-life of 7 days since a user's last event, blended 0.7 to 0.3 with the mean value."""
    return f"""WITH u AS (SELECT user_id, max(ts) AS last_at, avg(value) AS mean FROM events GROUP BY user_id)
SELECT user_id, round(100 * power(0.5, {d.hours(NOW, 'last_at')} / 24 / 7), 4) AS freshness, round(0.7 * 100 * power(0.5, {d.hours(NOW, 'last_at')} / 24 / 7) + 0.3 * mean, 4) AS blended FROM u"""


PERIODS = """pin AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderkey AS version, CAST(o_totalprice AS DECIMAL(18,2)) AS figure, o_orderstatus AS st FROM orders),
latest AS (SELECT month, max(version) AS version, max_by(figure, version) AS figure, count(*) AS versions FROM pin GROUP BY month)"""


@lens
def period_state(d):
    """open, blocked, closed or restated."""
    return f"""WITH {PERIODS}, ev AS (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem), m AS (SELECT month FROM latest UNION SELECT month FROM ev)
SELECT CAST(m.month AS STRING) AS month, CASE WHEN EXISTS (SELECT 1 FROM pin p WHERE p.month = m.month AND p.st = 'P' AND p.figure > 400000) THEN 'blocked' WHEN coalesce(l.versions, 0) > 1 THEN 'restated' WHEN l.versions = 1 THEN 'closed' ELSE 'open' END AS state FROM m LEFT JOIN latest l ON m.month = l.month"""


@lens
def period_figures(d):
    """The highest version of each figure, and whether there were others."""
    return f"WITH {PERIODS} SELECT CAST(month AS STRING) AS month, version, CAST(figure AS DOUBLE) AS figure, versions > 1 AS restated FROM latest"


@lens
def restatement_log(d):
    return f"WITH {PERIODS}, r AS (SELECT month, version, figure, lag(figure) OVER (PARTITION BY month ORDER BY version) AS was FROM pin) SELECT CAST(month AS STRING) AS month, version, CAST(was AS DOUBLE) AS was, CAST(figure AS DOUBLE) AS figure FROM r WHERE was IS NOT NULL"


@lens
def identity_health(d):
    """How much of each relation carries its key."""
    rows = [("orders", "o_custkey"), ("lineitem", "l_orderkey"), ("lineitem", "l_suppkey"), ("supplier", "s_nationkey"), ("customer", "c_nationkey"), ("events", "user_id"), ("documents", "source"), ("labels", "doc_id")]
    return " UNION ALL ".join(f"SELECT '{t}.{c}' AS relation, count({c}) AS with_id, count(*) AS n_rows FROM {t}" for t, c in rows)


@lens
def provenance_strength(d):
    return "WITH p AS (SELECT CASE WHEN source IN ('src0', 'src1') THEN 'primary' WHEN source LIKE 'src1%' THEN 'secondary' WHEN source IS NULL THEN 'unknown' ELSE 'derived' END AS strength, doc_id FROM documents) SELECT strength, count(*) AS n FROM p GROUP BY strength"


@lens
def refund_overlap(d):
    """Refunded invoices by how much of the refund paid lines cover."""
    return f"""WITH {LINES}, i AS (SELECT invoice, sum(amount) FILTER (WHERE NOT is_base) AS refund, coalesce(sum(amount) FILTER (WHERE is_base AND status = 'paid'), 0) AS cover FROM line GROUP BY invoice)
SELECT CASE WHEN cover >= refund THEN 'fully' WHEN cover > 0 THEN 'partially' ELSE 'uncovered' END AS bucket, count(*) AS invoices, {money('sum(refund)')} AS refund FROM i WHERE refund > 0 GROUP BY 1""".replace("GROUP BY 1", "GROUP BY CASE WHEN cover >= refund THEN 'fully' WHEN cover > 0 THEN 'partially' ELSE 'uncovered' END")


@lens
def gap_questions(d):
    """What to ask whom: rows for customers with events but no invoice, and for invoices without lines."""
    return """SELECT 'no_invoice' AS kind, c_custkey AS subject, concat('When was ', c_name, ' billed first?') AS question FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AND EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
UNION ALL SELECT 'no_lines', o_orderkey, concat('Which lines has invoice ', CAST(o_orderkey AS STRING), '?') FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""


@lens
def flag_resync(d):
    """Cached flags that differ from what holds now."""
    return """WITH f AS (SELECT c_custkey AS brand, c_acctbal > 0 AS cached, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS truth FROM customer) SELECT brand, cached, truth FROM f WHERE cached IS DISTINCT FROM truth"""


@lens
def property_drift(d):
    """Vendor's and registry's property lists: new, removed, changed type, same."""
    return """WITH v AS (SELECT p_name AS name, min(p_type) AS kind FROM part WHERE p_partkey % 7 <> 0 GROUP BY p_name), r AS (SELECT p_name AS name, min(CASE WHEN p_partkey % 11 = 0 THEN 'OTHER' ELSE p_type END) AS kind FROM part WHERE p_partkey % 5 <> 0 GROUP BY p_name)
SELECT coalesce(v.name, r.name) AS name, CASE WHEN r.name IS NULL THEN 'NEW' WHEN v.name IS NULL THEN 'REMOVED' WHEN v.kind <> r.kind THEN 'TYPE_CHANGED' ELSE 'SAME' END AS status FROM v FULL OUTER JOIN r ON v.name = r.name"""


@lens
def sync_health(d):
    """Last success, last attempt and runs by connector, and how fresh that is."""
    return f"""WITH r AS (SELECT event_type AS connector, user_id % 3 AS mode, ts, value > 20 AS ok FROM events), g AS (SELECT connector, mode, max(ts) FILTER (WHERE ok) AS last_ok, max(ts) AS last_try, count(*) AS runs FROM r GROUP BY connector, mode)
SELECT connector, mode, runs, round({d.hours(NOW, 'last_ok')}, 4) AS hours, CASE WHEN last_ok IS NULL THEN 'never' WHEN {d.hours(NOW, 'last_ok')} <= 24 THEN 'fresh' WHEN {d.hours(NOW, 'last_ok')} <= 168 THEN 'stale' ELSE 'very_stale' END AS label FROM g"""
