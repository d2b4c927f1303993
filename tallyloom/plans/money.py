"""Money lenses: ledger, rates, claims, refunds, aging, reconciliation, retention and concentration.

Stand-ins: an order is an invoice and its customer the brand; a line item is an invoice line (linestatus F is paid, O
open; returnflag R is a refund line, the others are base lines); odd line numbers are product A, even ones B; a
supplier is a partner.  Money is DECIMAL until the last step.  A missing value stays missing: it never becomes 0.
"""

from __future__ import annotations

from .dialect import SparkSql

#: The day that takes the place of "today", so that results do not move.
AS_OF = "DATE '2001-12-01'"
#: Fee ladder: share by whole calendar months since the anchor.
LADDER = ((12, "0.10"), (18, "0.06"))
LADDER_END = "0.03"
LENSES: dict = {}


def lens(f):
    LENSES[f.__name__] = f
    return f


LINES = """line AS (
  SELECT l_orderkey AS invoice, l_linenumber AS line_no, l_partkey AS part, l_suppkey AS partner, o_custkey AS brand,
         CASE WHEN l_linenumber % 2 = 1 THEN 'A' ELSE 'B' END AS product,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_shipdate AS DATE) AS day,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS invoice_month, CAST(o_orderdate AS DATE) AS invoice_day,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))), 2) AS DECIMAL(18,2)) AS amount,
         l_returnflag <> 'R' AS is_base, CASE l_linestatus WHEN 'F' THEN 'paid' ELSE 'open' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

ANCHOR = "anchor AS (SELECT brand, min(month) AS anchor FROM line WHERE is_base GROUP BY brand)"


def _ladder(month: str, anchor: str, d: SparkSql, unknown: str = "0.10") -> str:
    steps = " ".join(f"WHEN {month} < {d.add_months(anchor, str(n))} THEN CAST({rate} AS DECIMAL(4,2))" for n, rate in LADDER)
    return f"CASE WHEN {anchor} IS NULL THEN CAST({unknown} AS DECIMAL(4,2)) {steps} ELSE CAST({LADDER_END} AS DECIMAL(4,2)) END"


def _ledger(d: SparkSql) -> str:
    return f"""{LINES}, {ANCHOR},
cell AS (
  SELECT brand, product, month, sum(amount) FILTER (WHERE is_base AND status = 'paid') AS collected,
         sum(amount) FILTER (WHERE is_base) AS billed, sum(amount) FILTER (WHERE NOT is_base) AS refunded, count(*) AS n_lines
  FROM line GROUP BY brand, product, month),
ledger AS (
  SELECT c.*, a.anchor, {_ladder('c.month', 'a.anchor', d)} AS rate FROM cell c LEFT JOIN anchor a ON c.brand = a.brand)"""


PAID = """paid AS (
  SELECT c_custkey AS brand, CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2)) AS paid FROM customer WHERE c_acctbal > 0)"""

CLAIM = """owed AS (SELECT brand, sum(round(coalesce(collected, 0) * rate, 2)) AS owed, sum(collected) AS collected FROM ledger GROUP BY brand),
claim AS (
  SELECT o.brand, o.collected, o.owed, p.paid, greatest(o.owed - greatest(coalesce(p.paid, 0), 0), 0) AS claim
  FROM owed o LEFT JOIN paid p ON o.brand = p.brand)"""


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6)"


@lens
def ledger_monthly(d):
    """Brand, product and month: collected, billed, refunded, rate by the ladder, fee."""
    return f"""WITH {_ledger(d)}
SELECT brand, product, CAST(month AS STRING) AS month, {money('collected')} AS collected, {money('billed')} AS billed, {money('refunded')} AS refunded,
       n_lines, CAST(rate AS DOUBLE) AS rate, {money('collected * rate')} AS fee FROM ledger"""


@lens
def rate_schedule(d):
    """The days at which a brand's rate changes."""
    return f"""WITH {LINES}, {ANCHOR}
SELECT brand, CAST(anchor AS STRING) AS anchor, CAST({d.add_months('anchor', '12')} AS STRING) AS ten_until, CAST({d.add_months('anchor', '18')} AS STRING) AS six_until FROM anchor"""


@lens
def rate_clock(d):
    """Today's rate: on or before an expiry the old band holds; without an anchor the rate is unknown."""
    return f"""WITH {LINES}, a AS (SELECT c_custkey AS brand, min(month) AS anchor FROM customer LEFT JOIN line ON brand = c_custkey AND is_base GROUP BY c_custkey)
SELECT brand, CASE WHEN anchor IS NULL THEN NULL WHEN {AS_OF} <= {d.add_months('anchor', '12')} THEN 0.10D WHEN {AS_OF} <= {d.add_months('anchor', '18')} THEN 0.06D ELSE 0.03D END AS rate,
       {d.days(d.add_months('anchor', '12'), AS_OF)} AS days_to_expiry FROM a""".replace("0.10D", "CAST(0.10 AS DOUBLE)").replace("0.06D", "CAST(0.06 AS DOUBLE)").replace("0.03D", "CAST(0.03 AS DOUBLE)")


@lens
def claim_floor(d):
    """What each brand still owes: fees less payments, never under 0."""
    return f"WITH {_ledger(d)}, {PAID}, {CLAIM} SELECT brand, {money('collected')} AS collected, {money('owed')} AS owed, {money('paid')} AS paid, {money('claim')} AS claim FROM claim"


@lens
def refund_allocation(d):
    """An invoice's refunds over its base lines, pro rata, capped by what was paid and by the cell."""
    return f"""WITH {LINES},
inv AS (SELECT invoice, sum(amount) FILTER (WHERE NOT is_base) AS refund, sum(amount) FILTER (WHERE is_base) AS base, sum(amount) FILTER (WHERE is_base AND status = 'paid') AS paid FROM line GROUP BY invoice),
due AS (SELECT invoice, base, paid, least(refund, paid) AS refund FROM inv WHERE refund > 0 AND paid > 0),
cell AS (SELECT invoice, brand, product, month, sum(amount) AS gross FROM line WHERE is_base AND status = 'paid' GROUP BY invoice, brand, product, month),
share AS (SELECT c.*, least(round(CAST(d.refund AS DOUBLE) * CAST(c.gross AS DOUBLE) / CAST(d.paid AS DOUBLE), 2), CAST(c.gross AS DOUBLE)) AS netted FROM cell c JOIN due d USING (invoice))
SELECT invoice, brand, product, CAST(month AS STRING) AS month, CAST(gross AS DOUBLE) AS gross, netted FROM share WHERE netted > 0.005"""


@lens
def monthly_summary(d):
    """Month and product totals."""
    return f"""WITH {LINES}
SELECT CAST(month AS STRING) AS month, product, {money("sum(amount) FILTER (WHERE is_base AND status = 'paid')")} AS collected, count(DISTINCT brand) AS brands,
       count(DISTINCT brand) FILTER (WHERE status = 'paid') AS paying_brands, count(DISTINCT invoice) AS invoices FROM line GROUP BY month, product"""


@lens
def billed_vs_collected(d):
    return f"""WITH {LINES}
SELECT brand, {money('sum(amount)')} AS billed, {money("sum(amount) FILTER (WHERE status = 'paid')")} AS collected, {money("coalesce(sum(amount) FILTER (WHERE status = 'open'), 0)")} AS outstanding
FROM line WHERE is_base GROUP BY 1"""


@lens
def pipeline_spine(d):
    """A dense month spine: new brands, invoices, collected; months without any show 0."""
    return f"""WITH {LINES}, ends AS (SELECT min(invoice_month) AS lo, max(invoice_month) AS hi FROM line), spine AS (SELECT {d.months('lo', 'hi')} AS month FROM ends),
first AS (SELECT month, count(*) AS new_brands FROM (SELECT brand, min(invoice_month) AS month FROM line GROUP BY brand) f GROUP BY month),
inv AS (SELECT invoice_month AS month, count(DISTINCT invoice) AS invoices FROM line GROUP BY invoice_month),
col AS (SELECT month, sum(amount) AS collected FROM line WHERE is_base AND status = 'paid' GROUP BY month)
SELECT CAST(s.month AS STRING) AS month, coalesce(new_brands, 0) AS new_brands, coalesce(invoices, 0) AS invoices, {money('coalesce(collected, 0)')} AS collected
FROM spine s LEFT JOIN first f ON s.month = f.month LEFT JOIN inv i ON s.month = i.month LEFT JOIN col c ON s.month = c.month"""


@lens
def ar_aging(d):
    """The oldest unpaid month of each brand with a claim, in calendar months, and its band."""
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}, old AS (SELECT brand, min(month) AS oldest FROM ledger WHERE collected > 0 GROUP BY brand),
m AS (SELECT c.brand, c.claim, oldest, (year({AS_OF}) * 12 + month({AS_OF})) - (year(oldest) * 12 + month(oldest)) AS months FROM claim c JOIN old o ON c.brand = o.brand WHERE c.claim > 0.005)
SELECT brand, {money('claim')} AS claim, CAST(oldest AS STRING) AS oldest, months, CASE WHEN months <= 1 THEN '0-1' WHEN months <= 3 THEN '1-3' WHEN months <= 6 THEN '3-6' ELSE '6+' END AS bucket FROM m"""


@lens
def partner_payout(d):
    """Owed to partners against what is recorded as paid: a full outer join."""
    return f"""WITH {LINES}, owed AS (SELECT partner, round(sum(amount) * 0.05, 2) AS owed FROM line WHERE is_base AND status = 'paid' GROUP BY partner HAVING sum(amount) > 300000),
paid AS (SELECT s_suppkey AS partner, CAST(s_acctbal AS DECIMAL(18,2)) AS paid FROM supplier WHERE s_acctbal > 0)
SELECT coalesce(o.partner, p.partner) AS partner, {money('owed')} AS owed, {money('paid')} AS paid, {money('coalesce(owed, 0) - coalesce(paid, 0)')} AS balance FROM owed o FULL OUTER JOIN paid p ON o.partner = p.partner"""


@lens
def brand_revenue(d):
    """Revenue from fee and rate; a stored value wins."""
    return f"""WITH {_ledger(d)}, r AS (SELECT brand, product, month, round(collected * rate, 2) AS fee, rate FROM ledger WHERE collected IS NOT NULL)
SELECT brand, product, CAST(month AS STRING) AS month, round(coalesce(CASE WHEN month < DATE '1996-01-01' THEN CAST(fee AS DOUBLE) * 10 END, CAST(fee AS DOUBLE) / nullif(CAST(rate AS DOUBLE), 0)), 2) AS revenue,
       CASE WHEN month < DATE '1996-01-01' THEN 'stored' ELSE 'derived' END AS source FROM r"""


@lens
def cash_ledger(d):
    return f"""WITH {LINES}, v AS (SELECT c_custkey AS brand, c_mktsegment AS verdict FROM customer)
SELECT l.invoice, l.line_no, l.brand, CAST(l.amount AS DOUBLE) AS amount, coalesce(v.verdict, 'unknown') AS verdict FROM line l LEFT JOIN v ON l.brand = v.brand WHERE l.status = 'paid'"""


@lens
def open_invoices(d):
    """Open invoices with month and day bands."""
    return f"""WITH {LINES}, o AS (SELECT invoice, brand, min(invoice_day) AS since, sum(amount) AS open FROM line WHERE status = 'open' GROUP BY invoice, brand),
a AS (SELECT *, {d.days(AS_OF, 'since')} AS age FROM o)
SELECT invoice, brand, {money('open')} AS open, age, CASE WHEN age <= 30 THEN '0-30' WHEN age <= 60 THEN '31-60' WHEN age <= 90 THEN '61-90' ELSE '90+' END AS band FROM a"""


@lens
def refund_events(d):
    return f"""WITH {LINES}
SELECT 'refund' AS kind, invoice, CAST(day AS STRING) AS day, CAST(amount AS DOUBLE) AS amount FROM line WHERE NOT is_base AND status = 'paid'
UNION ALL SELECT 'credit_note', invoice, CAST(day AS STRING), -CAST(amount AS DOUBLE) FROM line WHERE NOT is_base AND status = 'open'"""


@lens
def statement_drift(d):
    """The newest pinned statement against the live amount."""
    return f"""WITH {LINES}, live AS (SELECT brand, sum(amount) AS live FROM line WHERE is_base GROUP BY brand),
pins AS (SELECT o_custkey AS brand, CAST(o_totalprice AS DECIMAL(18,2)) AS pinned, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
SELECT l.brand, {money('pinned')} AS pinned, {money('live')} AS live, {money('live - pinned')} AS drift, CASE WHEN pinned IS NULL THEN 'unpinned' WHEN abs(live - pinned) <= 0.01 THEN 'none' WHEN live > pinned THEN 'up' ELSE 'down' END AS direction
FROM live l LEFT JOIN pins p ON l.brand = p.brand AND p.rn = 1"""


@lens
def customer_payments(d):
    """Each invoice with its largest paid line and its products."""
    return f"""WITH {LINES}, best AS (SELECT * FROM (SELECT invoice, line_no, amount, row_number() OVER (PARTITION BY invoice ORDER BY amount DESC, line_no) AS rn FROM line WHERE status = 'paid') b WHERE rn = 1),
inv AS (SELECT invoice, brand, {d.joined('product')} AS products, sum(amount) AS total FROM line GROUP BY invoice, brand)
SELECT i.invoice, i.brand, i.products, {money('i.total')} AS total, b.line_no AS best_line, CAST(b.amount AS DOUBLE) AS best_amount FROM inv i LEFT JOIN best b ON i.invoice = b.invoice"""


@lens
def days_to_pay(d):
    """Each payment (a brand's of a month) lists the invoices that it pays; the list as rows, and the days since each was billed."""
    return f"""WITH {LINES}, billed AS (SELECT invoice, min(invoice_day) AS billed_on FROM line GROUP BY invoice), pay AS (SELECT brand, month, max(day) AS paid_on, {d.joined('CAST(invoice AS STRING)')} AS invoices FROM line WHERE status = 'paid' GROUP BY brand, month),
each AS (SELECT brand, paid_on, {d.each_part('invoices', ', ')} AS part FROM pay), x AS (SELECT brand, paid_on, billed_on FROM each JOIN billed ON CAST(trim(part) AS BIGINT) = invoice)
SELECT brand, count(*) AS invoices, sum({d.days('paid_on', 'billed_on')}) AS total_days, max({d.days('paid_on', 'billed_on')}) AS worst FROM x GROUP BY brand"""


STATUS = """active AS (SELECT brand, month, sum(amount) AS collected FROM line WHERE is_base AND status = 'paid' GROUP BY brand, month),
edge AS (SELECT max(month) AS hi FROM active),
span AS (SELECT brand, min(month) AS lo FROM active GROUP BY brand),
spine AS (SELECT brand, {months} AS month FROM span CROSS JOIN edge),
grid AS (SELECT s.brand, s.month, a.collected, year(s.month) * 12 + month(s.month) AS k, CASE WHEN a.collected > 0 THEN year(s.month) * 12 + month(s.month) END AS hit
         FROM spine s LEFT JOIN active a ON s.brand = a.brand AND s.month = a.month),
marks AS (SELECT *, max(hit) OVER (PARTITION BY brand ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_hit,
         max(hit) OVER (PARTITION BY brand ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_hit,
         lag(collected, 1) OVER (PARTITION BY brand ORDER BY month) AS prev_collected FROM grid),
state AS (SELECT *, CASE WHEN hit IS NOT NULL AND prev_hit IS NULL THEN 'new' WHEN hit IS NOT NULL AND k - prev_hit >= 4 THEN 're_engaged'
         WHEN hit IS NOT NULL AND collected <= prev_collected * 0.5 THEN 'at_risk' WHEN hit IS NOT NULL THEN 'producing'
         WHEN k - last_hit >= 6 THEN 'churned' WHEN k - last_hit >= 3 THEN 'dormant' ELSE 'quiet' END AS state FROM marks)"""


def _status(d: SparkSql) -> str:
    return f"{LINES}, " + STATUS.replace("{months}", d.months("lo", "hi"))


@lens
def status_grid(d):
    """The state of every brand in every month since its first, from running maxima over a dense spine."""
    return f"WITH {_status(d)} SELECT brand, CAST(month AS STRING) AS month, state, {money('collected')} AS collected FROM state"


@lens
def status_latest(d):
    return f"WITH {_status(d)}, r AS (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY month DESC) AS rn FROM state) SELECT brand, CAST(month AS STRING) AS month, state FROM r WHERE rn = 1"


@lens
def movement(d):
    """Brands that were added, came back or went, by month."""
    return f"""WITH {_status(d)}, t AS (SELECT *, lag(state) OVER (PARTITION BY brand ORDER BY month) AS was FROM state)
SELECT CAST(month AS STRING) AS month, count(*) FILTER (WHERE state = 'new') AS added, count(*) FILTER (WHERE state = 're_engaged') AS re_engaged, count(*) FILTER (WHERE state = 'churned' AND was IS DISTINCT FROM 'churned') AS churned,
       count(*) FILTER (WHERE state IN ('new', 're_engaged')) - count(*) FILTER (WHERE state = 'churned' AND was IS DISTINCT FROM 'churned') AS net FROM t GROUP BY month"""


@lens
def cohort_retention(d):
    """Brands by first month and months since: how many still pay."""
    return f"""WITH {LINES}, a AS (SELECT DISTINCT brand, month FROM line WHERE is_base AND status = 'paid'), f AS (SELECT brand, min(month) AS cohort FROM a GROUP BY brand),
n AS (SELECT cohort, count(*) AS size FROM f GROUP BY cohort)
SELECT CAST(f.cohort AS STRING) AS cohort, (year(a.month) * 12 + month(a.month)) - (year(f.cohort) * 12 + month(f.cohort)) AS months_since, count(DISTINCT a.brand) AS retained, n.size AS cohort_size, {ratio('count(DISTINCT a.brand)', 'n.size')} AS share
FROM a JOIN f ON a.brand = f.brand JOIN n ON f.cohort = n.cohort GROUP BY f.cohort, 2, n.size""".replace("GROUP BY f.cohort, 2, n.size", "GROUP BY f.cohort, (year(a.month) * 12 + month(a.month)) - (year(f.cohort) * 12 + month(f.cohort)), n.size")


@lens
def concentration(d):
    """Share of the month's collected money of the first brand, the first five, and the first three partners.

    Totals are an aggregate of their own and ranks are cut at once, so that a month's groups are limited before they are
    brought together, however many brands it has.
    """
    return f"""WITH {LINES}, b AS (SELECT month, brand, sum(amount) AS v FROM line WHERE is_base AND status = 'paid' GROUP BY month, brand), p AS (SELECT month, partner, sum(amount) AS v FROM line WHERE is_base AND status = 'paid' GROUP BY month, partner),
total AS (SELECT month, sum(v) AS total FROM b GROUP BY month),
b5 AS (SELECT * FROM (SELECT month, v, row_number() OVER (PARTITION BY month ORDER BY v DESC, brand) AS rn FROM b) x WHERE rn <= 5),
p3 AS (SELECT * FROM (SELECT month, v, row_number() OVER (PARTITION BY month ORDER BY v DESC, partner) AS rn FROM p) y WHERE rn <= 3),
top AS (SELECT month, sum(v) FILTER (WHERE rn = 1) AS v1, sum(v) AS v5 FROM b5 GROUP BY month), q3 AS (SELECT month, sum(v) AS v3 FROM p3 GROUP BY month)
SELECT CAST(t.month AS STRING) AS month, {ratio('v1', 'total')} AS top1, {ratio('v5', 'total')} AS top5, {ratio('v3', 'total')} AS partners3 FROM total t JOIN top ON t.month = top.month JOIN q3 ON t.month = q3.month"""


@lens
def partner_share_nested_window(d):
    """An aggregate under a window over the aggregate."""
    return f"""WITH {LINES} SELECT partner, product, {money('sum(amount)')} AS collected, {ratio('sum(amount)', 'sum(sum(amount)) OVER (PARTITION BY product)')} AS share FROM line WHERE is_base AND status = 'paid' GROUP BY partner, product"""


@lens
def contribution(d):
    """Each month's fee by the state its brands were in."""
    return f"""WITH {_status(d)}, f AS (SELECT s.month, s.state, s.collected * 0.06 AS fee FROM state s WHERE s.collected IS NOT NULL)
SELECT CAST(month AS STRING) AS month, {money('sum(fee)')} AS fee, {money("coalesce(sum(fee) FILTER (WHERE state = 'new'), 0)")} AS from_new, {money("coalesce(sum(fee) FILTER (WHERE state IN ('producing', 'at_risk')), 0)")} AS from_kept,
       {money("coalesce(sum(fee) FILTER (WHERE state = 're_engaged'), 0)")} AS from_back FROM f GROUP BY month"""


@lens
def fee_at_risk(d):
    """Brands that any of four causes puts at risk, with the causes as a list."""
    return f"""WITH {_status(d)}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY month DESC) AS rn FROM state) x WHERE rn = 1),
a AS (SELECT brand FROM last WHERE state = 'at_risk'), b AS (SELECT brand FROM last WHERE state IN ('dormant', 'churned')), c AS (SELECT c_custkey AS brand FROM customer WHERE c_acctbal < 0), e AS (SELECT brand FROM line WHERE status = 'open' AND month < DATE '1999-01-01' GROUP BY brand),
ids AS (SELECT brand FROM a UNION SELECT brand FROM b UNION SELECT brand FROM c UNION SELECT brand FROM e), tot AS (SELECT brand, sum(amount) AS v FROM line WHERE is_base AND status = 'paid' GROUP BY brand)
SELECT i.brand, {money('coalesce(t.v, 0) * 0.06')} AS fee, {d.compact("CASE WHEN a.brand IS NOT NULL THEN 'falling' END", "CASE WHEN b.brand IS NOT NULL THEN 'silent' END", "CASE WHEN c.brand IS NOT NULL THEN 'overdrawn' END", "CASE WHEN e.brand IS NOT NULL THEN 'open' END")} AS causes
FROM ids i LEFT JOIN a ON i.brand = a.brand LEFT JOIN b ON i.brand = b.brand LEFT JOIN c ON i.brand = c.brand LEFT JOIN e ON i.brand = e.brand LEFT JOIN tot t ON i.brand = t.brand"""


@lens
def reconciliation(d):
    """Claims against what the counterparty acknowledges, in six statuses."""
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}, ack AS (SELECT o_custkey AS brand, bool_or(o_orderstatus = 'F') AS acknowledged, count(*) AS n FROM orders GROUP BY o_custkey),
ids AS (SELECT brand FROM claim UNION SELECT brand FROM ack)
SELECT i.brand, {money('c.owed')} AS owed, {money('c.paid')} AS paid, CASE WHEN c.brand IS NULL THEN 'acknowledged_only' WHEN c.claim <= 0.005 THEN 'settled' WHEN a.acknowledged AND c.paid IS NOT NULL THEN 'acknowledged_part_paid'
       WHEN a.acknowledged THEN 'acknowledged_unpaid' WHEN c.paid IS NOT NULL THEN 'unacknowledged_part_paid' ELSE 'unacknowledged_unpaid' END AS status FROM ids i LEFT JOIN claim c ON i.brand = c.brand LEFT JOIN ack a ON i.brand = a.brand"""


@lens
def stated_vs_recorded(d):
    return f"""WITH {LINES}, s AS (SELECT o_custkey AS brand, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS stated FROM orders GROUP BY o_custkey), r AS (SELECT brand, sum(amount) AS recorded FROM line GROUP BY brand)
SELECT s.brand, {money('stated')} AS stated, {money('recorded')} AS recorded, {money('stated - coalesce(recorded, 0)')} AS gap FROM s LEFT JOIN r ON s.brand = r.brand"""


@lens
def product_eligibility(d):
    """Every brand with every product: override, else feed, else the product's default."""
    return """WITH p AS (SELECT 'A' AS product, CAST(0.05 AS DOUBLE) AS standard UNION ALL SELECT 'B', CAST(0.10 AS DOUBLE)), o AS (SELECT c_custkey AS brand, 'A' AS product, CAST(0.01 AS DOUBLE) AS rate FROM customer WHERE c_mktsegment = 'BUILDING'),
f AS (SELECT c_custkey AS brand, 'B' AS product, CAST(0.02 AS DOUBLE) AS rate FROM customer WHERE c_acctbal < 0)
SELECT c_custkey AS brand, p.product, coalesce(o.rate, f.rate, p.standard) AS rate, CASE WHEN o.rate IS NOT NULL THEN 'override' WHEN f.rate IS NOT NULL THEN 'feed' ELSE 'default' END AS source
FROM customer CROSS JOIN p LEFT JOIN o ON c_custkey = o.brand AND p.product = o.product LEFT JOIN f ON c_custkey = f.brand AND p.product = f.product"""


@lens
def excluded_partner_performance(d):
    return f"""WITH {LINES}, b AS (SELECT brand, partner, product, amount, row_number() OVER (PARTITION BY brand ORDER BY invoice_day, invoice, line_no, partner) AS rn, is_base FROM line), first AS (SELECT brand, partner AS referrer FROM b WHERE rn = 1)
SELECT referrer, product, count(DISTINCT l.brand) AS brands, {money('sum(amount)')} AS revenue FROM line l JOIN first f ON l.brand = f.brand WHERE is_base GROUP BY referrer, product"""


@lens
def usage_reconciliation(d):
    """Three sources of a month's money tied out: nothing to compare gives null; else within max(50, 1 percent)."""
    return f"""WITH {LINES}, a AS (SELECT month, sum(amount) AS engine FROM line WHERE is_base AND status = 'paid' GROUP BY month), b AS (SELECT month, sum(amount) AS payments FROM line WHERE status = 'paid' GROUP BY month), r AS (SELECT month, sum(amount) AS refunds FROM line WHERE NOT is_base AND status = 'paid' GROUP BY month),
m AS (SELECT month FROM a UNION SELECT month FROM b UNION SELECT month FROM r), x AS (SELECT m.month, engine, payments, refunds, payments - coalesce(refunds, 0) - engine AS residual FROM m LEFT JOIN a ON m.month = a.month LEFT JOIN b ON m.month = b.month LEFT JOIN r ON m.month = r.month)
SELECT CAST(month AS STRING) AS month, {money('engine')} AS engine, {money('payments')} AS payments, {money('refunds')} AS refunds, {money('residual')} AS residual, abs(residual) <= greatest(50, engine * 0.01) AS tied FROM x"""


@lens
def collection_queue(d):
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}, pool AS (SELECT c_custkey AS brand, CASE c_mktsegment WHEN 'BUILDING' THEN 'ours' WHEN 'MACHINERY' THEN 'disputed' ELSE 'theirs' END AS pool, c_acctbal < 0 AS requested FROM customer)
SELECT p.brand, p.pool, CASE WHEN c.claim > 0.005 THEN 'owed_now' WHEN c.collected > 0 THEN 'settled' ELSE 'no_money' END AS money_status, CASE WHEN p.pool = 'ours' AND c.claim > 0.005 AND NOT p.requested THEN 'to_request' WHEN p.pool = 'ours' AND c.claim > 0.005 THEN 'requested' WHEN p.pool = 'disputed' THEN 'review' ELSE 'none' END AS queue
FROM pool p LEFT JOIN claim c ON p.brand = c.brand"""


@lens
def commission_by_client(d):
    return f"""WITH {LINES} SELECT c_custkey AS brand, c_name AS name, {money('coalesce(sum(amount), 0) * 0.10')} AS commission FROM customer LEFT JOIN line ON brand = c_custkey AND is_base AND status = 'paid' GROUP BY c_custkey, c_name"""


@lens
def partner_performance(d):
    """Funnel of a partner's brands: seen, sold to, quiet by now."""
    return f"""WITH {LINES}, b AS (SELECT partner, brand, max(month) AS last, sum(amount) FILTER (WHERE status = 'paid') AS paid FROM line GROUP BY partner, brand)
SELECT partner, count(*) AS seen, count(*) FILTER (WHERE paid > 0) AS sold, count(*) FILTER (WHERE paid > 0 AND last < DATE '2000-01-01') AS quiet, {ratio('count(*) FILTER (WHERE paid > 0)', 'count(*)')} AS rate FROM b GROUP BY partner"""


@lens
def claim_by_company(d):
    """Claims rolled up to the canonical company: the declared parent, else the brand itself."""
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}, canon AS (SELECT c_custkey AS brand, coalesce(CASE WHEN c_custkey % 10 < 3 THEN CAST(c_nationkey AS BIGINT) END, 1000000 + c_custkey) AS company FROM customer)
SELECT company, count(*) AS brands, {money('sum(owed)')} AS owed, {money('sum(claim)')} AS claim FROM claim JOIN canon USING (brand) GROUP BY company"""


@lens
def claim_reconciliation(d):
    """A company's claims against what it acknowledges, with a status for each outcome."""
    return f"""WITH {_ledger(d)}, {PAID}, {CLAIM}, canon AS (SELECT c_custkey AS brand, coalesce(CASE WHEN c_custkey % 10 < 3 THEN CAST(c_nationkey AS BIGINT) END, 1000000 + c_custkey) AS company FROM customer),
ours AS (SELECT company, count(*) AS brands, sum(owed) AS owed, sum(claim) AS claim FROM claim JOIN canon USING (brand) GROUP BY company),
theirs AS (SELECT company, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS stated FROM orders JOIN canon ON o_custkey = brand WHERE o_orderstatus = 'F' GROUP BY company)
SELECT coalesce(o.company, t.company) AS company, o.brands, {money('o.claim')} AS claim, {money('t.stated')} AS stated, CASE WHEN o.company IS NULL THEN 'stated_only' WHEN o.claim <= 0.005 THEN 'settled' WHEN t.company IS NULL THEN 'unanswered'
       WHEN abs(o.claim - t.stated) <= greatest(50, o.claim * 0.01) THEN 'agreed' WHEN t.stated < o.claim THEN 'short' ELSE 'over' END AS status FROM ours o FULL OUTER JOIN theirs t ON o.company = t.company"""


@lens
def canonical_election(d):
    """Of the brands of a nation and segment, the one with the most money stands for all; ties go to the smaller id."""
    return f"""WITH {LINES}, v AS (SELECT brand, sum(amount) AS v FROM line GROUP BY brand), c AS (SELECT c_custkey AS brand, c_nationkey, c_mktsegment, coalesce(v, 0) AS v FROM customer LEFT JOIN v ON brand = c_custkey),
w AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY v DESC, brand) AS rn FROM c)
SELECT c.brand, w.brand AS canonical FROM c JOIN w ON c.c_nationkey = w.c_nationkey AND c.c_mktsegment = w.c_mktsegment AND w.rn = 1"""
