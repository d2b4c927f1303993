"""Customer-record lenses: scans, owners and stages, association joins, contacts, tickets, timelines.

Stand-ins: a customer is a company, a supplier a contact, an order a deal (its status is the stage), a conversation a
ticket, a nation the region holder, an event's JSON the overflow properties.
"""

from __future__ import annotations

from .money import LINES, money

LENSES: dict = {}
STAGES = "stage AS (SELECT 'O' AS code, 'Open' AS label UNION ALL SELECT 'F', 'Closed won')"


def lens(f):
    LENSES[f.__name__] = f
    return f


@lens
def companies(d):
    return "SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer WHERE c_nationkey % 2 = 0"


@lens
def companies_in_region(d):
    return "SELECT c_custkey AS id, c_name AS name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE upper(r_name) LIKE '%A%'"


@lens
def property_manifest(d):
    """The registry's properties by object: kind, whether it is a custom one, how often it is filled; and what it has not registered."""
    return f"""WITH reg AS (SELECT 'click' AS object, 'k' AS property, 'number' AS kind, false AS is_custom UNION ALL SELECT 'purchase', 'k', 'number', true UNION ALL SELECT 'purchase', 'gone', 'text', true),
seen AS (SELECT event_type AS object, 'k' AS property, count({d.json_text('props', 'k')}) AS filled, count(DISTINCT user_id) AS owners FROM events GROUP BY event_type)
SELECT coalesce(s.object, r.object) AS object, coalesce(s.property, r.property) AS property, r.kind, coalesce(r.is_custom, false) AS is_custom, coalesce(s.filled, 0) AS filled, coalesce(s.owners, 0) AS owners, r.object IS NULL AS unregistered FROM seen s FULL OUTER JOIN reg r ON s.object = r.object AND s.property = r.property"""


@lens
def companies_history(d):
    """All revisions of the companies of some nations, closed ones too, each with the time that it held."""
    return """WITH h AS (SELECT user_id AS company, event_type AS field, value, ts AS valid_from, event_id, lead(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS valid_to FROM events)
SELECT h.event_id, h.company, c_name AS name, h.field, h.value, h.valid_to IS NULL AS is_current FROM h JOIN customer ON c_custkey = h.company WHERE c_nationkey % 2 = 0 AND (h.valid_to IS NULL OR h.valid_to > h.valid_from)"""


@lens
def engagements_with_owners(d):
    """A left join on three keys."""
    return "WITH own AS (SELECT s_suppkey AS owner, s_nationkey AS nation, s_suppkey % 5 AS slot, s_name AS name FROM supplier) SELECT o_orderkey AS id, c_custkey AS company, name AS owner FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN own ON own.nation = c_nationkey AND own.slot = o_orderkey % 5 AND own.owner = c_custkey % 100"


@lens
def deals_with_stage_labels(d):
    return f"WITH {STAGES} SELECT o_orderkey AS id, o_orderstatus AS code, label FROM orders LEFT JOIN stage ON o_orderstatus = code"


def attributed(source: str):
    def make(d):
        return f"WITH {STAGES} SELECT o_orderkey AS id, o_orderpriority AS source, coalesce(label, 'Unknown') AS stage FROM orders LEFT JOIN stage ON o_orderstatus = code WHERE o_orderpriority LIKE '{source}%'"

    make.__doc__ = f"Deals whose source starts with {source}: one template, a value for each lens."
    return make


for _n, _source in (("first", "1-"), ("second", "2-"), ("third", "3-"), ("fourth", "4-"), ("fifth", "5-")):
    LENSES[f"attributed_deals_{_n}"] = attributed(_source)


@lens
def attribution_summary(d):
    price = "CAST(o_totalprice AS DECIMAL(18,2))"
    open_amount = f"coalesce(sum({price}) FILTER (WHERE o_orderstatus = 'O'), 0)"
    return f"SELECT o_orderpriority AS source, count(*) AS deals, count(*) FILTER (WHERE o_orderstatus = 'F') AS won, {money(f'sum({price})')} AS amount, {money(open_amount)} AS open_amount FROM orders GROUP BY o_orderpriority"


@lens
def companies_by_deal(d):
    """Companies whose id is among the deals' keys: an uncorrelated semi join."""
    return "SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority LIKE '1-%')"


@lens
def contacts_by_company(d):
    return "SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey IN (SELECT c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000))"


@lens
def ticket_chain(d):
    """Ticket to contact by a key in its JSON, to identity link to company, with a disjunctive condition on the link; companies of matching deals only."""
    return f"""WITH t AS (SELECT event_id AS ticket, CAST({d.json_text('props', 'k')} AS BIGINT) AS requester FROM events WHERE event_type = 'error'), link AS (SELECT s_suppkey AS left_id, s_suppkey % 50 AS right_id, CASE WHEN s_suppkey % 4 = 0 THEN 0.5 ELSE 1.0 END AS confidence, CASE WHEN s_suppkey % 8 = 0 THEN 'operator:x' ELSE 'email' END AS method FROM supplier)
SELECT t.ticket, l.left_id AS contact, c.c_custkey AS company FROM t JOIN link l ON t.requester = l.left_id AND (l.confidence >= 0.9 OR l.method LIKE 'operator:%') JOIN customer c ON c.c_custkey = l.right_id
WHERE c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority LIKE '1-%')"""


@lens
def deals_history(d):
    """History rows of current matching deals."""
    return "WITH h AS (SELECT user_id AS deal, event_type AS stage, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to, event_id FROM events) SELECT event_id, deal, stage, valid_to IS NULL AS is_open FROM h WHERE deal IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 99)"


@lens
def deal_financials(d):
    """Numbers out of JSON text; what is no number is null."""
    return f"SELECT event_id, user_id AS client, {d.try_number(d.json_text('props', 'k'))} AS k, {d.try_number('event_type')} AS not_a_number FROM events"


@lens
def financial_summary(d):
    return f"WITH v AS (SELECT user_id, {d.try_number(d.json_text('props', 'k'))} AS k FROM events) SELECT c_custkey AS client, count(k) AS n, CAST(sum(k) AS DOUBLE) AS total FROM customer LEFT JOIN v ON user_id = c_custkey GROUP BY c_custkey"


@lens
def open_questions(d):
    return f"WITH g AS (SELECT o_orderpriority AS asker, n_name AS about FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'P') SELECT asker, count(*) AS questions, {d.joined('about')} AS about FROM g GROUP BY asker"


@lens
def exclusion_status(d):
    return f"WITH b AS (SELECT c_custkey AS brand, c_mktsegment AS bucket FROM customer WHERE c_acctbal < 0 UNION ALL SELECT o_custkey, 'URGENT' FROM orders WHERE o_orderpriority = '1-URGENT'), g AS (SELECT brand, {d.joined('bucket')} AS buckets, bool_or(bucket = 'URGENT') AS urgent, count(DISTINCT bucket) AS n FROM b GROUP BY brand) SELECT c_custkey AS brand, buckets, coalesce(urgent, false) AS urgent, coalesce(n, 0) = 0 AS takeable FROM customer LEFT JOIN g ON brand = c_custkey"


@lens
def brand_bridge(d):
    """Brand to observation to company, distinct."""
    return "SELECT DISTINCT c_custkey AS brand, e.event_type AS seen_as, n_name AS company FROM customer JOIN events e ON e.user_id = c_custkey JOIN nation ON n_nationkey = c_nationkey"


@lens
def deal_timeline(d):
    """Milestones of a brand and the lag between them in months."""
    return f"""WITH {LINES}, a AS (SELECT brand, min(invoice_day) AS first_invoice, min(day) FILTER (WHERE status = 'paid') AS first_paid, max(day) AS last_line FROM line GROUP BY brand), e AS (SELECT user_id AS brand, min(ts) AS signup FROM events WHERE event_type = 'signup' GROUP BY user_id)
SELECT a.brand, CAST(first_invoice AS STRING) AS first_invoice, CAST(first_paid AS STRING) AS first_paid, CAST(last_line AS STRING) AS last_line, (year(first_paid) * 12 + month(first_paid)) - (year(first_invoice) * 12 + month(first_invoice)) AS lag_months, signup IS NOT NULL AS signed_up FROM a LEFT JOIN e ON a.brand = e.brand"""


@lens
def attribution_at_risk(d):
    return "SELECT o_orderkey AS deal, CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 5000 THEN 'small' END AS risk FROM orders WHERE (o_orderstatus = 'P' OR o_totalprice < 5000) AND o_orderpriority = '5-LOW'"


@lens
def contact_book(d):
    return "SELECT s_suppkey AS contact, s_name AS name, n_name AS nation, r_name AS region, CASE WHEN s_acctbal < 0 THEN 'blocked' ELSE 'active' END AS status FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"


@lens
def brand_header(d):
    return f"""WITH last AS (SELECT o_custkey, o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders), n AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c_custkey AS brand, c_name AS name, n_name AS nation, coalesce(n.n, 0) AS invoices, last.o_orderkey AS last_invoice, last.o_orderstatus AS last_status FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN n ON n.o_custkey = c_custkey LEFT JOIN last ON last.o_custkey = c_custkey AND last.rn = 1"""


@lens
def statements_history(d):
    return "SELECT o_custkey AS brand, o_orderkey AS statement, CAST(CAST(o_orderdate AS DATE) AS STRING) AS filed, o_totalprice AS amount FROM orders WHERE o_orderstatus = 'F'"


@lens
def assignment_current(d):
    """The holder of each role today: begun, not ended, the latest wins."""
    return "WITH a AS (SELECT event_type AS role, user_id AS holder, ts AS since, lead(ts) OVER (PARTITION BY event_type, user_id % 10 ORDER BY ts, event_id) AS until, user_id % 10 AS team, event_id FROM events), r AS (SELECT *, row_number() OVER (PARTITION BY role, team ORDER BY since DESC, event_id DESC) AS rn FROM a WHERE since <= TIMESTAMP '2024-01-20 00:00:00' AND (until IS NULL OR until > TIMESTAMP '2024-01-20 00:00:00')) SELECT role, team, holder FROM r WHERE rn = 1"


@lens
def brand_tickets(d):
    return "SELECT c.conv_id % 150 AS brand, count(DISTINCT c.conv_id) AS tickets, count(*) AS messages FROM conversations c JOIN customer ON c_custkey = c.conv_id % 150 GROUP BY c.conv_id % 150"


@lens
def email_party(d):
    """Mailbox (here the name's digits modulo 40) to party, and whether it is ambiguous."""
    return "WITH m AS (SELECT lower(trim(s_name)) AS name, s_suppkey % 40 AS mailbox, s_suppkey AS party FROM supplier) SELECT mailbox, count(DISTINCT party) AS parties, min(party) AS party, count(DISTINCT party) > 1 AS ambiguous FROM m GROUP BY mailbox"


@lens
def readout_current(d):
    return "WITH e AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS edition, o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'F') SELECT CAST(edition AS STRING) AS edition, o_orderkey AS id FROM e WHERE rn = 1"


@lens
def readout_history(d):
    return f"WITH e AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders), m AS (SELECT max(day) AS last FROM e) SELECT id, CAST(day AS STRING) AS day, {d.days('last', 'day')} <= 35 AS recent FROM e CROSS JOIN m WHERE day >= {d.add_months('last', '-2')}"


@lens
def partner_rate(d):
    """The current rate of each partner and its history as JSON."""
    return f"""WITH h AS (SELECT user_id AS partner, value AS rate, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type = 'signup'), a AS (SELECT partner, {d.pairs_json('CAST(event_id AS STRING)', 'CAST(CAST(floor(rate) AS BIGINT) AS STRING)', 'event_id')} AS history, count(*) AS n FROM h GROUP BY partner)
SELECT a.partner, h.rate, a.n, a.history FROM a JOIN h ON a.partner = h.partner AND h.rn = 1"""


@lens
def acknowledgement(d):
    return f"SELECT o_custkey AS brand, count(*) AS payments, {money('sum(CAST(o_totalprice AS DECIMAL(18,2)))')} AS acknowledged FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey"


@lens
def identity_links(d):
    """Matches on a normal key (a name's number), graded by how many a left id fans out to; role mailboxes are less sure.

    A supplier in three has an alias under the same key; the output grows with the names, not with their product.
    """
    return """WITH l AS (SELECT c_custkey AS left_id, lower(trim(split_part(c_name, '#', 2))) AS k FROM customer), r AS (SELECT s_suppkey AS right_id, lower(trim(split_part(s_name, '#', 2))) AS k FROM supplier UNION ALL SELECT s_suppkey + 1000000, lower(trim(split_part(s_name, '#', 2))) FROM supplier WHERE s_suppkey % 3 = 0),
m AS (SELECT left_id, right_id, count(*) OVER (PARTITION BY left_id) AS fan FROM l JOIN r ON l.k = r.k WHERE left_id <> 13)
SELECT left_id, right_id, CASE WHEN fan > 1 THEN 0.5 WHEN left_id % 10 = 0 THEN 0.9 ELSE 1.0 END + CAST(0 AS DOUBLE) AS confidence FROM m"""


@lens
def identity_recovery(d):
    """A missing id from two sources in order, with where it came from."""
    return "WITH a AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS id FROM orders), x AS (SELECT l_orderkey AS k, min(l_suppkey) AS id FROM lineitem WHERE l_quantity > 45 GROUP BY l_orderkey), y AS (SELECT event_id AS k, user_id AS id FROM events) SELECT a.o_orderkey AS k, coalesce(a.id, x.id, y.id) AS id, CASE WHEN a.id IS NOT NULL THEN 'own' WHEN x.id IS NOT NULL THEN 'lines' WHEN y.id IS NOT NULL THEN 'events' END AS source FROM a LEFT JOIN x ON a.o_orderkey = x.k LEFT JOIN y ON a.o_orderkey = y.k"


@lens
def master_seed(d):
    """Distinct ids of five relations that the master does not hold yet."""
    return "WITH ids AS (SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events UNION SELECT l_suppkey FROM lineitem UNION SELECT doc_id % 5000 FROM documents UNION SELECT vec_id FROM embeddings) SELECT id FROM ids WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = id)"


@lens
def priority_date(d):
    """The first of three dates that is there, and which it was."""
    return "WITH a AS (SELECT user_id AS k, min(ts) AS t FROM events WHERE event_type = 'signup' AND value > 90 GROUP BY user_id), b AS (SELECT user_id AS k, min(ts) AS t FROM events WHERE event_type = 'purchase' AND value > 95 GROUP BY user_id), o AS (SELECT o_custkey AS k, min(o_orderdate) AS t FROM orders GROUP BY o_custkey) SELECT c_custkey AS brand, CAST(CAST(coalesce(a.t, b.t, o.t) AS DATE) AS STRING) AS since, CASE WHEN a.t IS NOT NULL THEN 'signup' WHEN b.t IS NOT NULL THEN 'purchase' WHEN o.t IS NOT NULL THEN 'invoice' END AS source FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey LEFT JOIN o ON o.k = c_custkey"


@lens
def uniform_rate_seed(d):
    """Only keys with one distinct value."""
    return "SELECT p_brand AS brand, p_type AS product, min(p_size) AS size FROM part GROUP BY p_brand, p_type HAVING count(DISTINCT p_size) = 1"


@lens
def default_seed(d):
    return "SELECT DISTINCT l_suppkey AS partner, l_returnflag AS kind, CAST(0.05 AS DOUBLE) AS rate FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal < 0)"


@lens
def month_by_theta_join(d):
    """A month name's beginning matched against an inline relation by LIKE."""
    return """WITH m AS (SELECT 'jan' AS name, 1 AS n UNION ALL SELECT 'feb', 2 UNION ALL SELECT 'mar', 3 UNION ALL SELECT 'apr', 4 UNION ALL SELECT 'may', 5 UNION ALL SELECT 'jun', 6 UNION ALL SELECT 'jul', 7 UNION ALL SELECT 'aug', 8 UNION ALL SELECT 'sep', 9 UNION ALL SELECT 'oct', 10 UNION ALL SELECT 'nov', 11 UNION ALL SELECT 'dec', 12),
t AS (SELECT o_orderkey, lower(""" + d.month_name("o_orderdate") + """) AS label FROM orders) SELECT o_orderkey, label, m.n FROM t JOIN m ON t.label LIKE concat(m.name, '%')"""


@lens
def not_in_null_aware(d):
    """NOT IN over a list that holds a null keeps no row; NOT EXISTS, and NOT IN over what is not null, keep what does not match."""
    x = "SELECT CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS k FROM supplier WHERE s_suppkey % 3 <> 0"
    return f"""SELECT 'not_in' AS op, n_nationkey AS nation FROM nation WHERE n_nationkey NOT IN ({x}) UNION ALL SELECT 'not_in_known', n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT k FROM ({x}) y WHERE k IS NOT NULL)
UNION ALL SELECT 'not_exists', n_nationkey FROM nation WHERE NOT EXISTS (SELECT 1 FROM ({x}) z WHERE z.k = n_nationkey) UNION ALL SELECT 'none_left', count(*) FROM nation WHERE n_nationkey NOT IN ({x})"""


@lens
def exists_flags(d):
    return "SELECT c_custkey AS k, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS has_orders, EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey) AS has_events FROM customer"


@lens
def scalar_subqueries(d):
    return "SELECT c_custkey AS k, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS largest, CASE WHEN c_acctbal > (SELECT avg(c_acctbal) FROM customer) THEN 'above' ELSE 'below' END AS side FROM customer"


@lens
def unnest_list(d):
    return f"WITH w AS (SELECT p_partkey, {d.each_part('p_type', ' ')} AS word FROM part) SELECT trim(word) AS word, count(*) AS n FROM w GROUP BY trim(word)"


@lens
def text_functions(d):
    """Normal forms, parts, prefixes, digits, emptiness, redaction."""
    return f"""SELECT s_suppkey AS k, lower(trim(s_name)) AS normal, split_part(s_name, '#', 2) AS after, {d.extract('s_name', '([0-9]+)$', 1)} AS digits, replace(s_name, 'Supplier', 'S') AS short, {d.replace_all('s_name', '[^0-9]', '')} AS only_digits,
length(trim(s_name)) > 0 AS filled, {d.matches('s_name', '#0*[0-9]$')} AS small, {d.sha('s_name')} AS hash, concat(s_name, ' / ', CAST(s_nationkey AS STRING)) AS label FROM supplier"""


@lens
def co_occurrence(d):
    """Texts that hold a word of each of two lists."""
    return f"SELECT doc_id FROM documents WHERE {d.matches('lower(text)', '(licen[sc]e|rights)')} AND {d.matches('lower(text)', '(the|und|les)')}"


@lens
def set_operations(d):
    return "SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) u UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) i UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) e"


@lens
def grouping_sets(d):
    return f"SELECT l_returnflag AS flag, l_linestatus AS status, count(*) AS n, {money('sum(CAST(l_quantity AS DECIMAL(18,2)))')} AS qty FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())"
