"""Evidence lenses: signals to verdicts by a precedence ladder, with human rulings first.

Stand-ins: an event is a signal about its user (the brand); its type is the signal's name and its value the strength.
The catalogue below says what a signal points to and how much it counts; it is configuration, not code.
"""

from __future__ import annotations

from .dialect import SparkSql

LENSES: dict = {}

#: (signal, tier, points to); tiers: definitive and claimed decide, research never does.
CATALOGUE = (
    ("purchase", "definitive", "yes"),
    ("signup", "claimed", "yes"),
    ("click", "research", "yes"),
    ("view", "research", "no"),
    ("error", "legal", "no"),
)


def lens(f):
    LENSES[f.__name__] = f
    return f


def _signals(d: SparkSql) -> str:
    rows = " UNION ALL ".join(f"SELECT '{s}' AS signal, '{t}' AS tier, '{p}' AS points_to" for s, t, p in CATALOGUE)
    return f"""cat AS ({rows}),
sig AS (SELECT user_id AS brand, event_type AS signal, tier, points_to, value, ts, event_id,
  CASE WHEN value >= 95 THEN 'definitional' WHEN value >= 80 THEN 'confirmed' WHEN value >= 60 THEN 'strong' WHEN value >= 40 THEN 'moderate' WHEN value >= 20 THEN 'weak' ELSE 'trace' END AS strength,
  CASE WHEN value >= 95 THEN 6 WHEN value >= 80 THEN 5 WHEN value >= 60 THEN 4 WHEN value >= 40 THEN 3 WHEN value >= 20 THEN 2 ELSE 1 END AS rank
  FROM events JOIN cat ON event_type = cat.signal),
human AS (SELECT c_custkey AS brand, CASE WHEN c_acctbal < -800 THEN 'no' WHEN c_acctbal > 9500 THEN 'yes' END AS ruling FROM customer WHERE c_acctbal < -800 OR c_acctbal > 9500)"""


def _verdict(d: SparkSql) -> str:
    return f"""{_signals(d)},
agg AS (SELECT brand, bool_or(tier = 'definitive' AND rank >= 6) AS sure, bool_or(tier = 'claimed' AND rank >= 6) AS claimed, bool_or(tier = 'legal' AND rank >= 6) AS legal,
  max(rank) AS rank, count(*) AS n, {d.joined('signal', 'rank >= 5')} AS evidence FROM sig GROUP BY brand),
ids AS (SELECT brand FROM agg UNION SELECT brand FROM human),
verdict AS (SELECT i.brand, CASE WHEN h.ruling = 'no' THEN 'no' WHEN h.ruling = 'yes' THEN 'yes' WHEN a.sure OR a.claimed THEN 'yes' WHEN a.legal THEN 'no' ELSE 'unknown' END AS verdict,
  CASE WHEN h.ruling IS NOT NULL THEN 'human' WHEN a.sure THEN 'definitive' WHEN a.claimed THEN 'claimed' WHEN a.legal THEN 'legal' ELSE 'research' END AS tier, a.rank, a.n, a.evidence
  FROM ids i LEFT JOIN agg a ON i.brand = a.brand LEFT JOIN human h ON i.brand = h.brand)"""


_LABEL = "CASE max(rank) WHEN 6 THEN 'definitional' WHEN 5 THEN 'confirmed' WHEN 4 THEN 'strong' WHEN 3 THEN 'moderate' WHEN 2 THEN 'weak' ELSE 'trace' END"


@lens
def verdict(d):
    """One row a brand: human no, human yes, a deciding signal, a legal record, else unknown."""
    return f"WITH {_verdict(d)} SELECT brand, verdict, tier, rank, n, evidence FROM verdict"


@lens
def verdict_company(d):
    """The same rules at company grain: a human no of any brand wins."""
    return f"""WITH {_verdict(d)}, g AS (SELECT coalesce(c_nationkey, -1) AS company, v.* FROM verdict v LEFT JOIN customer ON c_custkey = v.brand)
SELECT company, count(*) AS brands, CASE WHEN bool_or(verdict = 'no' AND tier = 'human') THEN 'no' WHEN bool_or(verdict = 'yes') THEN 'yes' WHEN bool_or(verdict = 'no') THEN 'no' ELSE 'unknown' END AS verdict FROM g GROUP BY company"""


@lens
def evidence_grid(d):
    """A brand's indicators as booleans and the next step."""
    flags = ", ".join(f"bool_or(signal = '{s}' AND rank >= 5) AS has_{s}" for s, _, _ in CATALOGUE)
    return f"""WITH {_signals(d)}, g AS (SELECT brand, {flags}, count(DISTINCT signal) AS families FROM sig GROUP BY brand)
SELECT *, CASE WHEN has_purchase THEN 'done' WHEN has_signup THEN 'confirm' WHEN families >= 3 THEN 'review' ELSE 'collect' END AS next_step FROM g"""


@lens
def contention(d):
    """Brands with strong evidence in both directions."""
    return f"""WITH {_signals(d)}, s AS (SELECT brand, count(*) FILTER (WHERE points_to = 'yes' AND rank >= 5) AS yes, count(*) FILTER (WHERE points_to = 'no' AND rank >= 5) AS no FROM sig GROUP BY brand)
SELECT brand, yes, no, CASE WHEN yes > 2 * no THEN 'low' WHEN no > 2 * yes THEN 'low' WHEN yes + no >= 20 THEN 'high' ELSE 'medium' END AS priority FROM s WHERE yes > 0 AND no > 0"""


@lens
def evidence_trail(d):
    """The strongest signals of a brand as JSON, in order, with the number of families."""
    return f"""WITH {_signals(d)}, t AS (SELECT brand, signal, strength, event_id FROM sig WHERE rank >= 6)
SELECT brand, {d.pairs_json('signal', 'strength', 'event_id')} AS trail, count(DISTINCT signal) AS families, count(DISTINCT signal) >= 3 AS complete FROM t GROUP BY brand"""


@lens
def indicators(d):
    """Signals by brand, the list in order, and the label of the greatest strength."""
    return f"WITH {_signals(d)} SELECT brand, {d.joined('signal')} AS signals, {_LABEL} AS best FROM sig WHERE points_to = 'yes' GROUP BY brand"


@lens
def pools(d):
    """The latest declaration of a brand decides its pool."""
    return f"""WITH {_verdict(d)}, dec AS (SELECT user_id AS brand, event_type AS declared, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type IN ('signup', 'error'))
SELECT v.brand, v.verdict, dec.declared, CASE WHEN v.verdict = 'no' THEN 'out' WHEN dec.declared = 'signup' AND v.verdict = 'yes' THEN 'ours' WHEN dec.declared = 'error' THEN 'disputed' ELSE 'open' END AS pool FROM verdict v LEFT JOIN dec ON v.brand = dec.brand AND dec.rn = 1"""


@lens
def brand_reality(d):
    """Any of six facts makes a brand real; else a placeholder name junk; else it is a ghost."""
    return """WITH f AS (SELECT c_custkey AS brand, c_name AS name,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey) AS has_invoice, EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F') AS has_paid,
  EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'purchase') AS has_purchase, EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.event_type = 'signup') AS has_signup,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000) AS has_large, EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.c_custkey AND e.value > 99) AS has_peak FROM customer c)
SELECT *, CASE WHEN has_invoice OR has_paid OR has_purchase OR has_signup OR has_large OR has_peak THEN 'REAL' WHEN name LIKE '%7' THEN 'JUNK' ELSE 'GHOST' END AS grade FROM f"""


@lens
def research_queue(d):
    return f"WITH {_verdict(d)} SELECT brand, rank, n, evidence FROM verdict WHERE tier = 'research'"


@lens
def chase_list(d):
    """Real unbilled positives with their best contact: one with a phone (here an even key) first."""
    return f"""WITH {_verdict(d)}, billed AS (SELECT DISTINCT o_custkey AS brand FROM orders WHERE o_orderdate >= TIMESTAMP '2000-06-01 00:00:00'),
contact AS (SELECT s_nationkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey % 2 = 0 DESC, s_acctbal DESC, s_suppkey) AS rn FROM supplier)
SELECT v.brand, v.tier, s_name AS contact FROM verdict v JOIN customer c ON c.c_custkey = v.brand LEFT JOIN contact k ON k.s_nationkey = c.c_nationkey AND k.rn = 1 WHERE v.verdict = 'yes' AND NOT EXISTS (SELECT 1 FROM billed b WHERE b.brand = v.brand)"""


@lens
def review_state(d):
    """The latest review row of each subject."""
    return f"""WITH {_signals(d)}, r AS (SELECT brand, signal, strength, row_number() OVER (PARTITION BY brand ORDER BY ts DESC, event_id DESC) AS rn FROM sig) SELECT brand, signal AS last_signal, strength FROM r WHERE rn = 1"""


@lens
def verdict_rollup(d):
    return f"WITH {_verdict(d)} SELECT verdict, tier, count(*) AS brands, sum(n) AS signals FROM verdict GROUP BY verdict, tier"


@lens
def dominant_kind(d):
    """Brands of which one kind of event outnumbers all the others together."""
    return "SELECT user_id AS brand, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS looks, count(*) FILTER (WHERE event_type NOT IN ('click', 'view')) AS rest FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type IN ('click', 'view')) > count(*) FILTER (WHERE event_type NOT IN ('click', 'view'))"


@lens
def opposed_rulings(d):
    """Subjects with more than one live ruling that disagree."""
    return "SELECT user_id AS brand, count(DISTINCT event_type) AS rulings FROM events WHERE event_type IN ('signup', 'error') AND value > 97 GROUP BY user_id HAVING count(DISTINCT event_type) > 1"


@lens
def declaration_seed(d):
    """A first declaration for each brand that has none yet."""
    return f"""WITH {_verdict(d)}, known AS (SELECT DISTINCT user_id AS brand FROM events WHERE event_type = 'signup' AND value > 98) SELECT v.brand, CASE v.verdict WHEN 'yes' THEN 'declared' WHEN 'no' THEN 'declined' ELSE 'pending' END AS state FROM verdict v LEFT ANTI JOIN known k ON v.brand = k.brand""".replace("LEFT ANTI JOIN known k ON v.brand = k.brand", "WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.brand = v.brand)")


@lens
def supersede_chain(d):
    """Which later fact of the same subject and field replaced a fact; the live one has none."""
    return "SELECT event_id, user_id AS subject, event_type AS field, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS superseded_by FROM events"


@lens
def added_current(d):
    return "WITH s AS (SELECT event_id, user_id AS subject, event_type AS field, value, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS later FROM events) SELECT event_id, subject, field, value FROM s WHERE later IS NULL"


@lens
def check_queue(d):
    """What is to be checked, and why first: contended brands, then those that only research speaks for, with their largest invoice."""
    return f"""WITH {_verdict(d)}, c AS (SELECT brand, count(*) FILTER (WHERE points_to = 'yes' AND rank >= 5) AS yes, count(*) FILTER (WHERE points_to = 'no' AND rank >= 5) AS no FROM sig GROUP BY brand),
q AS (SELECT v.brand, CASE WHEN c.yes > 0 AND c.no > 0 THEN 1 WHEN v.tier = 'research' THEN 2 ELSE 3 END AS step, c.yes, c.no, v.tier FROM verdict v LEFT JOIN c ON v.brand = c.brand WHERE v.tier <> 'human')
SELECT brand, step, CASE step WHEN 1 THEN 'contended' WHEN 2 THEN 'research only' ELSE 'machine verdict' END AS reason, coalesce((SELECT max(o_totalprice) FROM orders WHERE o_custkey = brand), 0) AS largest FROM q"""
