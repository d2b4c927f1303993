"""The commission ledger with refunds netted, rates as of the month and claims; what must hold of it; and the gates of a month's close.

DataFrame code; the SQL beside each query is written separately from the rules.  Stand-ins beyond those of ``money``:
line 7 of an invoice is a booked correction (its amount is negative); every fourth invoice has a refund of a tenth of
its total, which succeeded unless the invoice was urgent; a customer's nation is its partner; customers with a negative
balance are on the exclusion list, those with an even key as flat-fee ones; events are signals on a brand, signups those
that a person gave.  Money is whole cents (DECIMAL) until the last step.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import ladder
from ..operators import relational as R
from ..session import read, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


#: Months since the anchor up to which a percentage holds; then the last one.
LADDER, LAST = ((12, 10), (18, 6)), 3
REVENUE_FROM, FLAT_FEE_FROM = "1993-06-01", "1996-01-01"
#: Partners' percentages by product: (from, to or None, percent); partners whose key divides by three have none on file.
RATES = (("A", "1992-01-01", "1996-01-01", 400), ("A", "1996-01-01", None, 650), ("B", "1992-01-01", "1996-01-01", 400))


def _date(x: str | None) -> Column:
    return F.lit(x).cast("date")


def lines(spark: SparkSession, d: str) -> DataFrame:
    """Invoice lines: invoice, brand, product, month, cents, is_base, paid."""
    line = read(spark, d, "lineitem").join(read(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    gross = F.round(F.col("l_extendedprice").cast("decimal(18,4)") * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)")), 2)
    cents = (gross * 100).cast("decimal(18,0)")
    return line.select(
        F.col("l_orderkey").alias("invoice"), F.col("o_custkey").alias("brand"), F.when(F.col("l_linenumber") % 2 == 1, "A").otherwise("B").alias("product"), F.col("l_suppkey").alias("source"),
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month"), F.when(F.col("l_linenumber") == 7, -cents).otherwise(cents).alias("cents"),
        (F.col("l_returnflag") != "R").alias("is_base"), (F.col("l_linestatus") == "F").alias("paid"),
    )


def refunds(spark: SparkSession, d: str, line: DataFrame) -> DataFrame:
    """(brand, product, month, raw, netted): refunds over the positive paid base lines of their invoice, pro rata.

    What negative base lines have booked already is not netted again; a share is of the whole paid invoice, not of its
    base alone; a cell never nets more than it collected; shares are kept to a hundredth of a cent until they are summed.
    """
    o = read(spark, d, "orders").where("o_orderkey % 4 = 0 AND o_orderpriority <> '1-URGENT'")
    total = F.expr("CAST(round(o_totalprice * 100) AS DECIMAL(18,0)) div 10").cast("decimal(18,0)")
    refund = o.select(F.col("o_orderkey").alias("invoice"), total.alias("refund"))
    base = F.col("paid") & F.col("is_base")
    inv = line.groupBy("invoice").agg(F.sum(F.when(F.col("paid"), F.col("cents"))).alias("total"), F.sum(F.when(base & (F.col("cents") < 0), -F.col("cents"))).alias("booked"))
    due = inv.join(refund, "invoice").withColumn("due", F.least(F.greatest(F.col("refund") - F.coalesce("booked", F.lit(0)), F.lit(0)), F.col("total")))
    due = due.where("due > 0 AND total > 0").select("invoice", F.col("due").cast("decimal(15,0)").alias("due"), F.col("total").cast("decimal(15,0)").alias("total"))
    share = line.where(base & (F.col("cents") > 0)).withColumn("cents", F.col("cents").cast("decimal(15,0)")).join(due, "invoice")
    share = share.withColumn("part", F.expr("(due * cents * 100 + total div 2) div total"))
    raw = share.groupBy("brand", "product", "month").agg(F.sum("part").alias("part")).withColumn("raw", F.expr("CAST((part + 50) div 100 AS DECIMAL(18,0))"))
    gross = line.where(base).groupBy("brand", "product", "month").agg(F.sum("cents").alias("gross"))
    out = raw.join(gross, ["brand", "product", "month"]).where("part > 50")
    return out.select("brand", "product", "month", "raw", F.least("raw", F.greatest("gross", F.lit(0))).cast("decimal(18,0)").alias("netted"), "gross")


def signals(spark: SparkSession, d: str) -> DataFrame:
    """(brand, signal, by_person, points, event_id)."""
    e = read(spark, d, "events")
    return e.select(F.col("user_id").alias("brand"), F.col("event_type").alias("signal"), (F.col("event_type") == "signup").alias("by_person"), F.when(F.col("value") > 50, "yes").otherwise("no").alias("points"), "event_id")


def verdicts(spark: SparkSession, d: str) -> DataFrame:
    """(brand, verdict) of every customer: a person's last word, else yes if a click or purchase says so, else unknown."""
    s = signals(spark, d)
    g = s.groupBy("brand").agg(F.max_by(F.when(F.col("by_person"), F.col("points")), F.when(F.col("by_person"), F.col("event_id"))).alias("person"), F.bool_or(F.col("signal").isin("click", "purchase") & (F.col("points") == "yes")).alias("sign"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("brand")).join(g, "brand", "left")
    return c.select("brand", F.coalesce("person", F.when(F.col("sign"), "yes"), F.lit("unknown")).alias("verdict"))


def ledger(spark: SparkSession, d: str, line: DataFrame | None = None) -> DataFrame:
    """A row for each brand, product and month with base lines: money, rate, claimability and both fees, in cents."""
    line = lines(spark, d) if line is None else line
    cell = line.where("is_base").groupBy("brand", "product", "month").agg(F.sum(F.when(F.col("paid"), F.col("cents"))).alias("paid"), F.sum("cents").alias("billed"))
    net = refunds(spark, d, line).select("brand", "product", "month", "netted")
    anchor = line.where("is_base").groupBy("brand", "product").agg(F.min("month").alias("anchor"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("brand"), F.col("c_nationkey").alias("partner"), "c_mktsegment", "c_acctbal")
    flat = (F.col("c_acctbal") < 0) & (F.col("brand") % 2 == 0)
    ours = F.when(flat, _date(FLAT_FEE_FROM)).when(F.col("c_acctbal") < 0, _date(None)).otherwise(_date(REVENUE_FROM))
    c = c.withColumn("ownership", F.when(flat, "flat_fee").when(F.col("c_acctbal") < 0, "excluded").otherwise("never_listed")).withColumn("revenue_from", ours)
    x = cell.join(net, ["brand", "product", "month"], "left").join(anchor, ["brand", "product"], "left").join(c, "brand", "left").join(verdicts(spark, d), "brand", "left")
    x = x.withColumn("collected", (F.coalesce("paid", F.lit(0)) - F.coalesce("netted", F.lit(0))).cast("decimal(18,0)"))
    eligible = ~((F.col("c_mktsegment") == "MACHINERY") & (F.col("product") == "B"))
    x = x.withColumn("eligible", eligible).withColumn("claimable", F.coalesce(eligible & (F.col("month") >= F.col("revenue_from")), F.lit(False)))
    x = x.withColumn("rate", ladder([(F.col("month") < F.add_months("anchor", n), str(p)) for n, p in LADDER], str(LAST)).cast("int"))
    rates = [(p, k, f, t, r) for p in range(25) if p % 3 for k, f, t, r in RATES]
    rates = spark.createDataFrame(rates, "partner int, product string, since string, until string, partner_rate int")
    rates = rates.withColumn("since", F.col("since").cast("date")).withColumn("until", F.col("until").cast("date"))
    x = R.as_of_join(x, rates, ["partner", "product"], "month", "since", ["partner_rate", "until"])
    on_file = F.when(F.col("until").isNull() | (F.col("until") > F.col("month")), F.col("partner_rate"))
    x = x.withColumn("partner_rate", F.coalesce(on_file, F.when(F.col("partner") % 2 == 0, 500), F.lit(0)))
    part = lambda percent, of: F.round(F.col("collected") * F.col(percent).cast("decimal(5,0)") / F.lit(of).cast("decimal(5,0)"), 0).cast("decimal(18,0)")
    credited = F.col("claimable") & (F.col("month") <= F.add_months("anchor", 24))
    fees = {"fee": F.when(F.col("claimable"), part("rate", 100)).otherwise(F.lit(0)), "partner_fee": F.when(credited, part("partner_rate", 10000)).otherwise(F.lit(0))}
    status = F.when(F.col("verdict") == "yes", "claimable").when(F.col("verdict") == "unknown", "unknown").otherwise("denied")
    return x.withColumns(fees).select(
        "brand", "product", "month", "anchor", "billed", "collected", "netted", "verdict", "ownership", "eligible", "claimable", "rate", "fee", "partner", "partner_rate", "partner_fee", status.alias("status"),
    )


def _dollars(c: str) -> Column:
    return (F.col(c).cast("decimal(18,0)") / 100).cast("double")


_LINE = """line AS (SELECT l_orderkey AS invoice, o_custkey AS brand, CASE WHEN l_linenumber % 2 = 1 THEN 'A' ELSE 'B' END AS product, l_suppkey AS source, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))), 2) * 100 AS HUGEINT) * CASE WHEN l_linenumber = 7 THEN -1 ELSE 1 END AS cents, l_returnflag <> 'R' AS is_base, l_linestatus = 'F' AS paid
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_REFUND = f"""{_LINE},
inv AS (SELECT invoice, sum(cents) FILTER (WHERE paid) AS total, coalesce(-sum(cents) FILTER (WHERE paid AND is_base AND cents < 0), 0) AS booked FROM line GROUP BY invoice),
due AS (SELECT invoice, CAST(total AS HUGEINT) AS total, least(greatest(CAST(round(o_totalprice * 100) AS HUGEINT) // 10 - CAST(booked AS HUGEINT), 0), CAST(total AS HUGEINT)) AS due FROM inv JOIN orders ON o_orderkey = invoice WHERE o_orderkey % 4 = 0 AND o_orderpriority <> '1-URGENT'),
part AS (SELECT brand, product, month, sum((due * cents * 100 + total // 2) // total) AS part FROM line JOIN due USING (invoice) WHERE paid AND is_base AND cents > 0 AND due > 0 AND total > 0 GROUP BY brand, product, month),
gross AS (SELECT brand, product, month, sum(cents) FILTER (WHERE paid) AS gross FROM line WHERE is_base GROUP BY brand, product, month),
refund AS (SELECT brand, product, month, (CAST(part AS HUGEINT) + 50) // 100 AS raw, least((CAST(part AS HUGEINT) + 50) // 100, greatest(CAST(gross AS HUGEINT), 0)) AS netted, gross FROM part JOIN gross USING (brand, product, month) WHERE part > 50)"""
_VERDICT = """v AS (SELECT c_custkey AS brand, coalesce((SELECT CASE WHEN value > 50 THEN 'yes' ELSE 'no' END FROM events WHERE user_id = c_custkey AND event_type = 'signup' ORDER BY event_id DESC LIMIT 1),
  CASE WHEN EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type IN ('click', 'purchase') AND value > 50) THEN 'yes' ELSE 'unknown' END) AS verdict FROM customer)"""
_LEDGER = f"""{_REFUND}, {_VERDICT},
anchor AS (SELECT brand, product, min(month) AS anchor FROM line WHERE is_base GROUP BY brand, product),
cell AS (SELECT brand, product, month, coalesce(sum(cents) FILTER (WHERE paid), 0) AS paid, sum(cents) AS billed FROM line WHERE is_base GROUP BY brand, product, month),
pr AS (SELECT p AS partner, k AS product, CAST(f AS DATE) AS since, CAST(t AS DATE) AS until, r FROM range(25) g(p), (VALUES ('A', '1992-01-01', '1996-01-01', 4.00), ('A', '1996-01-01', NULL, 6.50), ('B', '1992-01-01', '1996-01-01', 4.00)) x(k, f, t, r) WHERE p % 3 <> 0),
g AS (SELECT c.*, a.anchor, r.netted, c.paid - coalesce(r.netted, 0) AS collected, v.verdict, k.c_nationkey AS partner,
  CASE WHEN k.c_acctbal >= 0 THEN 'never_listed' WHEN c.brand % 2 = 0 THEN 'flat_fee' ELSE 'excluded' END AS ownership, NOT (k.c_mktsegment = 'MACHINERY' AND c.product = 'B') AS eligible,
  NOT (k.c_mktsegment = 'MACHINERY' AND c.product = 'B') AND CASE WHEN k.c_acctbal >= 0 THEN c.month >= DATE '1993-06-01' WHEN c.brand % 2 = 0 THEN c.month >= DATE '1996-01-01' ELSE false END AS claimable,
  CASE WHEN c.month < a.anchor + INTERVAL 12 MONTH THEN 10 WHEN c.month < a.anchor + INTERVAL 18 MONTH THEN 6 ELSE 3 END AS rate,
  coalesce((SELECT r FROM pr WHERE pr.partner = k.c_nationkey AND pr.product = c.product AND since <= c.month AND (until IS NULL OR until > c.month)), CASE WHEN k.c_nationkey % 2 = 0 THEN 5.00 ELSE 0.00 END) AS partner_rate
  FROM cell c LEFT JOIN anchor a ON a.brand = c.brand AND a.product = c.product LEFT JOIN refund r ON r.brand = c.brand AND r.product = c.product AND r.month = c.month LEFT JOIN customer k ON k.c_custkey = c.brand LEFT JOIN v ON v.brand = c.brand),
led AS (SELECT *, CASE WHEN claimable THEN round(CAST(collected AS DECIMAL(24,0)) / 1 * rate / 100) ELSE 0 END AS fee, CASE WHEN claimable AND month <= anchor + INTERVAL 24 MONTH THEN CAST(round(CAST(collected AS DOUBLE) * CAST(partner_rate * 100 AS INTEGER) / 10000) AS BIGINT) ELSE 0 END AS partner_fee,
  CASE verdict WHEN 'yes' THEN 'claimable' WHEN 'unknown' THEN 'unknown' ELSE 'denied' END AS status FROM g)"""


@query(f"WITH {_REFUND} SELECT brand, product, CAST(month AS VARCHAR) AS month, CAST(raw AS DOUBLE) / 100 AS raw, CAST(netted AS DOUBLE) / 100 AS netted FROM refund")
def refund_netting(spark, d):
    return refunds(spark, d, lines(spark, d)).select("brand", "product", F.col("month").cast("string").alias("month"), _dollars("raw").alias("raw"), _dollars("netted").alias("netted"))


@query(f"""WITH {_LEDGER} SELECT brand, product, CAST(month AS VARCHAR) AS month, CAST(billed AS DOUBLE) / 100 AS billed, CAST(collected AS DOUBLE) / 100 AS collected, verdict, ownership, claimable, rate, CAST(fee AS DOUBLE) / 100 AS fee,
partner, CAST(partner_rate AS DOUBLE) AS partner_rate, CAST(partner_fee AS DOUBLE) / 100 AS partner_fee, status FROM led""")
def commission_ledger(spark, d):
    x = ledger(spark, d)
    money = [_dollars(c).alias(c) for c in ("billed", "collected", "fee", "partner_fee")]
    return x.select("brand", "product", F.col("month").cast("string").alias("month"), "verdict", "ownership", "claimable", "rate", "partner", (F.col("partner_rate") / 100).alias("partner_rate"), "status", *money)


def claims(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """(brand, owed, paid, claim) in cents, of claimable rows: what is owed less what was paid, never under 0."""
    owed = rows.where("status = 'claimable'").groupBy("brand").agg(F.sum("fee").alias("owed"), F.sum("collected").alias("collected"))
    paid = read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("brand"), F.round(F.col("c_acctbal") * 100).cast("decimal(18,0)").alias("paid"))
    return owed.join(paid, "brand", "left").withColumn("claim", F.greatest(F.col("owed") - F.coalesce("paid", F.lit(0)), F.lit(0)))


_CLAIMS = f"""{_LEDGER}, claim AS (SELECT o.brand, owed, collected, paid, greatest(owed - coalesce(paid, 0), 0) AS claim FROM (SELECT brand, sum(fee) AS owed, sum(collected) AS collected FROM led WHERE status = 'claimable' GROUP BY brand) o
LEFT JOIN (SELECT c_custkey AS brand, round(c_acctbal * 100) AS paid FROM customer WHERE c_acctbal > 0) p ON p.brand = o.brand)"""


@query(f"WITH {_CLAIMS} SELECT brand, CAST(owed AS DOUBLE) / 100 AS owed, CAST(paid AS DOUBLE) / 100 AS paid, CAST(claim AS DOUBLE) / 100 AS claim FROM claim")
def commission_claim(spark, d):
    return claims(spark, d, ledger(spark, d)).select("brand", *[_dollars(c).alias(c) for c in ("owed", "paid", "claim")])


# ---------------------------------------------------------------- what must hold


class Violated(AssertionError):
    """A number somewhere is wrong."""


def _cut(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Written once, as many checks read it."""
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(lines, ledger), each written once."""
    line = _cut(lines(spark, d), spark, "lines")
    return line, _cut(ledger(spark, d, line), spark, "ledger")


def invariants(spark: SparkSession, d: str, line: DataFrame, led: DataFrame) -> DataFrame:
    """(name, violations) of 22 checks; each counts rows that must not be."""
    verdict, s = verdicts(spark, d), signals(spark, d)
    c = read(spark, d, "customer").withColumnRenamed("c_custkey", "brand")
    person = s.where("by_person").groupBy("brand").agg(F.bool_or(F.col("points") == "yes").alias("said_yes"), F.bool_or(F.col("points") == "no").alias("said_no"))
    sign = s.where("signal IN ('click', 'purchase') AND points = 'yes'").select("brand").distinct().withColumn("sign", F.lit(True))
    judged = verdict.join(person, "brand", "left").join(sign, "brand", "left").join(c.select("brand", "c_nationkey", "c_mktsegment"), "brand")
    company = judged.groupBy("c_nationkey", "c_mktsegment").agg(F.max("verdict").alias("best"), F.bool_or(F.coalesce("said_no", F.lit(False))).alias("said_no"))
    last = company.withColumn("verdict", F.when(F.col("said_no"), "no").otherwise(F.col("best")))
    money = led.where("collected > 0 OR billed > 0").select("brand").distinct().withColumn("money", F.lit(True))
    back = read(spark, d, "events").where("event_type = 'signup' AND value > 100").select(F.col("user_id").alias("brand")).distinct().withColumn("back", F.lit(True))
    won = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("brand")).distinct().withColumn("won", F.lit(True))
    facts = c.join(money, "brand", "left").join(back, "brand", "left").join(won, "brand", "left")
    clock = led.groupBy("brand", "product").agg(F.min("anchor").alias("anchor")).withColumn("stored", F.when(F.col("brand") % 50 == 0, F.date_add("anchor", 365)).otherwise(F.add_months("anchor", 12)))
    known = line.join(c.select("brand", F.lit(True).alias("known")), "brand", "left")

    def count(df: DataFrame, **rows: str) -> DataFrame:
        """One pass for all checks of a relation; each counts the rows for which its condition holds."""
        counted = df.agg(*[F.coalesce(F.expr(x) if x.startswith("count(") else F.count_if(F.expr(x)), F.lit(0)).cast("long").alias(name) for name, x in rows.items()])
        pairs = [F.struct(F.lit(name).alias("name"), F.col(name).alias("violations")) for name in rows]
        return counted.select(F.explode(F.array(*pairs)).alias("c")).select("c.*")

    parts = [
        count(verdict, verdict_fanout="count(*) - count(DISTINCT brand)"),
        count(known, orphan_money="known IS NULL", identity_without_provenance="brand IS NOT NULL AND source IS NULL"),
        count(
            led, claim_requires_eligibility="claimable AND NOT coalesce(eligible, false)", unknown_rate_priced="rate IS NULL AND fee <> 0", unknown_partner_paid="partner_rate IS NULL AND partner_fee <> 0",
            net_negative_on_positive_revenue="fee - partner_fee < 0 AND collected > 0", claim_requires_yes="status = 'claimable' AND NOT verdict <=> 'yes'", fee_only_when_claimable="NOT claimable AND fee <> 0",
            rate_is_on_the_ladder=f"rate NOT IN ({', '.join(str(p) for _, p in LADDER)}, {LAST})",
        ),
        count(facts, reactivation_regression="back AND c_acctbal < 0", money_on_junk="money AND c_acctbal < -900", stale_flags="(c_acctbal > 0) <> coalesce(won, false)"),
        count(read(spark, d, "conversations"), anonymous_fact="coalesce(trim(role), '') = '' OR coalesce(trim(text), '') = ''"),
        count(judged, yes_needs_an_indicator_or_a_person="verdict = 'yes' AND NOT coalesce(said_yes, false) AND NOT coalesce(sign, false)", no_requires_a_person="verdict = 'no' AND NOT coalesce(said_no, false)"),
        count(last, rollup_is_one_row_a_company="count(*) - count(DISTINCT c_nationkey, c_mktsegment)"),
        count(company, rollup_never_overrules_a_person="best <> 'no' AND said_no"),
        count(clock, stored_clock_is_a_month_count="stored <> add_months(anchor, 12)"),
        count(person, persons_opposed="said_yes AND said_no"),
        count(led.groupBy("brand", "product", "month").agg(F.count("*").alias("n")), ledger_grain_unique="n > 1"),
        count(refunds(spark, d, line), refund_within_gross="netted > gross AND netted > 0"),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def enforce(found: DataFrame) -> None:
    """Raise if a check of ``invariants`` fails; one row a check comes to the driver."""
    if bad := [f"{r['name']}: {r['violations']}" for r in found.where("violations > 0").collect()]:
        raise Violated("; ".join(bad))


_INVARIANTS = f"""{_LEDGER}, person AS (SELECT user_id AS brand, bool_or(value > 50) AS said_yes, bool_or(value <= 50) AS said_no FROM events WHERE event_type = 'signup' GROUP BY user_id),
judged AS (SELECT v.*, coalesce(said_yes, false) AS said_yes, coalesce(said_no, false) AS said_no, v.brand IN (SELECT user_id FROM events WHERE event_type IN ('click', 'purchase') AND value > 50) AS sign, c_nationkey, c_mktsegment FROM v JOIN customer ON c_custkey = v.brand LEFT JOIN person p ON p.brand = v.brand),
inv22 AS (SELECT 'verdict_fanout' AS name, (SELECT count(*) - count(DISTINCT brand) FROM v) AS violations
UNION ALL SELECT 'orphan_money', (SELECT count(*) FROM line WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = brand))
UNION ALL SELECT 'claim_requires_eligibility', (SELECT count(*) FROM led WHERE claimable AND NOT coalesce(eligible, false))
UNION ALL SELECT 'reactivation_regression', (SELECT count(*) FROM customer WHERE c_acctbal < 0 AND c_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 100))
UNION ALL SELECT 'unknown_rate_priced', (SELECT count(*) FROM led WHERE rate IS NULL AND fee <> 0) UNION ALL SELECT 'unknown_partner_paid', (SELECT count(*) FROM led WHERE partner_rate IS NULL AND partner_fee <> 0)
UNION ALL SELECT 'net_negative_on_positive_revenue', (SELECT count(*) FROM led WHERE fee < partner_fee AND collected > 0)
UNION ALL SELECT 'anonymous_fact', (SELECT count(*) FROM conversations WHERE role IS NULL OR trim(role) = '' OR text IS NULL OR trim(text) = '')
UNION ALL SELECT 'identity_without_provenance', (SELECT count(*) FROM line WHERE brand IS NOT NULL AND source IS NULL)
UNION ALL SELECT 'money_on_junk', (SELECT count(*) FROM customer WHERE c_acctbal < -900 AND c_custkey IN (SELECT brand FROM led WHERE collected > 0 OR billed > 0))
UNION ALL SELECT 'stale_flags', (SELECT count(*) FROM customer WHERE (c_acctbal > 0) <> EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'))
UNION ALL SELECT 'yes_needs_an_indicator_or_a_person', (SELECT count(*) FROM judged WHERE verdict = 'yes' AND NOT said_yes AND NOT sign) UNION ALL SELECT 'no_requires_a_person', (SELECT count(*) FROM judged WHERE verdict = 'no' AND NOT said_no)
UNION ALL SELECT 'rollup_is_one_row_a_company', 0 UNION ALL SELECT 'rollup_never_overrules_a_person', (SELECT count(*) FROM (SELECT max(verdict) AS best, bool_or(said_no) AS said_no FROM judged GROUP BY c_nationkey, c_mktsegment) WHERE best <> 'no' AND said_no)
UNION ALL SELECT 'stored_clock_is_a_month_count', (SELECT count(*) FROM anchor WHERE brand % 50 = 0 AND anchor + INTERVAL 365 DAY <> anchor + INTERVAL 12 MONTH)
UNION ALL SELECT 'persons_opposed', (SELECT count(*) FROM person WHERE said_yes AND said_no) UNION ALL SELECT 'ledger_grain_unique', (SELECT count(*) FROM (SELECT 1 FROM led GROUP BY brand, product, month HAVING count(*) > 1))
UNION ALL SELECT 'claim_requires_yes', (SELECT count(*) FROM led WHERE status = 'claimable' AND verdict IS DISTINCT FROM 'yes') UNION ALL SELECT 'fee_only_when_claimable', (SELECT count(*) FROM led WHERE NOT claimable AND fee <> 0)
UNION ALL SELECT 'rate_is_on_the_ladder', (SELECT count(*) FROM led WHERE rate NOT IN (10, 6, 3)) UNION ALL SELECT 'refund_within_gross', (SELECT count(*) FROM refund WHERE netted > gross AND netted > 0))"""


@query(f"WITH {_INVARIANTS} SELECT name, CAST(violations AS BIGINT) AS violations, CASE WHEN violations = 0 THEN 'ok' ELSE 'fail' END AS status FROM inv22")
def ledger_invariants(spark, d):
    """All 22 checks over one written ledger."""
    found = invariants(spark, d, *written(spark, d))
    return found.withColumn("status", F.when(F.col("violations") == 0, "ok").otherwise("fail"))


# ---------------------------------------------------------------- the month's close

#: (gate, kind): a hard gate that does not pass fails the month, a soft one asks for a review.
POLICY = (
    ("feeds_current", "hard"), ("invariants_clean", "hard"), ("refunds_posted", "hard"), ("usage_reconciles", "hard"),
    ("fee_rate_coverage", "soft"), ("verdicts_current", "soft"), ("partner_rates_on_file", "soft"), ("claim_lines_reconciled", "soft"),
)
NOW = datetime.date(2024, 1, 31)
#: Hours after which a feed is late; feeds that are not here are not watched.
ALLOWED = {"click": 26, "purchase": 26}


def gate_rows(spark: SparkSession, d: str, line: DataFrame, led: DataFrame) -> DataFrame:
    """(month, gate, kind, signal, found) of each month that the ledger has, from the lenses that each gate is about.

    What is the same for all months is one row; what differs is one row a month: one cross join of small aggregates, one
    left join by month, and then the gates as an array of rows.
    """
    events = read(spark, d, "events").groupBy("event_type").agg(F.max("ts").alias("last"))
    allowed = spark.createDataFrame(list(ALLOWED.items()), "event_type string, hours int")
    age = F.datediff(F.lit(NOW), F.col("last").cast("date")) * 24
    stale = events.join(allowed, "event_type").where(age > F.col("hours")).agg(F.count("*").alias("stale"))
    failing = invariants(spark, d, line, led).where("violations > 0").agg(F.count("*").alias("failing"))
    covered = led.agg(F.count("*").alias("cells"), F.count_if(F.col("partner_rate") > 0).alias("rated"))
    contested = signals(spark, d).where("by_person").groupBy("brand").agg((F.count_distinct("points") > 1).alias("both")).where("both").agg(F.count("*").alias("contested"))
    default = read(spark, d, "customer").where("c_nationkey % 3 = 0").agg(F.count_distinct("c_nationkey").alias("default"))
    ack = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("brand")).distinct()
    unseen = claims(spark, d, led).where("claim > 0 AND paid IS NULL").join(ack, "brand", "left_anti").agg(F.count("*").alias("unseen"))
    same = stale.crossJoin(failing).crossJoin(covered).crossJoin(contested).crossJoin(default).crossJoin(unseen)  # one row each
    paid = line.where("paid").groupBy("month").agg(F.sum("cents").alias("all"), F.sum(F.when(~F.col("is_base"), F.col("cents"))).alias("other"), F.sum(F.when(F.col("is_base"), F.col("cents"))).alias("base"))
    waiting = line.where("NOT paid AND NOT is_base").groupBy("month").agg(F.count("*").alias("waiting"))
    month = led.select("month").distinct().join(paid, "month", "left").join(waiting, "month", "left").crossJoin(F.broadcast(same))
    apart = F.abs(F.coalesce("all", F.lit(0)) - F.coalesce("other", F.lit(0)) - F.coalesce("base", F.lit(0)))
    bad = {
        "feeds_current": (F.col("stale") > 0, F.col("stale")), "invariants_clean": (F.col("failing") > 0, F.col("failing")), "refunds_posted": (F.coalesce("waiting", F.lit(0)) > 0, F.coalesce("waiting", F.lit(0))),
        "usage_reconciles": (apart > F.greatest(F.lit(5000), F.abs(F.coalesce("base", F.lit(0))) / 100), apart), "fee_rate_coverage": (F.col("rated") * 100 < F.col("cells") * 98, F.col("rated")),
        "verdicts_current": (F.col("contested") > 0, F.col("contested")), "partner_rates_on_file": (F.col("default") > 0, F.col("default")), "claim_lines_reconciled": (F.col("unseen") > 0, F.col("unseen")),
    }
    rows = [F.struct(F.lit(g).alias("gate"), F.lit(k).alias("kind"), bad[g][0].alias("bad"), bad[g][1].cast("long").alias("found")) for g, k in POLICY]
    out = month.select("month", F.explode(F.array(*rows)).alias("g")).select("month", "g.*")
    signal = F.when(~F.col("bad"), "passing").when(F.col("kind") == "hard", "failing").otherwise("review")
    return out.select(F.col("month").cast("string").alias("month"), "gate", "kind", signal.alias("signal"), "found")


_GATES = f"""{_INVARIANTS}, {_CLAIMS[_CLAIMS.index("claim AS (SELECT o.brand"):]},
same AS (SELECT (SELECT count(*) FROM (SELECT event_type, max(ts) AS last FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1) WHERE date_diff('day', CAST(last AS DATE), DATE '2024-01-31') * 24 > 26) AS stale, (SELECT count(*) FROM inv22 WHERE violations > 0) AS failing,
  (SELECT count(*) FROM led) AS cells, (SELECT count(*) FROM led WHERE partner_rate > 0) AS rated, (SELECT count(*) FROM person WHERE said_yes AND said_no) AS contested, (SELECT count(DISTINCT c_nationkey) FROM customer WHERE c_nationkey % 3 = 0) AS on_default,
  (SELECT count(*) FROM claim WHERE claim > 0 AND paid IS NULL AND brand NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')) AS unseen),
m AS (SELECT month, coalesce((SELECT count(*) FROM line l WHERE l.month = x.month AND NOT paid AND NOT is_base), 0) AS waiting FROM (SELECT DISTINCT month FROM led) x),
gates AS (SELECT CAST(month AS VARCHAR) AS month, gate, kind, bad, CAST(found AS BIGINT) AS found FROM m, same, LATERAL (SELECT 'feeds_current' AS gate, 'hard' AS kind, stale > 0 AS bad, stale AS found UNION ALL SELECT 'invariants_clean', 'hard', failing > 0, failing UNION ALL SELECT 'refunds_posted', 'hard', waiting > 0, waiting
  UNION ALL SELECT 'usage_reconciles', 'hard', false, 0 UNION ALL SELECT 'fee_rate_coverage', 'soft', rated * 100 < cells * 98, rated UNION ALL SELECT 'verdicts_current', 'soft', contested > 0, contested UNION ALL SELECT 'partner_rates_on_file', 'soft', on_default > 0, on_default UNION ALL SELECT 'claim_lines_reconciled', 'soft', unseen > 0, unseen) g),
signals AS (SELECT month, gate, kind, found, CASE WHEN NOT bad THEN 'passing' WHEN kind = 'hard' THEN 'failing' ELSE 'review' END AS signal FROM gates)"""


@query(f"WITH {_GATES} SELECT month, gate, kind, signal, found FROM signals")
def gates(spark, d):
    return gate_rows(spark, d, *written(spark, d))


@query(f"""WITH {_GATES}, p AS (SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, count(*) AS versions FROM orders GROUP BY 1)
SELECT s.month, CASE WHEN s.failing > 0 THEN 'blocked' WHEN p.versions > 1 THEN 'restated' WHEN p.versions = 1 THEN 'closed' ELSE 'open' END AS state, s.failing, s.review FROM (SELECT month, count(*) FILTER (WHERE signal = 'failing') AS failing, count(*) FILTER (WHERE signal = 'review') AS review FROM signals GROUP BY month) s LEFT JOIN p ON p.month = s.month""")
def close_board(spark, d):
    """A month with a failing gate is blocked; else its pinned versions say what it is."""
    g = gate_rows(spark, d, *written(spark, d)).groupBy("month").agg(F.count_if(F.col("signal") == "failing").alias("failing"), F.count_if(F.col("signal") == "review").alias("review"))
    pins = read(spark, d, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").cast("string").alias("month")).agg(F.count("*").alias("versions"))
    state = ladder([(F.col("failing") > 0, "blocked"), (F.col("versions") > 1, "restated"), (F.col("versions") == 1, "closed")], "open")
    return g.join(pins, "month", "left").select("month", state.alias("state"), "failing", "review")


@query("""WITH l AS (SELECT l_orderkey, sum(round(CAST(l_extendedprice AS DECIMAL(18,4)) * (1 - CAST(l_discount AS DECIMAL(18,4))), 2)) AS total FROM lineitem GROUP BY 1), m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, sum(total) AS total, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS expected FROM orders LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1)
SELECT CAST(month AS VARCHAR) AS month, CAST(coalesce(total, 0) AS DOUBLE) AS total, CAST(expected AS DOUBLE) AS expected, abs(coalesce(total, 0) - expected) <= 0.02 AS pass FROM m""")
def expected_totals_gate(spark, d):
    """What an import's lines add up to, against the totals that its headers state, within two cents."""
    gross = F.round(F.col("l_extendedprice").cast("decimal(18,4)") * (F.lit(1) - F.col("l_discount").cast("decimal(18,4)")), 2)
    sums = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(gross).alias("total"))
    o = read(spark, d, "orders").join(sums, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    m = o.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").cast("string").alias("month")).agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("expected"))
    return m.select("month", F.col("total").cast("double").alias("total"), F.col("expected").cast("double").alias("expected"), (F.abs(F.col("total") - F.col("expected")) <= 0.02).alias("pass"))
