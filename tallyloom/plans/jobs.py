"""Data jobs: identities, attributions, seeds, fills and upserts over the base tables, each with SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import records as M
from ..operators import relational as R
from ..operators import search
from ..session import read, shared_folder
from ..sources import sinks, vendor
from ..streaming import runner

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# ---------------------------------------------------------------- parties, assignments, attributions


@query("""WITH h AS (SELECT DISTINCT lower(trim(p_brand)) AS handle FROM part WHERE p_size > 25), k AS (SELECT DISTINCT lower(trim(p_brand)) AS handle FROM part WHERE p_size < 3),
m AS (SELECT handle FROM h WHERE handle NOT IN (SELECT handle FROM k)) SELECT t AS into_table, handle, true AS has_id FROM m, (VALUES ('party'), ('handle'), ('role')) v(t)""")
def party_creation_referral(spark, d):
    """Handles that no party has get one: an id each, the same in every run, and a row in each of three tables."""
    p = read(spark, d, "part").withColumn("handle", F.lower(F.trim("p_brand")))
    missing = R.missing_from(p.where("p_size > 25").select("handle").distinct(), "handle", p.where("p_size < 3"), "handle")
    made = missing.withColumn("id", M.stable_uuid(F.col("handle"))).withColumn("into_table", F.explode(F.array(*map(F.lit, ("party", "handle", "role")))))
    return made.select("into_table", "handle", F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("has_id"))


@query("""SELECT c_nationkey AS company, max(c_name) FILTER (WHERE c_acctbal > 0) AS name, count(*) AS brands FROM customer GROUP BY c_nationkey HAVING bool_or(c_acctbal > 9000)""")
def party_creation_customer(spark, d):
    """One party for each canonical company of which a brand has a positive verdict."""
    c = read(spark, d, "customer")
    positive = c.where("c_acctbal > 9000").select("c_nationkey").distinct()
    by = c.join(positive, "c_nationkey", "left_semi").groupBy(F.col("c_nationkey").alias("company"))
    return by.agg(F.max(F.when(F.col("c_acctbal") > 0, F.col("c_name"))).alias("name"), F.count("*").alias("brands"))


@query("""SELECT c_custkey AS brand, (SELECT min(s_suppkey) FROM supplier WHERE s_acctbal > 5000) AS holder, 'support' AS role FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def assignment_seed(spark, d):
    """Each brand that nobody holds goes to one member of staff, who is found once."""
    staff = read(spark, d, "supplier").where("s_acctbal > 5000").agg(F.min("s_suppkey").alias("holder"))
    brands = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("brand"))
    brands = R.missing_from(brands, "brand", read(spark, d, "orders").where("o_orderstatus = 'P'"), "o_custkey")
    return brands.crossJoin(F.broadcast(staff)).withColumn("role", F.lit("support"))  # an aggregate without keys is one row


ALIASES = {"north": ["click", "clicks"], "south": ["view"], "west": ["purchase", "pur chase"]}


@query("""SELECT user_id AS brand, arg_max(event_type, value) AS tag, CASE arg_max(event_type, value) WHEN 'click' THEN 'north' WHEN 'view' THEN 'south' WHEN 'purchase' THEN 'west' END AS partner,
CASE WHEN arg_max(event_type, value) IN ('click', 'view', 'purchase') THEN NULL WHEN arg_max(event_type, value) = 'signup' THEN 'own house' ELSE 'unknown tag' END AS reason FROM events GROUP BY user_id""")
def referral_tags(spark, d):
    """The tag of a brand's greatest value, of ties the first event's; a tag or value that is null tells nothing."""
    first = F.struct("value", (-F.col("event_id")).alias("first"))
    rank = F.when(F.col("event_type").isNotNull() & F.col("value").isNotNull(), first)
    e = read(spark, d, "events").groupBy(F.col("user_id").alias("brand")).agg(F.max_by("event_type", rank).alias("tag"))
    partner, reason = M.referral(F.concat(F.lit(" "), F.upper("tag"), F.lit(".")), ALIASES, houses=["signup"])
    return e.select("brand", "tag", partner.alias("partner"), F.when(F.col("tag").isNull(), "unknown tag").otherwise(reason).alias("reason"))


@query("""WITH p AS (SELECT user_id AS brand, max(value) FILTER (WHERE event_type = 'click') AS click, max(value) FILTER (WHERE event_type = 'view') AS view, max(value) FILTER (WHERE event_type = 'purchase') AS purchase FROM events GROUP BY user_id)
SELECT brand, CASE WHEN coalesce(click, -1) >= coalesce(view, -1) AND coalesce(click, -1) >= coalesce(purchase, -1) AND click IS NOT NULL THEN 'north' WHEN coalesce(view, -1) >= coalesce(purchase, -1) AND view IS NOT NULL THEN 'south' WHEN purchase IS NOT NULL THEN 'west' END AS partner, click IS NOT NULL AND view IS NOT NULL AND purchase IS NOT NULL AS complete FROM p""")
def attribution_upsert(spark, d):
    """Observed fields as columns, then the partner of the strongest one by a small alias map."""
    kinds = ["click", "view", "purchase"]
    p = read(spark, d, "events").groupBy(F.col("user_id").alias("brand")).pivot("event_type", kinds).agg(F.max("value"))
    best = F.greatest(*[F.coalesce(F.col(k), F.lit(-1.0)) for k in kinds])
    partner = M.ladder([(F.col(k).isNotNull() & (F.col(k) == best), name) for k, name in zip(kinds, ALIASES)], "none")
    complete = F.col("click").isNotNull() & F.col("view").isNotNull() & F.col("purchase").isNotNull()
    return p.select("brand", F.nullif(partner, F.lit("none")).alias("partner"), complete.alias("complete"))


@query("""WITH f AS (SELECT o_custkey AS brand, max(CASE o_orderstatus WHEN 'F' THEN 'TRUE' WHEN 'O' THEN 'FALSE' ELSE 'NA' END) FILTER (WHERE o_orderpriority LIKE '1%') AS exclusive, max(o_orderpriority) FILTER (WHERE o_totalprice > 200000) AS tag FROM orders GROUP BY o_custkey)
SELECT brand, CASE exclusive WHEN 'TRUE' THEN 'exclusive' WHEN 'FALSE' THEN CASE WHEN tag LIKE '5%' THEN 'referral' ELSE 'open' END ELSE 'unknown' END AS deal_type FROM f""")
def deal_type_decision(spark, d):
    """TRUE, FALSE or NA of a brand, and a tag's alias, to the type of its deal."""
    o = read(spark, d, "orders")
    said = F.when(F.col("o_orderstatus") == "F", "TRUE").when(F.col("o_orderstatus") == "O", "FALSE").otherwise("NA")
    f = o.groupBy(F.col("o_custkey").alias("brand")).agg(
        F.max(F.when(F.col("o_orderpriority").startswith("1"), said)).alias("exclusive"), F.max(F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority"))).alias("tag")
    )
    alias = spark.createDataFrame([("5-LOW", "referral")], "tag string, by_tag string")
    f = f.join(alias, "tag", "left")
    kind = M.ladder([(F.col("exclusive") == "TRUE", "exclusive"), ((F.col("exclusive") == "FALSE") & F.col("by_tag").isNotNull(), "referral"), (F.col("exclusive") == "FALSE", "open")], "unknown")
    return f.select("brand", kind.alias("deal_type"))


@query("""WITH m AS (SELECT n_nationkey AS subject FROM nation), c AS (SELECT c_custkey AS brand, c_nationkey, c_custkey % 25 AS by_name FROM customer), n AS (SELECT o_custkey AS brand, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT subject, brand, by_id FROM (SELECT subject, c.brand, c_nationkey = subject AS by_id, row_number() OVER (PARTITION BY subject ORDER BY (c_nationkey = subject) DESC, coalesce(n, 0) DESC, c.brand) AS rn FROM m JOIN c ON c_nationkey = subject OR by_name = subject LEFT JOIN n ON n.brand = c.brand) WHERE rn = 1""")
def subject_resolver(spark, d):
    """Who is meant: a match of the id before one of the name, then the one with most lines.  Two equal-key joins, no OR."""
    subjects = read(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("subject"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("brand"), F.col("c_nationkey").cast("long").alias("nation"))
    by_id = subjects.join(c.withColumn("subject", F.col("nation")), "subject").withColumn("by_id", F.lit(True))
    by_name = subjects.join(c.withColumn("subject", F.col("brand") % 25), "subject").withColumn("by_id", F.lit(False))
    n = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("brand")).agg(F.count("*").alias("n"))
    met = by_id.unionByName(by_name).join(n, "brand", "left")
    rank = F.struct("by_id", F.coalesce("n", F.lit(0)).alias("n"), (-F.col("brand")).alias("b"))
    best = met.groupBy("subject").agg(F.max(rank).alias("r"))
    return best.select(F.col("subject").cast("int").alias("subject"), (-F.col("r.b")).alias("brand"), F.col("r.by_id").alias("by_id"))


# ---------------------------------------------------------------- recomputed, filled and pruned columns


@query("""SELECT o_custkey AS brand, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS voided, CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag <> 'R'), 0) AS DOUBLE) AS billed
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def voided_billed(spark, d):
    """A spine of brands and months with what was voided and billed in each; months without lines have 0."""
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM").cast("string")
    spine = read(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("brand"), month.alias("month"))
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    sums = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", amount)).alias("v"), F.sum(F.when(F.col("l_returnflag") != "R", amount)).alias("b"))
    out = spine.join(sums, F.col("l_orderkey") == F.col("o_orderkey"), "left").groupBy("brand", "month")
    return out.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(name) for c, name in (("v", "voided"), ("b", "billed"))])


@query("""WITH x AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS stated, (SELECT CAST(min(l_shipdate) AS DATE) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber < 3) AS was FROM orders WHERE o_orderstatus <> 'P') SELECT k, CAST(stated AS VARCHAR) AS stated, CAST(was AS VARCHAR) AS was FROM x WHERE stated IS DISTINCT FROM was""")
def stated_date_copy(spark, d):
    """Only dates that differ from what is there, null or not, are written."""
    was = read(spark, d, "lineitem").where("l_linenumber < 3").groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("was"))
    o = read(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("date").alias("stated"))
    both = o.join(was, F.col("k") == F.col("l_orderkey"), "left").where(~F.col("stated").eqNullSafe(F.col("was")))
    return both.select("k", F.col("stated").cast("string").alias("stated"), F.col("was").cast("string").alias("was"))


@query("""WITH x AS (SELECT o_orderkey AS k, month(o_orderdate) AS m, CAST(date_trunc('month', o_orderdate + INTERVAL 100 DAY) AS DATE) AS period FROM orders) SELECT k, CAST(make_date(CASE WHEN m > month(period) THEN year(period) - 1 ELSE year(period) END, m, 1) AS VARCHAR) AS month FROM x""")
def month_inference(spark, d):
    """A month without a year is the last one of that name up to the period's."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "MMMM").alias("label"), F.trunc(F.date_add(F.col("o_orderdate").cast("date"), 100), "MM").alias("period"))
    m = F.month(F.to_date(F.concat(F.col("label"), F.lit(" 2000")), "MMMM yyyy"))
    year = F.year("period") - (m > F.month("period")).cast("int")
    return o.select("k", F.make_date(year, m, F.lit(1)).cast("string").alias("month"))


@query("""WITH p AS (SELECT 'A' AS product, 0.05 AS std UNION ALL SELECT 'B', NULL) SELECT s_suppkey AS partner, p.product, CAST(CASE WHEN s_acctbal < 0 AND p.product = 'A' THEN 0.01 ELSE coalesce(p.std, 0.03) END AS DOUBLE) AS rate FROM supplier, p""")
def partner_economics(spark, d):
    """A partner's rate for a product: its own, else the product's, else the general one."""
    s = read(spark, d, "supplier")
    products = spark.createDataFrame([("A", 0.05), ("B", None)], "product string, std double")
    own = s.where("s_acctbal < 0").select(F.col("s_suppkey").alias("partner"), F.lit("A").alias("product"), F.lit(0.01).alias("own"))
    grid = s.select(F.col("s_suppkey").alias("partner"), F.explode(F.array(F.lit("A"), F.lit("B"))).alias("product"))
    return grid.join(products, "product", "left").join(own, ["partner", "product"], "left").select("partner", "product", F.coalesce("own", "std", F.lit(0.03)).alias("rate"))


@query("""SELECT o_custkey AS brand, CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) AS last_activity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_extendedprice * l_discount > 0 AND l_linestatus = 'F' GROUP BY o_custkey""")
def last_activity(spark, d):
    """The last day on which a brand paid a fee."""
    fees = read(spark, d, "lineitem").where("l_extendedprice * l_discount > 0 AND l_linestatus = 'F'").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("t"))
    out = read(spark, d, "orders").join(fees, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(F.col("o_custkey").alias("brand"))
    return out.agg(F.max("t").cast("date").cast("string").alias("last_activity"))


@query("""WITH f AS (SELECT l_orderkey AS k, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS fee FROM lineitem WHERE l_linenumber = 1 GROUP BY 1), c AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS fee FROM orders)
SELECT c.k, coalesce(f.fee, c.fee) AS fee, f.fee IS NOT NULL AND f.fee IS DISTINCT FROM c.fee AS changed FROM c LEFT JOIN f ON c.k = f.k""")
def charge_fee_fill(spark, d):
    """A charge's fee from the ledger where it has one; what is equal is not written again."""
    f = read(spark, d, "lineitem").where("l_linenumber = 1").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("new"))
    c = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("fee"))
    return c.join(f, "k", "left").select("k", F.coalesce("new", "fee").alias("fee"), (F.col("new").isNotNull() & ~F.col("new").eqNullSafe(F.col("fee"))).alias("changed"))


@query("""SELECT c_custkey AS brand, CASE WHEN NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'open' WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 'sharpened' ELSE 'closed' END AS state,
CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN (SELECT count(*) || ' pending, first ' || min(o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') END AS question FROM customer""")
def gap_close(spark, d):
    """Questions whose answer has come are closed; those that are half answered say what is left."""
    o = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("brand")).agg(F.count_if(F.col("o_orderstatus") == "P").alias("n"), F.min(F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey"))).alias("first"))
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("brand")).join(o, "brand", "left")
    text = F.concat(F.col("n").cast("string"), F.lit(" pending, first "), F.col("first").cast("string"))
    return c.select("brand", M.ladder([(F.col("n").isNull(), "open"), (F.col("n") > 0, "sharpened")], "closed").alias("state"), F.when(F.col("n") > 0, text).alias("question"))


@query("""WITH x AS (SELECT user_id AS brand, min(ts) FILTER (WHERE event_type = 'purchase') AS productive, max(ts) FILTER (WHERE event_type = 'signup') AS reactivated, max(value) FILTER (WHERE event_type = 'signup') AS v FROM events GROUP BY user_id)
SELECT brand, epoch_us(CASE WHEN v > 100 THEN greatest(productive, reactivated) ELSE productive END) AS anchor, coalesce(v > 100 AND reactivated > productive, false) AS reset FROM x""")
def anchor_reset(spark, d):
    """The anchor is the first productive moment; a reactivation that qualifies moves it on, one that does not leaves it."""
    kind = lambda k, c: F.when(F.col("event_type") == k, F.col(c))
    x = read(spark, d, "events").groupBy(F.col("user_id").alias("brand")).agg(F.min(kind("purchase", "ts")).alias("productive"), F.max(kind("signup", "ts")).alias("back"), F.max(kind("signup", "value")).alias("v"))
    ok = F.coalesce(F.col("v") > 100, F.lit(False))
    anchor = F.when(ok, F.greatest("productive", "back")).otherwise(F.col("productive"))
    return x.select("brand", F.unix_micros(anchor).alias("anchor"), F.coalesce(ok & (F.col("back") > F.col("productive")), F.lit(False)).alias("reset"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY")
def retention(spark, d):
    return sinks.retained(read(spark, d, "events"), "ts", F.lit("2024-01-31 00:00:00").cast("timestamp"), 10).select("event_id")


@query("""WITH c AS (SELECT p_name AS name, min(p_type) AS kind, bool_or(p_size > 45) AS is_custom FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_name), s AS (SELECT p_name AS name, max(p_type) AS kind, bool_or(p_size = 1) AS is_custom FROM part WHERE p_partkey % 4 <> 0 GROUP BY p_name)
SELECT coalesce(s.name, c.name) AS name, coalesce(s.kind, c.kind) AS kind, coalesce(c.is_custom, false) OR coalesce(s.is_custom, false) AS is_custom FROM c FULL JOIN s ON c.name = s.name""")
def registry_upsert(spark, d):
    p = read(spark, d, "part").withColumnRenamed("p_name", "name")
    was = p.where("p_partkey % 3 <> 0").groupBy("name").agg(F.min("p_type").alias("kind"), F.bool_or(F.col("p_size") > 45).alias("is_custom"))
    seen = p.where("p_partkey % 4 <> 0").groupBy("name").agg(F.max("p_type").alias("kind"), F.bool_or(F.col("p_size") == 1).alias("is_custom"))
    return sinks.upsert_registry(was, seen, ["name"])


# ---------------------------------------------------------------- expressions


@query("SELECT c_custkey AS k FROM customer WHERE c_mktsegment ILIKE '%uild%' OR c_name ILIKE 'CUSTOMER#%7'")
def ilike_search(spark, d):
    return read(spark, d, "customer").where(F.col("c_mktsegment").ilike("%uild%") | F.col("c_name").ilike("CUSTOMER#%7")).select(F.col("c_custkey").alias("k"))


@query("SELECT c_custkey AS k, count(*) AS n FROM customer JOIN documents ON CAST(c_custkey AS VARCHAR) = CAST(doc_id AS VARCHAR) GROUP BY c_custkey")
def cast_key_join(spark, d):
    """Keys of two kinds meet as text, cast on both sides before the shuffle."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_custkey").cast("string").alias("key"))
    return c.join(read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("key")), "key").groupBy("k").agg(F.count("*").alias("n"))


@query("SELECT doc_id, regexp_matches(text, '[\\x{C0}-\\x{24F}]') AS marked, regexp_matches(text, '[\\x{4E00}-\\x{9FFF}\\x{3040}-\\x{30FF}]') AS east FROM documents")
def scripts(spark, d):
    return read(spark, d, "documents").select("doc_id", M.known_script(F.col("text"), M.MARKED_LATIN).alias("marked"), M.known_script(F.col("text"), M.CJK, M.KANA).alias("east"))


@query("SELECT user_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_wins(spark, d):
    """Of rows that share a key the first stays: one aggregation, no sort."""
    return read(spark, d, "events").groupBy("user_id").agg(F.min_by("event_type", "event_id").alias("event_type"))


@query("SELECT event_id, epoch_ms(ts) AS from_seconds, epoch_ms(ts) AS from_millis, epoch_ms(ts) AS from_text, CAST(NULL AS BIGINT) AS from_noise FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)")
def epoch_parse(spark, d):
    e = read(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts"))
    ways = {
        "from_seconds": F.unix_seconds("ts").cast("string"), "from_millis": F.unix_millis("ts").cast("string"),
        "from_text": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "from_noise": F.lit("soon"),
    }
    return e.select("event_id", *[F.unix_millis(M.epoch_time(c)).alias(name) for name, c in ways.items()])


@query("""SELECT s_suppkey AS k, CAST(CAST(('0x' || substr(sha256(s_name), 1, 16))::UBIGINT AS HUGEINT) - CASE WHEN substr(sha256(s_name), 1, 1) >= '8' THEN 18446744073709551616::HUGEINT ELSE 0::HUGEINT END AS BIGINT) AS lock_key FROM supplier""")
def lock_keys(spark, d):
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), M.signed_key(F.col("s_name")).alias("lock_key"))


@query("""SELECT CASE WHEN value > 100 THEN 'k,more,shop' ELSE 'k,more' END AS names, count(*) AS n FROM events GROUP BY 1""")
def overflow_keys(spark, d):
    more = F.to_json(F.struct(F.lit(1).alias("more"), F.when(F.col("value") > 100, F.lit("x")).alias("shop")))
    e = read(spark, d, "events").withColumn("j", F.concat(F.expr("left(props, length(props) - 1)"), F.lit(","), F.substring(more, 2, 1000)))
    return e.groupBy(F.array_join(M.member_names(F.col("j")), ",").alias("names")).agg(F.count("*").alias("n"))


def _records(spark, d):
    """Events as a vendor's JSON records: typed members, one of another type in some, and members of its own."""
    e = read(spark, d, "events")
    amount = F.when(F.col("event_id") % 7 == 0, F.lit('"n/a"')).otherwise(F.floor("value").cast("string"))
    record = F.concat(F.lit('{"name":"'), F.col("event_type"), F.lit('","amount":'), amount, F.lit(',"tags":["a","b"],"custom":{"u":'), F.col("user_id").cast("string"), F.lit("}}"))
    return e.select("event_id", "user_id", "ts", record.alias("record"))


@query("""SELECT event_id, event_type AS name, CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value) AS BIGINT) END AS amount, '{' || CASE WHEN event_id % 7 = 0 THEN '"amount":"n/a",' ELSE '' END || '"custom":{"u":' || user_id || '},"tags":["a","b"]}' AS overflow FROM events""")
def mapper_split(spark, d):
    return M.split_record(_records(spark, d), "record", {"name": "string", "amount": "bigint"}, keep=["event_id"])


@query("""SELECT event_id, kind, n FROM (SELECT event_id, event_type AS kind, 1 AS n FROM events WHERE value > 20 UNION ALL SELECT event_id, 'user', user_id FROM events WHERE value > 20 AND user_id % 2 = 0)""")
def mapper_rows(spark, d):
    """A record gives none, one or two rows: an array of rows, exploded, in place of a function called row by row."""
    e = read(spark, d, "events")
    one, two = F.struct(F.col("event_type").alias("kind"), F.lit(1).cast("long").alias("n")), F.struct(F.lit("user").alias("kind"), F.col("user_id").alias("n"))
    rows = F.array_compact(F.array(F.when(F.col("value") > 20, one), F.when((F.col("value") > 20) & (F.col("user_id") % 2 == 0), two)))
    return e.select("event_id", F.explode(rows).alias("r")).select("event_id", "r.*")


@query("""SELECT conv_id * 100 + turn AS source_id, 0 AS part, length(text) AS size FROM conversations WHERE length(trim(text)) > 0 UNION ALL SELECT conv_id * 100 + turn, 1, length(role) FROM conversations WHERE turn = 0""")
def text_emission(spark, d):
    """Records give texts for the knowledge index, each with its metadata."""
    c = read(spark, d, "conversations")
    meta = F.struct(F.lit("t").alias("tenant_id"), (F.col("conv_id") * 100 + F.col("turn")).alias("source_id"), F.lit("message").alias("kind"), F.col("role").alias("title"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"))
    text = lambda part, x: F.struct(F.lit(part).alias("part"), x.alias("text"))
    texts = F.array_compact(F.array(text(0, F.col("text")), F.when(F.col("turn") == 0, text(1, F.col("role")))))
    return runner.knowledge_texts(c, texts, meta).select("metadata.source_id", "part", F.length("text").alias("size"))


@F.pandas_udf(DoubleType())
def _spread(v: pd.Series) -> float:
    """The median distance from the median: what no built-in aggregate gives."""
    return float((v - v.median()).abs().median())


@query("SELECT event_type, round(mad(value), 6) AS spread FROM events GROUP BY event_type")
def user_aggregate(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.round(_spread("value"), 6).alias("spread"))


@query("""SELECT c_custkey AS k, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'industry' WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN lower(c_mktsegment) END AS segment, c_mktsegment NOT IN ('MACHINERY', 'BUILDING', 'FURNITURE') AS rejected FROM customer""")
def enum_coercion(spark, d):
    value, rejected = M.coerce(F.concat(F.lit("  "), F.initcap("c_mktsegment")), ["industry", "building", "furniture"], {"machinery": "industry"})
    return read(spark, d, "customer").select(F.col("c_custkey").alias("k"), value.alias("segment"), rejected.alias("rejected"))


@query("""SELECT s_suppkey AS k, CASE WHEN s_suppkey % 11 = 0 THEN 'forwarder' WHEN s_nationkey = 7 THEN 'home' WHEN s_suppkey % 3 <> 0 THEN 'abroad' WHEN s_suppkey % 2 = 0 THEN 'home' ELSE 'unknown' END AS place FROM supplier""")
def location_class(spark, d):
    s = read(spark, d, "supplier")
    address = F.when(F.col("s_suppkey") % 11 == 0, F.lit("c/o Mail Drop 4")).when(F.col("s_nationkey") == 7, F.lit("Home town")).when(F.col("s_suppkey") % 3 != 0, F.lit("Elsewhere 1")).otherwise(F.lit(" "))
    phone = F.when(F.col("s_suppkey") % 2 == 0, F.lit("+(99) 123")).otherwise(F.lit("+1 555"))
    return s.select(F.col("s_suppkey").alias("k"), M.seller_location(address, phone, r"\bhome\b", "+99", r"mail ?drop").alias("place"))


@query("""SELECT doc_id, CASE WHEN l.quality IS NULL THEN 'open' WHEN source IS NULL OR trim(source) = '' THEN 'unsourced' WHEN l.toxic = 1 THEN 'borderline' ELSE 'confirmed' END AS outcome FROM documents d LEFT JOIN labels l USING (doc_id)""")
def finding_class(spark, d):
    x = read(spark, d, "documents").select("doc_id", "source").join(read(spark, d, "labels"), "doc_id", "left")
    note = F.when(F.col("toxic") == 1, F.lit("Perhaps, but UNCLEAR")).otherwise(F.lit("sure"))
    return x.select("doc_id", M.finding_outcome(F.col("quality"), F.col("source"), note, "unclear|maybe").alias("outcome"))


# ---------------------------------------------------------------- sources, sinks and runs


def _pages(kind: str, after: str | None) -> dict:
    """A vendor with seven pages of three records of each kind, as a transport: pages begin where the cursor says."""
    at = int(after or 0)
    rows = [{"id": f"{kind}-{i}", "updated_at": f"2024-01-{1 + i:02d}T00:00:00Z", "name": f"{kind} {i}", "amount": 100 * i, "created": 1704067200 + 86400 * i} for i in range(at, at + 3)]
    return {"results": rows} | ({"after": str(at + 3)} if at < 18 else {})


@query("SELECT kind AS object, 21 AS n, 'created,amount,id,name,updated_at' AS properties, kind || '-0' AS first FROM (VALUES ('charge'), ('price')) v(kind)".replace("created,amount", "amount,created"))
def object_pages(spark, d):
    """All pages of each object, one partition an object, and the properties that are found in them."""
    spark.dataSource.register(vendor.object_source("tallyloom_objects", _pages, ("charge", "price")))
    rows = spark.read.format("tallyloom_objects").load()
    properties = vendor.discovered(rows).groupBy("object").agg(F.array_join(F.array_sort(F.collect_set("property")), ",").alias("properties"))
    return rows.groupBy("object").agg(F.count("*").cast("int").alias("n"), F.min("id").alias("first")).join(properties, "object")


@query("SELECT 'charge-' || i AS id, CAST(i AS DOUBLE) AS amount, CAST(1704067200 + 86400 * i AS BIGINT) AS created FROM generate_series(0, 20) t(i)")
def object_stream(spark, d):
    """The same objects as a stream whose offsets are the vendor's cursors, then shaped."""
    spark.dataSource.register(vendor.object_source("tallyloom_objects", _pages, ("charge", "price")))
    from ..streaming.ingest import finish

    rows = finish(spark.readStream.format("tallyloom_objects").option("object", "charge").load(), shared_folder(spark, "objects"), "append")
    return vendor.shaped(rows, "charge").select("id", F.col("amount").cast("double").alias("amount"), F.unix_seconds("created").alias("created"))


@query("""WITH l AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS s FROM lineitem) SELECT o_orderkey AS id, coalesce(string_agg(CAST(s AS VARCHAR), ',' ORDER BY s), '') AS partners FROM orders LEFT JOIN l ON k = o_orderkey GROUP BY o_orderkey""")
def association_fan_in(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"))
    out = vendor.with_associations(o, "id", read(spark, d, "lineitem"), "l_orderkey", "l_suppkey", "partners")
    return out.select("id", F.array_join("partners", ",").alias("partners"))


@query("SELECT conv_id AS parent_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS position, role, length(text) AS size FROM conversations")
def comments(spark, d):
    """Messages nested in their conversation, as rows that carry its id."""
    item = F.struct("turn", "role", "text")
    parents = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("messages"))
    return vendor.sub_resources(parents, "conv_id", "messages").select("parent_id", "position", "role", F.length("text").alias("size"))


@query("SELECT l_orderkey AS invoice, l_linenumber AS line, l_suppkey AS partner FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey, l_quantity, l_extendedprice, l_shipdate) AS rn FROM lineitem) WHERE rn = 1")
def nested_lines(spark, d):
    """Headers embed lines up to the second; the further ones come from pages that hold all of them."""
    order = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    all_lines = read(spark, d, "lineitem").withColumn("rn", F.row_number().over(order)).where("rn = 1")
    all_lines = all_lines.select(F.col("l_orderkey").alias("invoice"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("partner"))
    headers = all_lines.where("line <= 2").groupBy("invoice").agg(F.collect_list(F.struct("line", "partner")).alias("lines"))
    return vendor.complete_lines(headers, "invoice", "lines", all_lines, "line")


@query("""SELECT c_custkey AS k, c_name AS name, 'a' AS source_tenant, 'building' AS source_lens, 'b' AS tenant_id FROM customer WHERE c_mktsegment = 'BUILDING'""")
def view_mirror(spark, d):
    view = read(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"))
    out = vendor.mirrored(view, "building", "a", "b")
    return out.dropDuplicates(["mirror_id"]).drop("mirror_id")


@query("""SELECT 'a' AS batch, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'b', count(*) FROM orders WHERE o_orderstatus = 'P'""")
def append_only(spark, d):
    """Two appends, one of them twice; a repeated one adds nothing."""
    table = sinks.AppendOnly(spark, shared_folder(spark, "log"), "batch string, k long")
    o = read(spark, d, "orders")
    for name, status in (("a", "F"), ("b", "P"), ("a", "F")):
        table.append(o.where(F.col("o_orderstatus") == status).select(F.lit(name).alias("batch"), F.col("o_orderkey").alias("k")), name)
    return table.read().groupBy("batch").agg(F.count("*").alias("n"))


@query("""SELECT 'partial' AS status, (SELECT count(*) FROM events WHERE event_type <> 'error' AND value > 10) AS seen, (SELECT count(*) FROM events WHERE event_type <> 'error' AND NOT value > 10) AS rejected, 1 AS failed_batches""")
def sync_run(spark, d):
    """A sync of a batch an event type, of which one fails; rows that fail a check go aside; the run table tells."""
    e = read(spark, d, "events")
    table = runner.RunTable(spark, shared_folder(spark, "sync"))

    def put(batch: DataFrame, k: int) -> dict[str, int]:
        if batch.where("event_type = 'error'").take(1):
            raise ValueError("a batch that cannot be read")
        return {"seen": batch.count()}

    kinds = ["click", "error", "view", "purchase", "signup"]
    runner.run(table, "t", "desk", (e.where(F.col("event_type") == k) for k in kinds), put, checks={"value": F.col("value") > 10})
    return table.read().select("status", "seen", "rejected", F.col("failed_batches").cast("int").alias("failed_batches"))


@query("""WITH s AS (SELECT user_id, ts, min(event_id) AS e FROM events GROUP BY user_id, ts) SELECT CASE WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) THEN 'append' ELSE 'missing' END AS part, count(*) AS n FROM s WHERE NOT EXISTS (SELECT 1 FROM events h WHERE h.user_id = s.user_id AND h.ts = s.ts AND h.event_type = 'click') GROUP BY 1""")
def backfill(spark, d):
    """Revisions that the history lacks, and those of records that are not there."""
    e = read(spark, d, "events")
    current = read(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"))
    append, missing = runner.backfill(e.select("user_id", "ts", "event_id"), current, e.where("event_type = 'click'"), ["user_id"], "ts")
    both = append.select(F.lit("append").alias("part")).unionByName(missing.select(F.lit("missing").alias("part")))
    return both.groupBy("part").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- retrieval


@query("""SELECT 'vec__acme-co__' || CASE WHEN c_custkey % 3 = 0 THEN '_tenant' ELSE lower(c_mktsegment) END AS namespace, count(*) AS n FROM customer GROUP BY 1""")
def namespaces(spark, d):
    client = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return read(spark, d, "customer").groupBy(sinks.namespace(F.lit("Acme Co"), client).alias("namespace")).agg(F.count("*").alias("n"))


def _probe(spark, d):
    v = read(spark, d, "embeddings")
    v = v.withColumn("tenant_id", F.when(F.col("vec_id") % 2 == 0, "a").otherwise("b")).withColumn("client_id", F.concat(F.lit("c"), (F.col("vec_id") % 3).cast("string")))
    return v, [float(x) for x in v.where("vec_id = 0").first()["embedding"]]


_NEAR = """n AS (SELECT vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS score FROM embeddings WHERE vec_id % 2 = 0 AND vec_id % 3 = 0)"""


@query(f"WITH {_NEAR}, p AS (SELECT * FROM n ORDER BY score DESC, vec_id LIMIT 20) SELECT vec_id, label, 'table' AS source FROM p ORDER BY label DESC NULLS LAST, vec_id LIMIT 5")
def rerank(spark, d):
    """A tenant's and client's vectors: the nearest 20, ordered anew by another score, of which five stay."""
    v, probe = _probe(spark, d)
    out = search.retrieve(v, probe, "a", "c0", 5, prefetch=4, rerank=F.col("label").cast("double"))
    return out.select("vec_id", "label", "source")


@query(f"WITH {_NEAR} (SELECT vec_id, 'broken store' AS asked, 'table' AS source FROM n ORDER BY score DESC, vec_id LIMIT 5) UNION ALL (SELECT vec_id, 'store', 'store' FROM n WHERE vec_id IN (0, 6, 12) ORDER BY score DESC, vec_id LIMIT 5)")
def store_first(spark, d):
    """The outer store is asked first; when it fails, the table answers.  Of what it names, other tenants' rows (3) do not come."""
    v, probe = _probe(spark, d)

    def broken(*_):
        raise ConnectionError("no store")

    ways = {"broken store": broken, "store": lambda *_: [(0, 1.0), (3, 0.9), (6, 0.5), (12, 0.4)]}
    parts = [search.retrieve(v, probe, "a", "c0", 5, store=f).select("vec_id", F.lit(name).alias("asked"), "source") for name, f in ways.items()]
    return parts[0].unionByName(parts[1])
