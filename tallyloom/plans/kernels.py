"""Queries of constructs, text kernels, keyed sinks and feeds, each with SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import text as T
from ..operators import relational as R
from ..operators import search
from ..session import read, shared_folder
from ..sources import files, vendor
from ..sources.contract import CorpusSource
from ..streaming import ingest
from .filters import Tenant

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


# ---------------------------------------------------------------- constructs


@query("SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'")
def between_times(spark, d):
    lo, hi = (F.lit(t).cast("timestamp") for t in ("2024-01-10 00:00:00", "2024-01-12 12:00:00"))
    return read(spark, d, "events").where(F.col("ts").between(lo, hi)).select("event_id")


@query("SELECT s_suppkey AS k FROM supplier WHERE regexp_matches(s_name, '[13579]$') AND NOT regexp_matches(s_name, '#0+[0-9]?5')")
def match_and_not(spark, d):
    return read(spark, d, "supplier").where(F.col("s_name").rlike("[13579]$") & ~F.col("s_name").rlike("#0+[0-9]?5")).select(F.col("s_suppkey").alias("k"))


_RANKS = ("low", "medium", "high")


@query("""SELECT o_custkey AS brand, ['high', 'medium', 'low'][min(CASE WHEN o_totalprice > 300000 THEN 1 WHEN o_totalprice > 100000 THEN 2 ELSE 3 END)] AS best, len(list(DISTINCT o_orderstatus)) AS states, list_contains(list(o_orderstatus), 'P') AS pending FROM orders GROUP BY o_custkey""")
def ordinal_by_array(spark, d):
    """The least of ranks, read back from an array of names; an array's size; a value among an array's."""
    rank = F.when(F.col("o_totalprice") > 300000, 1).when(F.col("o_totalprice") > 100000, 2).otherwise(3)
    g = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("brand")).agg(F.min(rank).alias("r"), F.collect_set("o_orderstatus").alias("states"))
    names = F.array(*[F.lit(x) for x in reversed(_RANKS)])
    return g.select("brand", F.element_at(names, F.col("r")).alias("best"), F.size("states").cast("long").alias("states"), F.array_contains("states", "P").alias("pending"))


@query("""SELECT c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END DESC NULLS LAST, c_custkey) AS last_place, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_acctbal > 0 THEN c_acctbal END ASC NULLS FIRST, c_custkey) AS first_place FROM customer""")
def nulls_first_and_last(spark, d):
    from pyspark.sql import Window

    c = read(spark, d, "customer").withColumn("v", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")))
    by = Window.partitionBy("c_nationkey")
    return c.select(F.col("c_custkey").alias("k"), F.row_number().over(by.orderBy(F.col("v").desc_nulls_last(), "c_custkey")).alias("last_place"), F.row_number().over(by.orderBy(F.col("v").asc_nulls_first(), "c_custkey")).alias("first_place"))


@query("SELECT c_custkey AS k FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P' WHERE o_orderkey IS NULL")
def left_join_null_test(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'P'")
    return read(spark, d, "customer").join(o, F.col("o_custkey") == F.col("c_custkey"), "left").where("o_orderkey IS NULL").select(F.col("c_custkey").alias("k"))


@query("""WITH m AS (SELECT c_custkey AS l, s_suppkey AS r, c_custkey % 10 = 0 AS role FROM customer JOIN supplier ON lower(trim(split_part(c_name, '#', 2))) = lower(trim(split_part(s_name, '#', 2))) WHERE c_mktsegment <> 'BUILDING')
SELECT l, r, CASE WHEN count(*) OVER (PARTITION BY l) > 1 THEN 0.5 WHEN role THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence FROM m""")
def linkage(spark, d):
    """Customers and suppliers by the normal form of a name's number."""
    key = lambda c: T.normal_email(F.split_part(F.col(c), F.lit("#"), F.lit(2)))
    left = read(spark, d, "customer").select(F.col("c_custkey").alias("l"), key("c_name").alias("key"), "c_mktsegment")
    right = read(spark, d, "supplier").select(F.col("s_suppkey").alias("r"), key("s_name").alias("key"))
    return R.link(left, right, "l", "r", "key", F.col("l") % 10 == 0, F.col("c_mktsegment") == "BUILDING")


# ---------------------------------------------------------------- text and money


@query("""SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 3 <> 0 THEN 'x' || c_custkey || '@y.z' END AS mail, 'see ' || c_mktsegment || ' now' AS plain FROM customer""")
def message_fields(spark, d):
    """A chat message's labelled fields; an empty one is null; links and emoji go."""
    mail = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(" <mailto:x"), F.col("c_custkey"), F.lit("@y.z|x"), F.col("c_custkey"), F.lit("@y.z>"))).otherwise(F.lit(""))
    text = F.concat(F.lit("*Name*: "), F.col("c_name"), F.lit("\n*Mail*:"), mail, F.lit("\n*Segment*: see <https://a.b/c|"), F.col("c_mktsegment"), F.lit("> now :tada:"))
    c = read(spark, d, "customer").withColumn("text", text)
    field = lambda label: T.labelled_field(F.col("text"), label)
    return c.select(F.col("c_custkey").alias("k"), field("Name").alias("name"), T.unwrap_links(field("Mail")).alias("mail"), T.unwrap_links(field("Segment")).alias("plain"))


@query("""SELECT doc_id, trim(regexp_replace(substr(text, greatest(1, instr(lower(text), 'license') - 20), 47), '\\s+', ' ', 'g')) AS hit FROM documents WHERE instr(lower(text), 'license') > 0""")
def snippets(spark, d):
    return read(spark, d, "documents").select("doc_id", T.snippet(F.col("text"), "license", 20).alias("hit")).where("hit IS NOT NULL")


@query("""SELECT p_partkey AS k, p_size AS days, CAST(p_retailprice AS DOUBLE) AS price, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', 2) AS rest, CAST(round(p_size / 100.0, 2) AS DOUBLE) AS dollars, CAST(make_date(2024, 1 + p_size % 12, 1 + p_size % 28) AS VARCHAR) AS day FROM part""")
def parsers(spark, d):
    """Terms, money, names, cents and dates out of the texts that people write."""
    p = read(spark, d, "part")
    price = F.concat(F.lit(" $"), F.format_number("p_retailprice", 2))
    day = F.make_date(F.lit(2024), 1 + F.col("p_size") % 12, 1 + F.col("p_size") % 28)
    written = F.when(F.col("p_partkey") % 2 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MMM d, yyyy"))
    first, rest = T.split_name(F.concat(F.lit("  "), F.regexp_replace("p_name", " ", "   ")))
    return p.select(
        F.col("p_partkey").alias("k"), T.payment_terms(F.concat(F.lit("Net "), F.col("p_size"), F.lit(" days"))).alias("days"), T.parse_money(price).cast("double").alias("price"),
        first.alias("first"), rest.alias("rest"), M.cents(F.col("p_size")).cast("double").alias("dollars"), T.parse_date(written, "yyyy-MM-dd", "dd/MM/yyyy", "MMM d, yyyy").cast("string").alias("day"),
    )


# ---------------------------------------------------------------- feeds


_NOW = "TIMESTAMP '2024-01-31 00:00:00'"


@query(f"""WITH f AS (SELECT user_id, ts, event_id FROM events WHERE ts >= {_NOW} - INTERVAL 72 HOUR AND event_type <> 'view')
SELECT user_id, epoch_us(max(ts)) AS at, count(*) AS n, c_custkey IS NULL AS deleted FROM f LEFT JOIN customer ON c_custkey = user_id AND c_custkey % 4 <> 0 GROUP BY user_id, c_custkey""")
def changes(spark, d):
    """A change feed read again over its last 72 hours, less the events that were processed, with the objects as they are now."""
    e = read(spark, d, "events")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    changed = vendor.change_feed(e, "user_id", "ts", "event_id", e.where("event_type = 'view'"), now, 72)
    c = read(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("user_id"), "c_name")
    return vendor.hydrated(changed, c, "user_id").select("user_id", F.unix_micros("ts").alias("at"), F.size("events").cast("long").alias("n"), "deleted")


@query("SELECT event_id FROM events WHERE date_trunc('day', ts) > TIMESTAMP '2024-01-15 00:00:00' OR (date_trunc('day', ts) = TIMESTAMP '2024-01-15 00:00:00' AND event_id > (SELECT median(event_id) FROM events))")
def high_water_mark(spark, d):
    """Records past (created, id), with many of one instant."""
    e = read(spark, d, "events").withColumn("created", F.date_trunc("day", "ts"))
    last = e.agg(F.median("event_id")).first()[0]
    return vendor.after_mark(e, "created", "event_id", (F.lit("2024-01-15 00:00:00").cast("timestamp"), last)).select("event_id")


@query("SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 300 SECOND")
def rewound_cursor(spark, d):
    """From the cursor less its safety window on, so that late records are seen again."""
    e = read(spark, d, "events")
    cursor = e.where("event_type = 'purchase'").agg(F.max("ts").alias("t")).select(ingest.rewound(F.col("t")).alias("since")).scalar()
    return e.where(F.col("ts") > cursor).select("event_id")


@query("SELECT user_id, event_type AS property, value, epoch_us(ts) AS at FROM events")
def property_history(spark, d):
    """Records that group the versions of each property, as rows."""
    e = read(spark, d, "events")
    versions = e.groupBy("user_id", "event_type").agg(F.collect_list(F.struct("value", F.col("ts").alias("at"))).alias("v"))
    grouped = versions.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("history"))
    return vendor.revisions(grouped, "user_id", "history").withColumn("at", F.unix_micros("at"))


@query("SELECT 'contacts' AS kind, 200 - 100 AS n")
def corpus_since(spark, d):
    """The corpus source from a cursor on: contacts are an hour apart, from the thousandth hour of the year on."""
    spark.dataSource.register(CorpusSource)
    rows = spark.read.format("tallyloom_corpus").option("since", "2026-02-15T19:00:00+00:00").load().where("kind = 'contacts'")
    return rows.groupBy("kind").agg(F.count("*").cast("int").alias("n"))


# ---------------------------------------------------------------- keyed sinks


def _two(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"), F.lit(1).cast("long").alias("at"))
    new = c.where("id % 3 = 0").select("id", F.upper("name").alias("name"), (F.col("amount") + 1).alias("amount"), F.lit(2).cast("long").alias("at"))
    again = new.withColumn("name", F.lit("stale")).withColumn("at", F.lit(1).cast("long"))
    return c.where("id % 2 = 0"), new.unionByName(again)


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS amount, CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS at FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_all(spark, d):
    now, new = _two(spark, d)
    return files.upsert(now, new, ["id"], "at")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name, CASE WHEN c_custkey % 2 <> 0 THEN c_acctbal + 1 ELSE c_acctbal END AS amount, CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS at FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_columns(spark, d):
    """On a conflict only the name and the time are overwritten."""
    now, new = _two(spark, d)
    return files.upsert(now, new, ["id"], "at", ["name", "at"])


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 <> 0")
def insert_ignored(spark, d):
    now, new = _two(spark, d)
    return files.insert_ignore(now, new, ["id"]).select("id")


@query("SELECT c_custkey AS id, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_name END, (SELECT max(o_orderpriority) FROM orders WHERE o_custkey = c_custkey)) AS name FROM customer")
def filled(spark, d):
    """Missing names from another relation; those that are there stay."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"))
    return files.fill_missing(c, read(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderpriority").alias("name")), "id", "name")


@query("SELECT o_orderstatus AS part, count(*) AS n, CASE WHEN o_orderstatus = 'P' THEN 'new' ELSE 'old' END AS kind FROM orders GROUP BY o_orderstatus")
def replaced_partitions(spark, d):
    """A regenerated partition replaces its old rows, the others stay."""
    path = shared_folder(spark, "parts")
    o = read(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("part"))
    files.write_partitions(o.withColumn("kind", F.lit("old")), path, "part")
    files.write_partitions(o.where("part = 'P'").withColumn("kind", F.lit("new")), path, "part")
    return spark.read.parquet(path).groupBy(F.col("part").cast("string").alias("part"), "kind").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN doc_id % 3 = 0 THEN 'changed' ELSE 'new' END AS kind, count(*) AS n FROM documents WHERE (doc_id % 3 = 0 OR doc_id % 5 = 0) AND length(trim(text)) > 0 AND length(text) < 2000 GROUP BY 1")
def index_build(spark, d):
    """Only texts that the index does not hold as they are get new chunks."""
    t = read(spark, d, "documents").where("length(text) < 2000").select(F.col("doc_id").alias("source_id"), F.trim("text").alias("text"))
    known = search.index_texts(t.where("source_id % 5 <> 0"))
    now = t.withColumn("text", F.when(F.col("source_id") % 3 == 0, F.concat(F.col("text"), F.lit("."))).otherwise(F.col("text"))).where("length(text) > 1 OR text <> '.'")
    fresh = search.index_texts(now, known)
    return fresh.groupBy(F.when(F.col("source_id") % 3 == 0, "changed").otherwise("new").alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT 'a' AS tenant, count(*) AS n FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'unset', 0")
def tenant_policy(spark, d):
    """A tenant reads its own rows; an unset one none."""
    c = read(spark, d, "customer").withColumn("tenant_id", F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b"))
    mine, none = Tenant("a").read(c), Tenant(None).read(c)
    return mine.agg(F.lit("a").alias("tenant"), F.count("*").alias("n")).unionByName(none.agg(F.lit("unset").alias("tenant"), F.count("*").alias("n")))
