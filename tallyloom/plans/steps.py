"""Queries that apply the operators of this package to the base tables, each with SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money as M
from ..functions import text as T
from ..operators import relational as R
from ..operators import scd, search
from ..session import read, shared_folder
from ..streaming import ingest as S
from .filters import Lens, Tenant

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query("""SELECT o_custkey AS brand, o_orderkey AS invoice, CAST(o_totalprice AS DOUBLE) AS total FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def latest_row(spark, d):
    o = R.distinct_on(read(spark, d, "orders"), ["o_custkey"], F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    return o.select(F.col("o_custkey").alias("brand"), F.col("o_orderkey").alias("invoice"), F.col("o_totalprice").alias("total"))


@query("SELECT o_custkey AS brand, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey")
def latest_version(spark, d):
    o = read(spark, d, "orders").select(F.col("o_custkey").alias("brand"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("status"))
    return R.latest_by(o, ["brand"], "version")


@query("""SELECT s_nationkey AS nation, s_suppkey AS contact FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY (s_acctbal > 0) DESC, s_suppkey % 3, s_suppkey) AS rn FROM supplier) WHERE rn = 1""")
def best_row(spark, d):
    s = R.distinct_on(read(spark, d, "supplier"), ["s_nationkey"], (F.col("s_acctbal") > 0).desc(), (F.col("s_suppkey") % 3).asc(), F.col("s_suppkey").asc())
    return s.select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("contact"))


@query("""WITH r AS (SELECT user_id, ts AS since, value AS rate, event_id AS rate_id FROM events WHERE event_type = 'signup'), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT p.event_id, p.user_id, r.rate, r.rate_id FROM p ASOF LEFT JOIN r ON p.user_id = r.user_id AND p.ts >= r.since""")
def asof_rate(spark, d):
    e = read(spark, d, "events")
    rates = e.where("event_type = 'signup'").select("user_id", F.col("ts").alias("since"), F.col("value").alias("rate"), F.col("event_id").alias("rate_id"))
    return R.as_of_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), rates, ["user_id"], "ts", "since", ["rate", "rate_id"]).drop("ts")


@query("""WITH w AS (SELECT o_orderkey AS invoice, CAST(round(greatest(0, o_totalprice) * 100) AS HUGEINT) // 20 AS refund FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT l_orderkey AS invoice, l_linenumber AS line, l_suppkey AS partner, l_extendedprice AS gross, CAST(round(l_extendedprice * 100) AS HUGEINT) AS u FROM lineitem),
s AS (SELECT *, sum(u) OVER (PARTITION BY invoice) AS total FROM l JOIN w USING (invoice))
SELECT invoice, line, partner, gross, CAST(least((2 * refund * u + CAST(total AS HUGEINT)) // (2 * CAST(total AS HUGEINT)), u) AS DOUBLE) / 100 AS netted FROM s""")
def pro_rata(spark, d):
    price = F.greatest(F.lit(0), F.round(F.col("o_totalprice") * 100).cast("decimal(18,0)"))
    w = read(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("invoice"), (F.floor(price / 20) / 100).alias("refund"))
    lines = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("invoice"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("partner"), F.col("l_extendedprice").alias("gross"))
    out = R.allocate(lines, w, "invoice", "gross", "refund", "netted")
    return out.select("invoice", "line", "partner", "gross", F.col("netted").cast("double").alias("netted"))


@query("""WITH n AS (SELECT p_partkey, p_type, p_size FROM part WHERE p_partkey % 7 <> 0), o AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 13 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 5 <> 0)
SELECT coalesce(n.p_partkey, o.p_partkey) AS p_partkey, CASE WHEN o.p_partkey IS NULL THEN 'NEW' WHEN n.p_partkey IS NULL THEN 'REMOVED' WHEN n.p_type IS DISTINCT FROM o.p_type OR n.p_size IS DISTINCT FROM o.p_size THEN 'CHANGED' ELSE 'SAME' END AS status FROM n FULL JOIN o ON n.p_partkey = o.p_partkey""")
def drift(spark, d):
    p = read(spark, d, "part").select("p_partkey", "p_type", "p_size")
    old = p.where("p_partkey % 5 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 13 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return R.difference(p.where("p_partkey % 7 <> 0"), old, "p_partkey", ["p_type", "p_size"])


@query("SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def semi_association(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return R.semi_by_association(c, "id", read(spark, d, "orders").where("o_totalprice > 200000"), "o_custkey")


@query("SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_missing(spark, d):
    return R.missing_from(read(spark, d, "customer").select(F.col("c_custkey").alias("id")), "id", read(spark, d, "orders"), "o_custkey")


@query("""SELECT s_suppkey, 'nation' AS field, CAST(s_nationkey AS VARCHAR) AS value FROM supplier UNION ALL SELECT s_suppkey, 'name', s_name FROM supplier WHERE length(trim(s_name)) > 0""")
def melted(spark, d):
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"))
    return R.melt(s, ["s_suppkey"], ["nation", "name"])


@query("""WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'click' THEN value END AS click, CASE WHEN event_type = 'view' THEN value END AS view FROM events)
SELECT event_id, user_id, last_value(click IGNORE NULLS) OVER w AS click, last_value(view IGNORE NULLS) OVER w AS view FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def ffill_replay(spark, d):
    e = read(spark, d, "events")
    for kind in ("click", "view"):
        e = e.withColumn(kind, F.when(F.col("event_type") == kind, F.col("value")))
    return R.forward_fill(e, ["user_id"], ["ts", "event_id"], ["click", "view"]).select("event_id", "user_id", "click", "view")


@query("SELECT event_type, user_id, max(event_id) AS event_id FROM events GROUP BY event_type, user_id")
def dedupe_last(spark, d):
    return R.keep_last(read(spark, d, "events"), ["event_type", "user_id"], "event_id").select("event_type", "user_id", "event_id")


def _two_versions(spark, d):
    c = read(spark, d, "customer")
    now = c.where("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("decimal(18,2)").alias("amount"), F.col("c_mktsegment").alias("note"), F.lit(1).cast("long").alias("refreshed_at"))
    new = c.where("c_custkey % 10 < 5").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 4 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")).alias("name"), F.col("c_acctbal").alias("amount"))
    return now, new


_SCD = """c AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount, c_mktsegment AS note FROM customer WHERE c_custkey % 10 <> 0), i AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN c_name || '!' ELSE c_name END AS name FROM customer WHERE c_custkey % 10 < 5)"""


@query(f"""WITH {_SCD} SELECT coalesce(c.id, i.id) AS id, CASE WHEN c.id IS NULL THEN 'created' WHEN i.id IS NULL THEN 'absent' WHEN c.name <> i.name THEN 'updated' ELSE 'unchanged' END AS outcome, CASE WHEN c.name <> i.name THEN 'name' END AS changed FROM c FULL JOIN i ON c.id = i.id""")
def scd_changes(spark, d):
    now, new = _two_versions(spark, d)
    out = scd.merge(now, new, ["id"], F.lit(2).cast("long")).changes
    return out.withColumn("changed", F.array_join("changed", ","))


@query(f"""WITH {_SCD} SELECT coalesce(c.id, i.id) AS id, coalesce(i.name, c.name) AS name, c.note, CAST(CASE WHEN i.id IS NULL THEN 1 ELSE 2 END AS BIGINT) AS refreshed_at FROM c FULL JOIN i ON c.id = i.id""")
def scd_current(spark, d):
    now, new = _two_versions(spark, d)
    return scd.merge(now, new, ["id"], F.lit(2).cast("long")).current.select("id", "name", "note", "refreshed_at")


@query(f"""WITH {_SCD} SELECT c.id, c.name, CAST(1 AS BIGINT) AS valid_from, CAST(2 AS BIGINT) AS valid_to FROM c JOIN i ON c.id = i.id WHERE c.name <> i.name""")
def scd_history(spark, d):
    now, new = _two_versions(spark, d)
    return scd.merge(now, new, ["id"], F.lit(2).cast("long")).history.select("id", "name", "valid_from", "valid_to")


_IV = "iv AS (SELECT event_id, user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to FROM events)"


@query(f"WITH {_IV} SELECT event_id, user_id, valid_to IS NULL AS open_end FROM iv WHERE valid_to IS NULL OR valid_to > valid_from")
def lead_intervals(spark, d):
    return scd.intervals(read(spark, d, "events"), ["user_id"], "ts").select("event_id", "user_id", F.col("valid_to").isNull().alias("open_end"))


@query(f"WITH {_IV} SELECT user_id, event_id, event_type FROM iv WHERE valid_from <= TIMESTAMP '2024-01-15 12:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15 12:00:00')")
def scd_point_in_time(spark, d):
    iv = scd.intervals(read(spark, d, "events"), ["user_id"], "ts")
    return scd.point_in_time(iv, F.lit("2024-01-15 12:00:00").cast("timestamp")).select("user_id", "event_id", "event_type")


@query("""WITH r AS (SELECT DISTINCT p_brand AS brand, 0.05 AS rate FROM part) SELECT brand, CAST(rate AS DOUBLE) AS rate, '2024-01-01' AS valid_from, CASE WHEN brand = (SELECT min(p_brand) FROM part) THEN '2024-06-01' END AS valid_to FROM r
UNION ALL SELECT (SELECT min(p_brand) FROM part), 0.08, '2024-06-01', NULL""")
def set_rate(spark, d):
    p = read(spark, d, "part")
    rates = p.select(F.col("p_brand").alias("brand")).distinct().select("brand", F.lit(0.05).alias("rate"), F.lit("2024-01-01").cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    first = p.agg(F.min("p_brand")).first()[0]
    out = scd.set_rate(rates, {"brand": first}, 0.08, F.lit("2024-06-01").cast("date"))
    return out.select("brand", "rate", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


def _event_stream(spark, d):
    schema = read(spark, d, "events").schema
    raw = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(raw).parquet(f"{d}/events.parque[t]")
    return stream.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _windowed(spark, d, width, slide=None):
    out = S.tumbling(_event_stream(spark, d), "ts", width, ["event_type"], F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), slide=slide)
    return S.finish(out.select(F.unix_seconds("window.start").alias("start"), "event_type", "n", "total"), shared_folder(spark, "window"))


@query("SELECT CAST(floor(epoch(ts) / 3600) * 3600 AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark, d):
    return _windowed(spark, d, "1 hour")


@query("SELECT CAST((floor(epoch(ts) / 3600) - k) * 3600 AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events, (VALUES (0), (1)) t(k) GROUP BY 1, 2")
def stream_sliding(spark, d):
    return _windowed(spark, d, "2 hours", "1 hour")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM s GROUP BY user_id, sid""")
def stream_session(spark, d):
    out = S.sessions(_event_stream(spark, d), "ts", "2 hours", ["user_id"], F.count("*").alias("n"))
    return S.finish(out.select("user_id", F.unix_seconds("session_window.start").alias("start"), "n"), shared_folder(spark, "session"))


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(spark, d):
    """Each event arrives three times and comes out once."""
    thrice = _event_stream(spark, d).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    out = S.deduplicated(thrice, "event_id", "ts").select("event_id", "user_id", "event_type")
    return S.finish(out, shared_folder(spark, "dedupe"), "append")


@query("""WITH x AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS versions, arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type IN ('purchase', 'error')) AS last FROM events GROUP BY user_id)
SELECT user_id, versions, CASE WHEN last = 'purchase' AND versions > 1 THEN 'restated' WHEN last = 'purchase' THEN 'closed' WHEN versions > 0 THEN 'blocked' ELSE 'open' END AS state FROM x""")
def stream_period_states(spark, d):
    return S.finish(S.period_states(_event_stream(spark, d)), shared_folder(spark, "states"), "update", ("user_id",))


@query("""SELECT user_id, arg_max(event_type, (ts, event_id)) AS last_type, max(ts) IS NOT NULL AS seen FROM events GROUP BY user_id""")
def stream_scd_ingest(spark, d):
    """The stream runs to its end through the keyed sink; its current table is the result."""
    root = shared_folder(spark, "ingest")
    start = spark.createDataFrame([], "user_id long, last_type string, ts timestamp, event_id long, refreshed_at long")
    sink = S.ScdSink(spark, f"{root}/tables", ["user_id"], ["ts", "event_id"], start)

    def put(batch: DataFrame, batch_id: int) -> None:
        sink(batch.select("user_id", F.col("event_type").alias("last_type"), "ts", "event_id"), batch_id)

    S.ingest(_event_stream(spark, d), put, f"{root}/checkpoint")
    return sink.current().select("user_id", "last_type", F.lit(True).alias("seen"))


@query("""SELECT vec_id, round(score, 6) AS score FROM (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS score FROM embeddings) ORDER BY score DESC, vec_id LIMIT 10""")
def cosine_topk(spark, d):
    v = read(spark, d, "embeddings")
    probe = [float(x) for x in v.where("vec_id = 0").first()["embedding"]]
    return search.top_k(v, probe).select("vec_id", F.round("score", 6).alias("score"))


@query("""SELECT vec_id, round(score, 6) AS score FROM (SELECT vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) AS score FROM embeddings WHERE label IN (1, 2)) ORDER BY score DESC, vec_id LIMIT 5""")
def cosine_filtered(spark, d):
    v = read(spark, d, "embeddings")
    probe = [float(x) for x in v.where("vec_id = 0").first()["embedding"]]
    return search.top_k(v, probe, 5, F.col("label").isin(1, 2)).select("vec_id", F.round("score", 6).alias("score"))


_BLANK = "E' \\n\\t\\r\\f\\x0b'"
_ENDS = ", ".join(f"CASE WHEN contains(w, {m}) THEN since + 1024 + length(w) - instr(reverse(w), reverse({m})) + 1 END" for m in ("chr(10) || chr(10)", "chr(10)", "'. '", "' '"))
_NEXT = f"""SELECT doc_id, s, since, CASE WHEN length(s) - since <= 2560 THEN length(s) ELSE coalesce({_ENDS}, least(length(s), since + 2048)) END AS fin FROM (SELECT *, substr(s, since + 1025, least(length(s), since + 2048) - since - 1024) AS w FROM"""


@query(f"""WITH RECURSIVE t AS (SELECT doc_id, trim(text, {_BLANK}) AS s FROM documents WHERE length(trim(text, {_BLANK})) > 0),
c AS ({_NEXT} (SELECT doc_id, s, 0 AS since FROM t) z) y UNION ALL {_NEXT} (SELECT doc_id, s, greatest(fin - 500, since + 1) AS since FROM c WHERE fin < length(s)) z) y),
p AS (SELECT doc_id, since, trim(substr(s, since + 1, fin - since), {_BLANK}) AS chunk FROM c)
SELECT doc_id AS source_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY since) - 1 AS INTEGER) AS chunk_index, length(chunk) AS size, sha256(chunk) AS hash FROM p WHERE chunk <> ''""")
def text_chunks(spark, d):
    """Windows of each text, which together cover it; ends at paragraphs, lines, sentences or words."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("source_id"), "text")
    return search.index_texts(docs).select("source_id", "chunk_index", F.length("chunk").alias("size"), "hash")


@query("SELECT doc_id, CASE WHEN contains(text, '@') THEN regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '<email>', 'g') ELSE text END AS redacted FROM documents")
def redact_email(spark, d):
    return read(spark, d, "documents").select("doc_id", T.redact_emails(F.col("text")).alias("redacted"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderpriority LIKE '1-%' THEN 'refund' WHEN o_orderpriority LIKE '2-%' THEN 'management' ELSE 'other' END AS fee_type, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month, o_orderpriority LIKE '2-%' AS is_base FROM orders""")
def line_classifier(spark, d):
    o = read(spark, d, "orders")
    word = F.when(F.col("o_orderpriority").startswith("1-"), "refund").when(F.col("o_orderpriority").startswith("2-"), "management").otherwise("fee")
    label = F.concat(F.date_format("o_orderdate", "MMMM yyyy"), F.lit(" - Marketplace - "), word)
    c = T.classify_line(label)
    return o.select(F.col("o_orderkey").alias("k"), c["fee_type"].alias("fee_type"), c["month"].cast("string").alias("month"), c["is_base"].alias("is_base"))


@query("""SELECT l_orderkey AS invoice, l_linenumber AS line, l_suppkey AS partner, CASE WHEN date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-12-01') <= 365 THEN 'year' WHEN date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-12-01') <= 1000 THEN 'recent' ELSE 'old' END AS band FROM lineitem WHERE l_returnflag = 'R'""")
def aging_bands(spark, d):
    lines = read(spark, d, "lineitem").where("l_returnflag = 'R'")
    age = F.datediff(F.lit("2001-12-01").cast("date"), F.col("l_shipdate").cast("date"))
    return lines.select(F.col("l_orderkey").alias("invoice"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("partner"), M.band(age, [365, 1000], ["year", "recent", "old"]).alias("band"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3 AND c_custkey % 2 = 0")
def tenant_lens(spark, d):
    c = read(spark, d, "customer").withColumn("tenant_id", F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("b"))
    lens = Lens("building", "customer", "a", {"c_mktsegment": "BUILDING", "c_nationkey": 3})
    return Tenant("a").apply(lens, {"customer": c}).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))


@query("""SELECT event_id, CASE WHEN json_extract(props, '$.k') IS NOT NULL THEN '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || ',' ELSE '{' END || '"kind":"' || event_type || '","nested":{"id":' || event_id || ',"on":' || CASE WHEN value > 50 THEN 'true' ELSE 'false' END || '}}' AS merged FROM events""")
def json_merge(spark, d):
    """Numbers, booleans and nested objects keep their types."""
    e = read(spark, d, "events")
    nested = F.struct(F.col("event_id").alias("id"), (F.col("value") > 50).alias("on"))
    return e.select("event_id", T.merge_json(F.col("props"), F.to_json(F.struct(F.col("event_type").alias("kind"), nested.alias("nested")))).alias("merged"))


@query("SELECT 'companies' AS kind, 50 AS n UNION ALL SELECT 'contacts', 200 UNION ALL SELECT 'deals', 300 UNION ALL SELECT 'tickets', 500 UNION ALL SELECT 'documents', 100")
def corpus_source(spark, d):
    from ..sources.contract import CorpusSource

    spark.dataSource.register(CorpusSource)
    return spark.read.format("tallyloom_corpus").load().groupBy("kind").agg(F.count("*").cast("int").alias("n"))
