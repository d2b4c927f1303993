"""Signals harvested from records by a list of detectors, and the grid of indicators that they make.

What the detectors look for (a country, domains, a calling code, partners, a script) is configuration.  Stand-ins: a
customer is a brand with a made-up country, mailbox, phone and handle; the flag of the sheet is every seventeenth key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import MARKED_LATIN, known_script, ladder
from ..operators import relational as R
from ..session import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return register


@dataclass(frozen=True)
class Origin:
    """What points to the origin that is asked about."""

    country: str
    domains: tuple[str, ...]
    calling_code: str
    partners: tuple[int, ...]
    script: tuple[int, int]


DETECTORS = (
    ("on_list", "definitional"), ("in_sheet", "definitional"), ("country_match", "confirmed"), ("script_in_name", "confirmed"), ("mailbox_domain", "strong"),
    ("mailbox_domain_feed", "strong"), ("known_partner", "strong"), ("phone_code", "strong"), ("mobile_handle", "strong"), ("number_handle", "strong"), ("other_handle", "strong"), ("country_other", "negative"),
)
STRENGTH = {"definitional": 6, "confirmed": 5, "strong": 4, "negative": 0}


def detect(records: DataFrame, origin: Origin) -> DataFrame:
    """(brand, signal, strength, points) of records (brand, listed, flagged, country, name, email, feed_email, partner, phone, handle).

    One pass: each record gives the array of its signals.  A country that is no two-letter code says nothing; the three
    kinds of handles do not overlap.
    """
    c = F.col
    domain = lambda x: F.coalesce(F.lower(x).rlike(f"@({'|'.join(origin.domains)})\\."), F.lit(False))
    handle, digits = F.trim(F.coalesce(c("handle"), F.lit(""))), F.regexp_replace(F.coalesce(c("phone"), F.lit("")), "[^0-9]", "")
    mobile, number = handle.rlike("^1[3-9][0-9]{9}$"), handle.rlike("^[0-9]{5,11}$")
    hits: dict[str, Column] = {
        "on_list": c("listed"), "in_sheet": c("flagged"), "country_match": c("country") == origin.country, "script_in_name": known_script(c("name"), origin.script), "mailbox_domain": domain(c("email")),
        "mailbox_domain_feed": domain(c("feed_email")), "known_partner": c("partner").isin(*origin.partners), "phone_code": digits.rlike(f"^0*{origin.calling_code}[1-9]"), "mobile_handle": mobile,
        "number_handle": number & ~mobile, "other_handle": (handle != "") & ~number & ~mobile, "country_other": c("country").rlike("^[A-Z]{2}$") & (c("country") != origin.country),
    }
    one = lambda name, strength: F.struct(F.lit(name).alias("signal"), F.lit(strength).alias("strength"), F.lit("no" if strength == "negative" else "yes").alias("points"))
    found = F.array_compact(F.array(*[F.when(F.coalesce(hits[n], F.lit(False)), one(n, s)) for n, s in DETECTORS]))
    return records.select("brand", F.explode(found).alias("s")).select("brand", "s.*").distinct()


ORIGIN = Origin("NC", ("one", "two"), "99", (3, 5), MARKED_LATIN)


def records(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    feed = read(spark, d, "events").where("event_type = 'signup' AND value > 100").select(F.col("user_id").alias("u")).distinct()
    text = lambda n: (k + n).cast("string")
    kind = k % 5
    handle = F.when(kind == 0, F.concat(F.lit("13"), F.lpad(text(0), 9, "0"))).when(kind == 1, text(100000)).when(kind == 2, F.concat(F.lit(" id_"), text(0))).when(kind == 3, F.lit("  "))
    return read(spark, d, "customer").join(feed, k == F.col("u"), "left").select(
        k.alias("brand"), (F.col("c_acctbal") < 0).alias("listed"), (k % 17 == 0).alias("flagged"), F.when(F.col("c_nationkey") < 20, F.concat(F.lit("N"), F.char(F.col("c_nationkey") + 65))).otherwise("page furniture").alias("country"),
        F.when(k % 13 == 0, F.concat("c_name", F.lit(" Café"))).otherwise(F.col("c_name")).alias("name"), F.concat(F.lit("U@"), F.when(k % 7 == 0, "ONE").when(k % 7 == 1, "two").otherwise("three"), F.lit(".example")).alias("email"),
        F.when(F.col("u").isNotNull(), "x@two.example").alias("feed_email"), F.col("c_nationkey").alias("partner"), F.when(k % 6 == 0, F.concat(F.lit("+99 "), text(1000))).when(k % 6 == 1, "0099-0").alias("phone"), handle.alias("handle"),
    )


_FOUND = """r AS (SELECT c_custkey AS brand, * FROM customer),
found AS (SELECT brand, 'on_list' AS signal, 'definitional' AS strength, 'yes' AS points FROM r WHERE c_acctbal < 0 UNION SELECT brand, 'in_sheet', 'definitional', 'yes' FROM r WHERE brand % 17 = 0 UNION SELECT brand, 'country_match', 'confirmed', 'yes' FROM r WHERE c_nationkey = 2
UNION SELECT brand, 'script_in_name', 'confirmed', 'yes' FROM r WHERE brand % 13 = 0 UNION SELECT brand, 'mailbox_domain', 'strong', 'yes' FROM r WHERE brand % 7 < 2 UNION SELECT user_id, 'mailbox_domain_feed', 'strong', 'yes' FROM events JOIN r ON brand = user_id WHERE event_type = 'signup' AND value > 100
UNION SELECT brand, 'known_partner', 'strong', 'yes' FROM r WHERE c_nationkey IN (3, 5) UNION SELECT brand, 'phone_code', 'strong', 'yes' FROM r WHERE brand % 6 = 0 UNION SELECT brand, 'mobile_handle', 'strong', 'yes' FROM r WHERE brand % 5 = 0 UNION SELECT brand, 'number_handle', 'strong', 'yes' FROM r WHERE brand % 5 = 1
UNION SELECT brand, 'other_handle', 'strong', 'yes' FROM r WHERE brand % 5 = 2 UNION SELECT brand, 'country_other', 'negative', 'no' FROM r WHERE c_nationkey < 20 AND c_nationkey <> 2)"""


@query(f"WITH {_FOUND} SELECT * FROM found f WHERE NOT (signal = 'known_partner' AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = brand AND o_orderstatus = 'P'))")
def signal_harvest(spark, d):
    """Twelve detectors in one pass; pairs that are known already are not written again."""
    known = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("brand"), F.lit("known_partner").alias("signal")).distinct()
    return detect(records(spark, d), ORIGIN).join(known, ["brand", "signal"], "left_anti").select("brand", "signal", "strength", "points")


KINDS = ("click", "error", "purchase", "signup", "view")


@query(
    f"""WITH {_FOUND}, e AS (SELECT user_id AS brand, event_type AS signal FROM events JOIN customer ON c_custkey = user_id WHERE value >= 80), a AS (SELECT brand, signal FROM found UNION SELECT brand, signal FROM e)
SELECT brand, {', '.join(f"bool_or(signal = '{n}') AS has_{n}" for n in (*[x for x, _ in DETECTORS], *KINDS))}, count(DISTINCT signal) AS families,
CASE WHEN bool_or(signal IN ('on_list', 'in_sheet')) THEN 'done' WHEN bool_or(signal IN ('country_match', 'script_in_name')) THEN 'confirm' WHEN count(DISTINCT signal) >= 3 THEN 'review' ELSE 'collect' END AS next_step FROM a GROUP BY brand"""
)
def indicator_grid(spark, d):
    """All 17 indicators of a brand as booleans, from what was harvested and what its events say, and the next step."""
    names = [x for x, _ in DETECTORS] + list(KINDS)
    own = detect(records(spark, d), ORIGIN).select("brand", "signal")
    brands = read(spark, d, "customer").select(F.col("c_custkey").alias("brand"))
    events = R.semi_by_association(read(spark, d, "events").where("value >= 80").select(F.col("user_id").alias("brand"), F.col("event_type").alias("signal")), "brand", brands, "brand")
    g = own.unionByName(events).groupBy("brand").agg(*[F.bool_or(F.col("signal") == n).alias(f"has_{n}") for n in names], F.count_distinct("signal").alias("families"))
    steps = [(F.col("has_on_list") | F.col("has_in_sheet"), "done"), (F.col("has_country_match") | F.col("has_script_in_name"), "confirm"), (F.col("families") >= 3, "review")]
    return g.withColumn("next_step", ladder(steps, "collect"))
