"""URL filters: fixed host and path rules, and association rules mined from labelled urls, with native operations only.

Each url becomes a set of tokens: all suffixes of its host, its first label, directories, words of the last part of its
path, extension, query keys and values, fragment, scheme; digits are masked.  Spark's FP-growth mines combinations
together with the label.  As the combinations of a set double with each token, it gets baskets: the first ``BASKET``
tokens, and the others some at a time, each time with the first two, so every token is mined.  Combinations of tokens
that stand in different baskets of a url are found level by level (``across``), so none is left out.  All rules are
counted once more over whole token sets; those that conclude a verdict and pass ``MIN_SUPPORT`` and ``MIN_CONFIDENCE``
are kept, unless a rule with fewer tokens is as sure.  Rules match by an inverted index: a rule is listed under the one
of its tokens that the fewest urls have, and matches a url with that token if it has the others too.  The surest rule
decides (then support, fewer tokens, block before allow, the tokens' order); without a match the verdict is allow.

Labels: a url that a fixed rule decides is labelled with that verdict, which the method carries over to the others.

Defined results: a null url or one without ``://`` has empty host and path, no rule and no token; a very long url has
all its tokens; without labelled rows everything else is allowed; repeated rows each count and get equal verdicts; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: (verdict, host, path): a rule fits its host and all subdomains, if the path starts with the rule's.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.8
DEFAULT = "allow"
#: Tokens mined together: at most 2 ** BASKET combinations a basket.
BASKET = 10


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule as a string or null, its verdict or null); the longest that fits wins."""
    rule, verdict = F, F
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = rule.when(fits, F.lit(h + p)), verdict.when(fits, F.lit(v))
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """All tokens, each tagged with its place; the most telling places come first."""
    there = lambda c: F.length(c) > 0
    tag = lambda name, c: F.when(there(c), F.concat(F.lit(f"{name}="), c))
    each = lambda name, xs: F.transform(F.filter(xs, there), lambda x: F.concat(F.lit(f"{name}="), x))
    labels = F.split(host, "\\.")
    suffix = lambda k: F.when(there(host) & (F.size(labels) >= k), F.concat(F.lit("host"), k.cast("string"), F.lit("="), F.array_join(F.slice(labels, -k, k), ".")))
    parts = F.split(path, "/")
    folders = F.transform(F.slice(parts, F.lit(1), F.greatest(F.lit(0), F.size(parts) - 1)), lambda x, k: F.when(there(x), F.concat(F.lit("dir"), k.cast("string"), F.lit("="), x)))
    last = F.element_at(parts, -1)
    query = F.split(F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1), "&")
    first = F.array(suffix(F.lit(2)), F.get(F.array_compact(folders), 0), suffix(F.lit(1)), suffix(F.lit(3)), tag("label", F.get(labels, 0)), F.get(F.array_compact(folders), 1))
    second = F.array(tag("ext", F.regexp_extract(last, r"\.([A-Za-z0-9]{1,8})$", 1)), F.when(there(host) & F.contains(url, F.lit("#")), "fragment=yes"), tag("scheme", F.regexp_extract(url, "^([A-Za-z]+)://", 1)))
    keys = each("query", F.transform(query, lambda x: F.substring_index(x, "=", 1)))
    more = F.when(F.size(labels) > 3, F.transform(F.sequence(F.lit(4), F.greatest(F.lit(4), F.size(labels))), suffix))
    words = each("word", F.split(F.regexp_replace(last, r"\.[A-Za-z0-9]{1,8}$", ""), r"[^\p{L}\p{N}]+"))
    values = each("value", F.filter(query, lambda x: F.contains(x, F.lit("="))))
    none = F.array().cast("array<string>")
    found = F.concat(first, second, keys, words, folders, F.coalesce(more, none), values)
    masked = F.transform(F.array_compact(found), lambda x: F.when(x.rlike("=.*[0-9]"), F.concat(F.substring_index(x, "=", 1), F.lit("="), F.regexp_replace(F.substr(x, F.instr(x, "=") + 1), "[0-9]+", "#"))).otherwise(x))
    return F.when(F.coalesce(F.contains(url, F.lit("://")), F.lit(False)), F.array_distinct(masked)).otherwise(none)


def baskets(tokens: Column) -> Column:
    """The token sets that are mined for a url: bounded ones, which together hold all of its tokens."""
    rest = F.slice(tokens, F.lit(BASKET + 1), F.greatest(F.lit(0), F.size(tokens) - BASKET))
    step = BASKET - 2
    more = F.transform(F.sequence(F.lit(0), F.floor((F.size(rest) - 1) / step).cast("int")), lambda k: F.concat(F.slice(tokens, 1, 2), F.slice(rest, k * step + 1, F.lit(step))))
    return F.concat(F.array(F.slice(tokens, 1, BASKET)), F.when(F.size(rest) > 0, more).otherwise(F.array().cast("array<array<string>>")))


def across(scratch: Scratch, sets: DataFrame, least: float) -> Iterator[DataFrame]:
    """Tables of combinations (items) that no basket of some url holds whole, by their number of tokens.

    ``sets`` has tokens, verdict and rows.  Level by level from the pairs of tokens that some url has in different
    baskets, each combination with at least ``least`` rows of a verdict is grown by every other token that a url with
    it has.  Left out are only those that ``_minimal`` drops: with a part that has one verdict only, or a smaller part
    in the same rows.
    """
    of, most = F.sum("n").alias("of"), F.max("n").alias("most")
    enough, open_ = F.col("most") >= least, F.col("of") > F.col("most")
    single = sets.select(F.explode("tokens").alias("token"), "verdict", "rows").groupBy("token", "verdict").agg(F.sum("rows").alias("n"))
    single = scratch.cut(single.groupBy("token").agg(of, most).where(enough & open_).select("token"), "single")
    placed = sets.withColumn("set", F.struct("tokens", "verdict")).select("set", "verdict", "rows", F.posexplode("tokens").alias("place", "token")).join(single, "token")
    placed = placed.groupBy("set").agg(F.first("verdict").alias("verdict"), F.first("rows").alias("rows"), F.array_sort(F.collect_list(F.struct("place", "token"))).alias("placed"))
    placed = scratch.cut(placed.drop("set"), "placed")
    step = BASKET - 2
    basket = lambda x: F.floor((x["place"] - BASKET) / step)
    parted = lambda x, y: (x["place"] > 1) & (y["place"] >= BASKET) & ((x["place"] < BASKET) | (basket(x) < basket(y)))
    pairs = F.flatten(F.transform("placed", lambda x: F.transform(F.filter("placed", lambda y: parted(x, y)), lambda y: F.array_sort(F.array(x["token"], y["token"])))))
    pairs = placed.where(F.element_at("placed", -1)["place"] >= BASKET).select(F.explode(pairs).alias("items")).distinct()
    whole = placed.groupBy(F.array_sort(F.transform("placed", lambda x: x["token"])).alias("tokens"), "verdict").agg(F.sum("rows").alias("rows"))
    whole = scratch.cut(whole.withColumn("key", F.struct("tokens", "verdict")), "whole")
    named = F.concat_ws("\x01", "items").alias("rule_id")
    level = scratch.cut(pairs.select("items", named), "level")
    hits = _matches(whole, level).join(whole.select("key", "rows"), "key").groupBy("items", "key.verdict").agg(F.sum("rows").alias("n"))
    level = scratch.cut(hits.groupBy("items").agg(of, most).where(enough), "level")
    while level.take(1):
        yield level
        grow = _matches(whole, level.where(open_).select("items", named, F.col("of").alias("part"))).join(whole.select("key", "rows"), "key")
        grow = grow.select("rule_id", "part", "rows", F.col("key.verdict").alias("verdict"), "items", F.explode(F.array_except("key.tokens", "items")).alias("token"))
        grow = grow.select("rule_id", "part", "rows", "verdict", F.array_sort(F.array_append("items", F.col("token"))).alias("items"))
        # A combination is grown from several parts, from each with all of its rows.
        grow = grow.groupBy("items", "rule_id", "part", "verdict").agg(F.sum("rows").alias("n")).groupBy("items", "rule_id", "part").agg(of, most)
        grow = grow.groupBy("items").agg(F.first("of").alias("of"), F.first("most").alias("most"), F.min("part").alias("part"))
        level = scratch.cut(grow.where(enough & (F.col("of") < F.col("part"))).drop("part"), "level")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(rule_id, items, size, verdict, confidence, support) from (tokens, verdict).

    A url's further baskets repeat its verdict, so what FP-growth finds there are candidates, as are the combinations
    of tokens from more than one basket (``across``); support and confidence are counted anew over the distinct whole
    token sets, each with its number of rows.
    """
    scratch = Scratch(labelled.sparkSession)
    dealt = labelled.select("verdict", F.explode(baskets(F.col("tokens"))).alias("some")).select(F.array_append("some", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    sets = scratch.cut(labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("rows")), "sets")
    total = labelled.count()
    least = min_support * total / max(1, dealt.count())  # the same number of rows, as a share of the baskets
    model = FPGrowth(itemsCol="items", minSupport=least * (1 - 1e-9), minConfidence=0.0).fit(dealt)
    found = model.freqItemsets.where(F.exists("items", lambda x: x.startswith("verdict=")) & (F.size("items") > 1))
    rules = found.select(F.array_sort(F.filter("items", lambda x: ~x.startswith("verdict="))).alias("items"), F.substring(F.filter("items", lambda x: x.startswith("verdict="))[0], 9, 1000).alias("verdict"))
    verdicts = sets.select("verdict").distinct()
    for level in across(scratch, sets, min_support * total):
        rules = rules.union(level.select("items").crossJoin(verdicts))
    rules = scratch.cut(rules.distinct().withColumn("size", F.size("items")).withColumn("rule_id", F.concat_ws("\x01", "items", "verdict")), "candidates")
    each = sets.withColumn("key", F.struct("tokens", "verdict"))
    hits = _matches(each.select("key", "tokens"), rules).join(each.select("key", "rows"), "key")
    counts = hits.groupBy("rule_id").agg(F.sum("rows").alias("of"), F.sum(F.when(F.col("key.verdict") == F.col("verdict"), F.col("rows")).otherwise(0)).alias("hits"))
    rules = rules.join(counts, "rule_id").withColumn("support", F.col("hits") / F.lit(float(max(1, total)))).withColumn("confidence", F.col("hits") / F.col("of"))
    return rules.where((F.col("hits") >= min_support * total) & (F.col("confidence") >= min_confidence)).select("rule_id", "items", "size", "verdict", "confidence", "support")


def _matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, the columns of ``rules``) of each rule whose tokens a set (key, tokens) has all: by the rule's rarest token."""
    listed = rules.select("rule_id", F.explode("items").alias("token"))
    frequency = sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    rarest = listed.join(frequency, "token").groupBy("rule_id").agg(F.min_by("token", F.struct("n", "token")).alias("token"))
    index = rules.join(rarest, "rule_id")
    hits = sets.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    return hits.where(F.size(F.array_except("items", "tokens")) == 0).drop("token", "tokens")


def _minimal(rules: DataFrame) -> DataFrame:
    """Without rules for which a proper subset of the tokens gives the verdict as surely."""
    masks = F.expr("sequence(1, shiftleft(1, cast(size AS int)) - 2)")
    parts = rules.where("size > 1").select("rule_id", "items", "verdict", "confidence", F.explode(masks).alias("mask"))
    part = F.expr("filter(items, (x, i) -> shiftright(mask, i) % 2 = 1)")
    parts = parts.select("rule_id", F.concat_ws("\x01", part, F.col("verdict")).alias("part_id"), "confidence")
    known = rules.select(F.col("rule_id").alias("part_id"), F.col("confidence").alias("part_confidence"))
    beaten = parts.join(known, "part_id").where(F.col("part_confidence") >= F.col("confidence")).select("rule_id").distinct()
    return rules.join(beaten, "rule_id", "left_anti")


def matched(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, mined) for each token set (key, tokens) that a rule matches: the verdict of the surest rule."""
    rank = F.struct("confidence", "support", (-F.col("size")).alias("size"), (F.col("verdict") == "block").alias("block"), "rule_id")
    return _matches(sets, rules).groupBy("key").agg(F.max_by("verdict", rank).alias("mined"))


def judge(pages: DataFrame, rules: tuple = RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url)."""
    scratch = Scratch(pages.sparkSession)
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"))
    rows = scratch.cut(rows.withColumn("key", F.concat_ws("\x01", "tokens")), "rows")
    labelled = rows.where("ruled is not null").select("tokens", F.col("ruled").alias("verdict"))
    if not labelled.take(1):
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(DEFAULT)).alias("verdict"))
    mined = scratch.cut(mine(labelled, min_support, min_confidence), "mined")
    mined = scratch.cut(_minimal(mined), "rules")
    sets = rows.where("ruled is null").groupBy("key").agg(F.first("tokens").alias("tokens"))
    found = scratch.cut(matched(sets, mined), "found")
    out = rows.join(found, "key", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", "mined", F.lit(DEFAULT)).alias("verdict"))
