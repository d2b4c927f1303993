"""Personal data: base patterns, and terms that give protected entities away, with native operations only.

Base spans are the leftmost non-overlapping matches of four patterns over the whole text, of which those that fail
their check are dropped.  Spark has no function for the places of matches; they follow from the lengths of the matches
and of what a split leaves between them.  The patterns are the contract's, written so that they neither recurse nor
back up: possessive repeats where nothing that follows could use what they take, and a start only where a run starts
or the last match ended.

The method adds terms.  Protected are each distinct base value and the part of it that it shares with others (an
address's domain, an ip's first three numbers, a card's issuer, a phone number without its last four digits); a term
is a word of a document that holds one, outside its base spans.  Over the different texts of the corpus, with df the
number of those that hold a term or an entity, their pointwise mutual information log2(N c(t, e) / (df(t) df(e))) is
what t gives away of e, whose whole information is log2(N / df(e)).  A rare entity is not dropped but smoothed: each
count leaves one text out, as a text is no evidence for itself, and where a value stands in one text only, what its
words give away is estimated by the part that it shares.  A term that gives away ``DISCLOSURE`` of the whole is
generalised everywhere in the documents that hold that entity.

Defined results: a null text is an empty one (no spans); repeated rows get equal spans; copies are no evidence; other
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, maybe_in

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
WORD = r"[\p{L}\p{M}\p{N}]++"
DISCLOSURE = 0.9

_SPAN = "array<struct<start:long,k:int,kind:string,stop:long,value:string>>"


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        digits = F.translate(value, " -", "")
        return F.length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)
    return F.lit(True)


def _check(kind: str):
    return lambda s: _valid(kind, s["value"])


def places(text: Column, pattern: str, kind: str, k: int, wanted=None) -> Column:
    """All matches (``wanted`` ones, if given) as (start, k, kind, stop, value), in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.lit(None).cast(_SPAN)
    steps = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda v, b: F.struct(v.alias("v"), F.length(b).cast("long").alias("b")))
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.coalesce(empty, F.array().cast(_SPAN)).alias("got"))

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["b"]
        stop = start + F.length(x["v"])
        span = F.struct(start.alias("start"), F.lit(k).alias("k"), F.lit(kind).alias("kind"), stop.alias("stop"), x["v"].alias("value"))
        got = F.array_append(s["got"], span).cast(_SPAN)
        return F.struct(stop.alias("at"), (got if wanted is None else F.when(wanted(x["v"]), got).otherwise(s["got"])).alias("got"))

    return F.when(F.size(found) > 0, F.aggregate(steps, begin, step, lambda s: s["got"])).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """The valid spans of all kinds, by start and then kind."""
    #: What a text must hold for a pattern to be worth a try.
    hints = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"(?:[0-9][\x20-]?){13}"), "phone": text.rlike(r"\+[0-9]")}
    each = [
        F.when(hints[kind], F.filter(places(text, PATTERNS[kind], kind, k), _check(kind))).otherwise(F.array().cast(_SPAN))
        for k, kind in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*each))


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def _entities(s: Column) -> Column:
    """What a span protects: its value, and the part that it shares with others of its kind."""
    value, digits = F.lower(s["value"]), F.regexp_replace(s["value"], "[^0-9]", "")
    number = s["kind"].isin("card", "phone")
    part = F.when(s["kind"] == "email", F.substring_index(value, "@", -1)).when(s["kind"] == "ip", F.substring_index(value, ".", 3))
    part = part.when(s["kind"] == "card", F.left(digits, F.lit(6))).otherwise(F.left(digits, F.length(digits) - 4))
    return F.array(F.concat_ws(":", s["kind"], F.when(number, digits).otherwise(value)), F.concat_ws("/", s["kind"], part))


def _outside(text: Column, base: Column) -> Column:
    """The text with its base spans blanked, so that places stay as they are."""

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, (s["at"] + 1).cast("int"), F.greatest(F.lit(0), x["start"] - s["at"]).cast("int"))
        blank = F.repeat(F.lit(" "), F.greatest(F.lit(0), x["stop"] - F.greatest(s["at"], x["start"])).cast("int"))
        return F.struct(F.greatest(s["at"], x["stop"]).alias("at"), F.array_append(s["out"], F.concat(gap, blank)).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(base, begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(base) > 0, done).otherwise(text)


def _words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lower))


def find(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(doc_id, digest, base, spans) for each row: arrays of (start, k, kind, stop, value); ``spans`` holds base and terms.

    One pass finds the base spans; a second counts in how many different texts each word of the corpus stands (summed
    before the shuffle).  Only words of texts that hold entities go on from there.
    """
    scratch = Scratch(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("base", base_spans(F.col("text")))
    outside = F.when(F.size("base") > 0, _outside(F.col("text"), F.col("base")))
    rows = scratch.cut(rows.select("doc_id", F.md5("text").alias("digest"), "base", outside.alias("outside")), "base")
    total = rows.select("digest").distinct().count()
    held = rows.where("outside is not null").dropDuplicates(["digest"])
    entities = F.array_distinct(F.flatten(F.transform("base", _entities)))
    held = scratch.cut(held.select("digest", "outside", entities.alias("entities"), _words(F.col("outside")).alias("words")), "held")
    each = held.select("digest", F.explode("entities").alias("entity"))
    # What stands in one text only leaves nothing when that text is left out.
    sizes = scratch.cut(each.groupBy("entity").agg(F.count("*").alias("df_e")).where("df_e > 1"), "sizes")
    shared = each.join(sizes, "entity").groupBy("digest").agg(F.collect_list("entity").alias("entities"))
    shared = scratch.cut(held.select("digest", "words").join(shared, "digest"), "shared")
    uses = shared.select("digest", "words", F.explode("entities").alias("entity")).select("digest", "entity", F.explode("words").alias("term"))
    pairs = uses.groupBy("term", "entity").agg(F.count("*").alias("c")).where(F.col("c") > 1)
    pairs = scratch.cut(pairs.join(sizes, "entity"), "pairs")
    # Words of all rows, less those of the copies, so that only texts with copies are shuffled.
    whole_texts = docs.select(text.alias("text")).withColumn("digest", F.md5("text"))
    copies = scratch.cut(rows.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select(F.col("digest").alias("d"), "n"), "copies")
    repeated = maybe_in(whole_texts, "digest", copies.select("d")).distinct().join(copies, F.col("digest") == F.col("d"))
    counted = whole_texts.select("text", F.lit(1).cast("long").alias("n")).union(repeated.select("text", 1 - F.col("n")))
    counted = counted.withColumn("base", base_spans(F.col("text"))).select(_outside(F.col("text"), F.col("base")).alias("text"), "n")
    words = counted.select(F.explode(_words(F.col("text"))).alias("term"), "n").groupBy("term").agg(F.sum("n").alias("df_t"))
    told = pairs.join(words, "term")
    rest = F.lit(float(total - 1))
    gain, whole = F.log2(rest * (F.col("c") - 1) / ((F.col("df_t") - 1) * (F.col("df_e") - 1))), F.log2(rest / (F.col("df_e") - 1))
    told = scratch.cut(told.where((whole > 0) & (gain >= disclosure * whole)).select("term", "entity"), "told")
    keyed = uses.withColumn("key", F.xxhash64("term", "entity"))
    likely = maybe_in(keyed, "key", told.select(F.xxhash64("term", "entity").alias("key")))
    # An inner join (told has each pair once): a semi join would be pushed below the filter.
    terms = likely.join(told, ["term", "entity"]).groupBy("digest").agg(F.collect_set("term").alias("terms"))
    marked = places(F.col("outside"), WORD, "term", len(KINDS), lambda v: F.array_contains("terms", F.lower(v)))
    extra = scratch.cut(held.join(terms, "digest").select("digest", marked.alias("terms")), "terms")
    scratch.drop("held", "sizes", "shared", "pairs", "copies", "told")
    none = F.array().cast(_SPAN)
    return rows.join(extra, "digest", "left").select("doc_id", "digest", "base", F.array_sort(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """The columns of the driver's query."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    more = [(F.size("spans") - F.size("base")).cast("long").alias("n_term"), (F.size("spans") > 0).alias("has_private")]
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *more)


def sanitise(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` with each span of their text replaced by its kind, as ``[EMAIL]``.

    Where spans overlap, the first one's label stands for what they cover together.  A null text stays null.
    """
    found = find(docs, **limits).select(F.col("digest").alias("__digest"), F.col("spans").alias("__spans")).dropDuplicates(["__digest"])
    keyed = docs.withColumn("__digest", F.md5(F.coalesce(F.col("text"), F.lit(""))))

    def step(s: Column, x: Column) -> Column:
        label = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
        fresh = x["start"] >= s["at"]
        piece = F.concat(F.substring(F.col("text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), label)
        return F.struct(F.greatest(s["at"], x["stop"]).alias("at"), F.when(fresh, F.array_append(s["out"], piece)).otherwise(s["out"]).alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate("__spans", begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text"))))
    return keyed.join(found, "__digest", "left").withColumn("text", F.when(F.size("__spans") > 0, done).otherwise(F.col("text"))).select(*docs.columns)
