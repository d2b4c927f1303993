"""Text kernels, all of them JVM-side expressions but for the chunker, whose boundaries need a scan."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"


def normal_email(x: Column) -> Column:
    return F.nullif(F.lower(F.trim(x)), F.lit(""))


def redact_emails(x: Column, most: int | None = None) -> Column:
    """Addresses go; a log writer, whose lines are bounded, gives the number of characters that it keeps."""
    whole = F.regexp_replace(x, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "<email>")
    return whole if most is None else F.substring(whole, 1, most)


def unwrap_links(x: Column) -> Column:
    """``<url|label>`` and ``<mailto:a|a>`` to their label, ``<url>`` to the url; emoji codes go."""
    x = F.regexp_replace(x, r"<(?:mailto:)?[^<>|]*\|([^<>]*)>", "$1")
    x = F.regexp_replace(x, r"<(?:mailto:)?([^<>|]+)>", "$1")
    return F.trim(F.regexp_replace(x, r":[a-z0-9_+-]+:", ""))


def labelled_field(x: Column, label: str) -> Column:
    """The value of a ``*Label*: value`` line; an empty field is null and does not take the next line's text."""
    return F.nullif(F.trim(F.regexp_extract(x, rf"(?m)^[ \t]*\*{label}\*:?[ \t]*:?[ \t]*([^\n]*)$", 1)), F.lit(""))


def snippet(x: Column, word: str, reach: int = 40) -> Column:
    """The text around the first hit, white space collapsed; null without a hit."""
    at = F.instr(F.lower(x), word.lower())
    cut = F.substring(x, F.greatest(F.lit(1), at - reach), F.lit(2 * reach + len(word)))
    return F.when(at > 0, F.trim(F.regexp_replace(cut, r"\s+", " ")))


#: Words by which a line's channel is told, in order; a deployment gives its own.
CHANNELS = {"marketplace": ("marketplace",), "web": ("web", "shop")}


def classify_line(x: Column, channels: dict[str, tuple[str, ...]] = CHANNELS) -> Column:
    """An invoice line's description to (month, channel, fee kind, base flag)."""
    low = F.lower(x)
    month = F.regexp_extract(low, rf"({MONTHS})\s+([0-9]{{4}})", 0)
    kind = F.when(low.contains("refund"), "refund").when(low.contains("management") | low.contains("commission"), "management").when(low.contains("subscription"), "subscription").otherwise("other")
    channel = F.lit("unknown")
    for name, words in reversed(channels.items()):
        channel = F.when(low.rlike("|".join(map(re.escape, words))), name).otherwise(channel)
    return F.struct(
        F.try_to_timestamp(F.initcap(F.nullif(month, F.lit(""))), F.lit("MMMM yyyy")).cast("date").alias("month"),
        channel.alias("channel"), kind.alias("fee_type"), (kind == "management").alias("is_base"),
    )


def payment_terms(x: Column) -> Column:
    """'net 30' or '30' to 30."""
    return F.regexp_extract(F.lower(F.trim(x)), r"^(?:net\s*)?([0-9]{1,3})(?:\s*days?)?$", 1).try_cast("int")


def split_name(x: Column) -> tuple[Column, Column]:
    """First token and the rest."""
    parts = F.split(F.trim(x), r"\s+", 2)
    return F.nullif(F.get(parts, 0), F.lit("")), F.get(parts, 1)


def parse_money(x: Column) -> Column:
    """Currency signs and commas go; NA is 0; what is then no number is null."""
    bare = F.regexp_replace(F.trim(x), r"[$,]", "")
    return F.when(F.upper(bare).isin("NA", "N/A", "-"), F.lit(0).cast("decimal(18,2)")).otherwise(F.nullif(bare, F.lit("")).try_cast("decimal(18,2)"))


def parse_date(x: Column, *patterns: str) -> Column:
    """The first of several patterns that reads the text."""
    return F.coalesce(*[F.try_to_timestamp(x, F.lit(p)) for p in patterns]).cast("date")


def _object(x: Column) -> Column:
    """A JSON object's members with their types; null for other JSON and for what is none."""
    return F.try_parse_json(x).try_cast("map<string,variant>")


def merge_json(base: Column, over: Column) -> Column:
    """Two JSON objects, of which the right one's members win; types and nested values stay.  A null side is an empty
    object, and what is no object gives null, for merging would lose it."""
    fine = lambda x: x.isNull() | _object(x).isNotNull()
    left, right = _object(F.coalesce(base, F.lit("{}"))), _object(F.coalesce(over, F.lit("{}")))
    both = F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)
    return F.when(fine(base) & fine(over), F.to_json(F.to_variant_object(both)))


def canonical_json(x: Column) -> Column:
    """Sorted keys at all levels and no blanks, for equality; null for what is no JSON."""
    return F.to_json(F.try_parse_json(x))


def cut_text(text: str, target: int = 2048, most: int = 2560, overlap: int = 500) -> list[str]:
    """Windows that cover all of a text: each ends at a paragraph, line, sentence or word end past half the target if
    there is one, and the next begins ``overlap`` before that end, so nothing is lost."""
    text = text.strip()
    if len(text) <= most:
        return [text] if text else []
    out, at = [], 0
    while at < len(text):
        end = min(len(text), at + target)
        if len(text) - at <= most:
            end = len(text)
        else:
            for mark in ("\n\n", "\n", ". ", " "):
                hit = text.rfind(mark, at + target // 2, end)
                if hit > 0:
                    end = hit + len(mark)
                    break
        out.append(text[at:end].strip())
        if end == len(text):
            break
        at = max(end - overlap, at + 1)
    return [c for c in out if c]


@F.pandas_udf(ArrayType(StringType()))
def chunks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(lambda t: cut_text(t) if t else [])
