"""What mappers do with a vendor's records: ids, times, enums, overflow, classifying ladders.  All JVM-side expressions."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The name space of ids made here.
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tallyloom:records")


def stable_uuid(name: Column, namespace: uuid.UUID = NAMESPACE) -> Column:
    """The name's version 5 UUID: the same for the same name in every run; null for null."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1, F.lit(1))
    parts = [F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)]
    return F.when(name.isNotNull(), F.concat_ws("-", *parts))


def signed_key(name: Column) -> Column:
    """The first eight bytes of the SHA-256 as a signed number, as names of locks."""
    high = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(F.sha2(name, 256), 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def epoch_time(x: Column) -> Column:
    """Epoch seconds or milliseconds (told by their size) or ISO text to a timestamp; null for what is none of them."""
    number = F.when(x.cast("string").rlike(r"^-?[0-9]+$"), x.cast("string").try_cast("long"))
    at = F.when(F.abs(number) >= 100_000_000_000, F.timestamp_millis(number)).when(number.isNotNull(), F.timestamp_seconds(number))
    return F.coalesce(at, x.cast("string").try_cast("timestamp"))


def known_script(x: Column, *ranges: tuple[int, int]) -> Column:
    """Whether a text holds a character of these ranges of code points."""
    return x.rlike("[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]")


#: Ranges of CJK ideographs, of kana and of Latin letters with marks.
CJK, KANA, MARKED_LATIN = (0x4E00, 0x9FFF), (0x3040, 0x30FF), (0xC0, 0x24F)


def split_record(df: DataFrame, record: str, typed: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """A JSON record to typed columns and the rest of its members as JSON (``overflow``; ``{}`` if there is none).

    A member that does not read as its type is null in its column and stays in the overflow, so that nothing is lost.
    """
    members = F.try_parse_json(F.col(record)).try_cast("map<string,variant>")
    df = df.withColumn("__m", members)
    columns = {c: F.try_variant_get(F.element_at("__m", F.lit(c)), "$", kind) for c, kind in typed.items()}
    read = F.array_compact(F.array(*[F.when(v.isNotNull(), F.lit(c)) for c, v in columns.items()]))
    rest = F.map_filter("__m", lambda k, _: ~F.array_contains(read, k))
    return df.select(*keep, *[v.alias(c) for c, v in columns.items()], F.to_json(F.to_variant_object(rest)).alias("overflow"))


def member_names(x: Column) -> Column:
    """The names of a JSON object's members, in order."""
    return F.array_sort(F.json_object_keys(x))


def coerce(x: Column, values: Sequence[str], aliases: Mapping[str, str] | None = None) -> tuple[Column, Column]:
    """(value, rejected): trimmed, lower-cased and by its alias; what is no value then is null, and rejected if it was filled."""
    low = F.nullif(F.lower(F.trim(x)), F.lit(""))
    for alias, value in (aliases or {}).items():
        low = F.when(low == alias, F.lit(value)).otherwise(low)
    value = F.when(low.isin(*values), low)
    return value, low.isNotNull() & value.isNull()


def referral(x: Column, partners: Mapping[str, Sequence[str]], houses: Sequence[str] = (), none: Sequence[str] = ("none", "n/a", "no", "-")) -> tuple[Column, Column]:
    """(partner, reason): a referral tag's canonical partner, else why it has none.

    Tags are compared without case, blanks and punctuation; a partner is known by its name and its aliases.
    """
    bare = F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+", "")
    plain = lambda s: "".join(c for c in s.lower() if c.isalnum())
    partner = F.lit(None).cast("string")
    for name, aliases in reversed(partners.items()):
        partner = F.when(bare.isin(*{plain(name), *map(plain, aliases)}), F.lit(name)).otherwise(partner)
    empty = (bare == "") | bare.isin(*map(plain, none))
    reason = F.when(partner.isNotNull(), F.lit(None)).when(empty, "no referral").when(bare.isin(*map(plain, houses)) if houses else F.lit(False), "own house").otherwise("unknown tag")
    return partner, reason


def ladder(steps: Sequence[tuple[Column, str]], other: str) -> Column:
    """The outcome of the first step that holds; a null condition does not hold."""
    out = F.lit(other)
    for condition, outcome in reversed(steps):
        out = F.when(F.coalesce(condition, F.lit(False)), F.lit(outcome)).otherwise(out)
    return out


def seller_location(address: Column, phone: Column, home: str, home_code: str, forwarders: str) -> Column:
    """Where a seller is: a forwarding address tells nothing; else the address, then the phone's country code."""
    filled = lambda c: F.length(F.trim(c)) > 0
    return ladder([(address.rlike(f"(?i){forwarders}"), "forwarder"), (address.rlike(f"(?i){home}"), "home"), (filled(address), "abroad"), (F.regexp_replace(phone, "[ ()-]", "").startswith(home_code), "home")], "unknown")


def finding_outcome(verdict: Column, source: Column, note: Column, doubt: str) -> Column:
    """A research finding: confirmed needs a source and no word of doubt."""
    filled = F.length(F.trim(F.coalesce(source, F.lit("")))) > 0
    return ladder([(verdict.isNull(), "open"), (~filled, "unsourced"), (note.rlike(f"(?i){doubt}"), "borderline")], "confirmed")
