"""Line dedup by a segment-partition edit join, with native operations only.

Lines are compared in a normal form (lower case, runs of white space as one space, trimmed).
Equal forms are one line from the first aggregation on, so a line that a third of all documents hold is one row.

All forms but the empty one are compared for equality.  Those of at least EDITS + 1 characters (so that no segment is
empty) within ``EDITS`` edits of each other are linked:

* Lengths fall into classes a few characters wide (an eighth of the length, ``EDITS`` at least).  The least length of a
  class is cut into EDITS + 1 segments; all lines of the class have them at the same places, those of the first half
  counted from the line's start, the others from its end.
* Of two lines at most EDITS edits apart, some segment i of the one stands in the other as it was, with i - 1 edits
  before it and EDITS + 1 - i after it at most.  So it is found there at most as many places away: a line has an index
  key for each segment (segment number, class, its text; hashed) and a probe key for each such shift.
* A line of length m may have a partner from m - EDITS on, so if that reaches into the class below, it has that class's
  keys too, as a guest.  Guests are not compared with each other, for their own class does that.
* Lines that share a key meet in blocks of ``BLOCK`` rows, each two in one pair of blocks.  A pair of blocks yields, for
  each line, how many it links to, and a forest; never the pairs.  A pair is first held to ``parity`` (two edits flip
  four bits at most; few lines that merely share a segment come so near), then to EIGHTHS (all but EDITS of
  them must recur within EDITS places), then verified by a banded bit-parallel edit distance: one column of the band is
  one machine word.  Two lines that share several keys count under the first one only.

Linked lines form classes; of each class the first line (by doc_id, nulls last, then place) is kept.

All tables here grow with the documents, so their joins are merge joins at every size, whose hot keys Spark splits.

Defined results: a null text has no lines and stays null; empty lines are never linked or removed, and lines of up to
EDITS characters only join their copies; rows that share a doc_id share places, so the same line at the same place of both is kept in
both; other columns stay as they are; an empty table gives an empty table.  Forms are told apart by 128-bit digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, block_pairs, components, maybe_in

EDITS = 2
BLOCK = 128
EIGHTHS = 8
#: Places of a document are numbers below this.
PLACES = 1 << 32


def formed(docs: DataFrame) -> DataFrame:
    """(doc_id, pos, form): the lines of each text with content, in normal form.

    A text is lower-cased and its white space settled once, before it is split.  Replacing by pattern costs most, and
    few texts need it: those that hold other white space than single spaces.  Steps over rows, not over arrays, run as
    compiled code.
    """
    low = docs.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("low"))
    odd = F.contains("low", F.lit("  "))
    for c in "\t\x0b\f\r":
        odd = odd | F.contains("low", F.lit(c))
    low = low.select("doc_id", F.when(odd, F.regexp_replace("low", r"[ \t\x0B\f\r]+", " ")).otherwise(F.col("low")).alias("low"))
    lines = low.select("doc_id", F.posexplode(F.split("low", "\n")).alias("pos", "line"))
    return lines.select("doc_id", "pos", F.trim("line").alias("form")).where(F.col("form") != "")


def _class(length: Column, edits: int) -> Column:
    """The least length of a length's class: classes are as wide as the greatest power of two up to an eighth of it."""
    least = 1
    while least < edits:
        least *= 2
    over = F.greatest(F.lit(0), length - (edits + 1))
    widths = F.array(*[F.lit(max(least, 1 << max(0, bits - 4))) for bits in range(1, 33)])  # by the bits of ``over``
    return (over - over % F.get(widths, F.length(F.bin(over.cast("long"))) - 1) + (edits + 1)).cast("int")


def spots(edits: int) -> list[tuple[int, int]]:
    """(segment, shift) of all keys of a class, in the order in which a pair is looked for; shift 0 is the index key.

    With up to two edits one sign of shifts will do: where a segment is found some places before, the other line's is
    found as many behind.
    """
    reach = {i: min(i - 1, edits + 1 - i) for i in range(1, edits + 2)}
    shifts = lambda r: [0] + [s for k in range(1, r + 1) for s in ([k] if edits <= 2 else [k, -k])]
    return [(i, s) for i in sorted(reach, key=lambda i: (reach[i], i)) for s in shifts(reach[i])]


def _size(least: Column, edits: int) -> Column:
    """The size of a segment but the last one counted from the start, for the class of this least length."""
    return F.floor(least / (edits + 1)).cast("int")


def _piece(form: Column, length: Column, least: Column, size: Column, spot: tuple[int, int], edits: int) -> Column:
    """The text at a spot of a line, for the class of this least length."""
    (i, shift), parts = spot, edits + 1
    left = (parts + 1) // 2  # the last segment counted from the start; it takes what the division leaves
    if i <= left:
        return F.substring(form, size * (i - 1) + (1 + shift), least - size * (parts - 1) if i == left else size)
    return F.substring(form, length - size * (parts + 1 - i) + (1 + shift), size)


def keys(lines: DataFrame, edits: int) -> DataFrame:
    """``lines`` (with form) and a column a key: h (home) or g (guest) and the number of the spot; null where there is none.

    Lengths, classes and sizes are columns of their own, so that each is computed once and the code stays small.
    """
    names = lines.columns
    n, h, g = F.col("__n"), F.col("__h"), F.col("__g")
    lines = lines.withColumn("__n", F.length("form"))
    below = _class(F.greatest(n - edits, F.lit(edits + 1)), edits)
    lines = lines.withColumn("__h", F.when(n > edits, _class(n, edits))).withColumn("__g", F.when(n > edits, below))
    lines = lines.withColumn("__hs", _size(h, edits)).withColumn("__gs", _size(g, edits))
    out = []
    for name, least, there in (("h", h, h.isNotNull()), ("g", g, h != g)):
        for k, spot in enumerate(spots(edits)):
            piece = _piece(F.col("form"), n, least, F.col(f"__{name}s"), spot, edits)
            out.append(F.when(there, F.xxhash64(F.lit(spot[0]), least, piece)).alias(f"{name}{k}"))
    return lines.select(*names, *out)


def _shared(a: Column, b: Column, most: Column, end: bool) -> Column:
    """Length of a common prefix (suffix with ``end``), the longest one if it is under 2 ** 17: found by doubling steps."""
    part = F.right if end else F.left

    def step(k: Column, p: Column) -> Column:
        more = k + p
        return F.when((more <= most) & (part(a, more) == part(b, more)), more).otherwise(k)

    return F.aggregate(F.array(*[F.lit(1 << t) for t in range(16, -1, -1)]), F.lit(0), step)


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two strings of at least ``edits`` characters, no more than ``edits`` apart in length, are within ``edits`` edits.

    What they share at both ends is cut off (but for ``edits`` characters); the rest goes through the band.
    """
    least = F.least(F.length(a), F.length(b))

    def tail(x: Column) -> Column:  # x: a, b, start
        shared = _shared(x["a"], x["b"], F.least(F.length(x["a"]), F.length(x["b"])), True)
        keep = F.greatest(F.lit(0), shared - edits)
        cut = lambda v: F.split(F.left(v, F.length(v) - keep), "")
        return F.struct(cut(x["a"]).alias("a"), cut(x["b"]).alias("b"))

    skip = F.greatest(F.lit(0), _shared(a, b, least, False) - edits)
    # One-row arrays bind a value to a name, so that it is computed once.
    heads = F.transform(F.array(skip), lambda k: F.struct(F.substring(a, k + 1, F.length(a)).alias("a"), F.substring(b, k + 1, F.length(b)).alias("b")))
    return F.transform(F.transform(heads, tail), lambda x: banded(x["a"], x["b"], edits))[0]


def banded(a: Column, b: Column, edits: int) -> Column:
    """Whether two arrays of characters (lengths at least ``edits``, at most that apart) are within ``edits`` edits.

    Banded bit-parallel: bit t of a word stands for row j + edits - (top - t) of column j, so the band moves down one
    row with each character of b.  The distance is followed down the band's lowest diagonal and then along the last
    row; once it is more than the last row could take back, the remaining characters are passed over.
    """
    width = 2 * edits + 2
    top, mask = width - 1, (1 << width) - 1
    m, n = F.size(a), F.size(b)
    low = F.lit(0).cast("long")
    lost = 2 * edits + n - m

    def step(s: Column, j: Column) -> Column:
        c = F.get(b, j - 1)
        hits = [F.when((j + (edits - top + t) >= 1) & (F.get(a, j + (edits - top + t - 1)) == c), F.lit(1 << t).cast("long")).otherwise(low) for t in range(width)]
        x = hits[0]
        for h in hits[1:]:
            x = x.bitwiseOR(h)
        return F.struct(s["vp"].alias("vp"), s["vn"].alias("vn"), s["dist"].alias("dist"), x.alias("x"), j.alias("j"))

    def advance(s: Column) -> Column:
        vp, vn, x, j = s["vp"], s["vn"], s["x"], s["j"]
        full = F.lit(mask).cast("long")
        d0 = (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(full)
        return F.struct(vp.alias("vp"), vn.alias("vn"), d0.alias("d0"), s["dist"].alias("dist"), j.alias("j"), vn.bitwiseOR(full.bitwiseXOR(d0.bitwiseOR(vp))).alias("hp"), d0.bitwiseAND(vp).alias("hn"))

    def settle(s: Column) -> Column:
        d0, hp, hn, j = s["d0"], s["hp"], s["hn"], s["j"]
        full = F.lit(mask).cast("long")
        half = F.shiftright(d0, 1)
        at = F.greatest(F.lit(1), F.least(F.lit(width), F.lit(top) - (j - (m - edits) - 1))).cast("int")
        bit = F.element_at(F.array(*[F.lit(1 << t).cast("long") for t in range(width)]), at)
        along = (hp.bitwiseAND(bit) != 0).cast("int") - (hn.bitwiseAND(bit) != 0).cast("int")
        dist = s["dist"] + F.when(j <= m - edits, (d0.bitwiseAND(F.lit(1 << top).cast("long")) == 0).cast("int")).otherwise(along)
        return F.struct(hn.bitwiseOR(full.bitwiseXOR(half.bitwiseOR(hp))).alias("vp"), half.bitwiseAND(hp).alias("vn"), dist.alias("dist"))

    def move(s: Column, j: Column) -> Column:
        done = F.transform(F.transform(F.array(step(s, j)), advance), settle)[0]
        return F.when(s["dist"] > lost, s).otherwise(done)

    first = F.lit(mask - ((1 << (top - edits)) - 1)).cast("long")
    begin = F.struct(first.alias("vp"), low.alias("vn"), F.lit(edits).alias("dist"))
    return F.aggregate(F.sequence(F.lit(1), n), begin, move, lambda s: s["dist"] <= edits)


def _alike(a: Column, b: Column, edits: int) -> Column:
    """A cheap necessary condition: all but ``edits`` of EIGHTHS blocks of a recur in b within ``edits`` places."""
    size = F.floor(F.length(a) / EIGHTHS).cast("int")
    found = F.lit(0)
    for t in range(EIGHTHS):
        place = size * t + 1
        low = F.greatest(F.lit(1), place - edits)
        found = found + F.contains(F.substring(b, low, place - low + size + edits), F.substring(a, place, size)).cast("int")
    return found >= EIGHTHS - edits


def parity(form: Column) -> Column:
    """A bit for each class of characters: whether their number is odd.  An edit flips two bits at most."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c) % 64)
    return F.aggregate(F.split(form, ""), F.lit(0).cast("long"), lambda bits, c: bits.bitwiseXOR(bit(c)))


def _place() -> Column:
    """A number that orders lines by (doc_id, nulls last, number of the line)."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
    return (doc * F.lit(str(PLACES)).cast("decimal(10,0)") + F.col("pos").cast("decimal(10,0)")).cast("decimal(32,0)")


def _decode(place: Column) -> tuple[Column, Column]:
    """(doc_id, number of the line) of a place."""
    doc = F.floor(place / F.lit(str(PLACES)).cast("decimal(10,0)")).cast("decimal(20,0)")
    pos = (place - doc * F.lit(str(PLACES)).cast("decimal(10,0)")).cast("long")
    return F.when(doc < F.lit(str(1 << 63)).cast("decimal(20,0)"), doc.cast("long")), pos


def _earlier(x: Column, y: Column, spot: Column, probe: Column, edits: int) -> Column:
    """Whether two lines that share a key at ``spot`` share one at an earlier spot, under which the pair is looked at.

    ``probe`` tells whether x's key is the probe; if both lines probe at one spot, the smaller id's probe counts.
    """
    all_spots = spots(edits)
    short = x["n"] <= y["n"]  # its class is that of the pair
    least, size = F.when(short, x["least"]).otherwise(y["least"]), F.when(short, x["size"]).otherwise(y["size"])

    def hit(k: int, a: Column, b: Column) -> Column:
        """b's text at spot k is a's segment."""
        return _piece(a["form"], a["n"], least, size, (all_spots[k][0], 0), edits) == _piece(b["form"], b["n"], least, size, all_spots[k], edits)

    out = F.lit(False)
    for k, (_, shift) in enumerate(all_spots):
        before = F.lit(False)
        for j in range(k):
            before = before | hit(j, x, y)
            if all_spots[j][1]:
                before = before | hit(j, y, x)
        if shift:
            before = before | F.when(x["id"] < y["id"], ~probe & hit(k, y, x)).otherwise(probe & hit(k, x, y))
        out = F.when(spot == k, before).otherwise(out)
    return out


def _linked(x: Column, y: Column, edits: int, share: float | None) -> Column:
    """Whether two entries of a key are a link that counts here: ``edits`` apart at most, and ``share`` of the shorter line."""
    first_of = F.array(*[F.lit(s == 0) for _, s in spots(edits)])
    index = lambda e: F.element_at(first_of, e["spot"] + 1)
    fits = (F.bit_count(x["odd"].bitwiseXOR(y["odd"])) <= 2 * edits) & (F.abs(x["n"] - y["n"]) <= edits) & (x["home"] | y["home"]) & (index(x) | index(y)) & (x["id"] != y["id"])
    alike = F.when(fits, _alike(x["form"], y["form"], edits))
    here = F.when(alike, ~_earlier(x, y, F.greatest(x["spot"], y["spot"]), ~index(x), edits))
    if share is None:
        return F.when(here, within(x["form"], y["form"], edits))
    near, apart = F.lit(False), F.abs(x["n"] - y["n"])
    for most in range(1, edits + 1):  # the greatest number that the share allows is tried
        allowed = F.least(x["n"], y["n"]) * share >= most
        near = F.when(allowed, (apart <= most) & within(x["form"], y["form"], most)).otherwise(near)
    return F.when(here, near)


#: Added to the numbers of a second block's rows, so that they differ from the first one's.
_SECOND = 1 << 20


def _summary(left: Column, right: Column, edges: Column) -> Column:
    """(id, links, to) of the linked rows of a pair of blocks, from each left row's partners: ``to`` spans a forest."""
    sets = F.aggregate(
        edges,
        F.array().cast("array<array<int>>"),
        lambda done, e: F.transform(
            F.array(F.array_append(e["partners"], e["row"])),
            lambda m: F.array_append(
                F.filter(done, lambda s: ~F.arrays_overlap(s, m)),
                F.array_distinct(F.concat(m, F.flatten(F.filter(done, lambda s: F.arrays_overlap(s, m))))),
            ),
        )[0],
    )
    name = lambda v: F.when(v >= _SECOND, F.get(right, v - _SECOND)["id"]).otherwise(F.get(left, v)["id"])

    def links(v: Column) -> Column:
        return F.aggregate(edges, F.lit(0).cast("long"), lambda n, e: n + F.when(e["row"] == v, F.size(e["partners"])).otherwise(F.array_contains(e["partners"], v).cast("int")))

    return F.flatten(F.transform(sets, lambda s: F.transform(s, lambda v: F.struct(name(v).alias("id"), links(v).alias("links"), name(F.array_min(s)).alias("to")))))


def links(scratch: Scratch, docs: DataFrame, lines: DataFrame, edits: int, share: float | None = None) -> DataFrame:
    """(id, links, to): how many other forms a line links to, in parts to be summed, and the edges of a forest.

    ``lines`` has a row for each form: id, line (a 64-bit hash of the form, by which lines are dealt) and the columns of ``keys``.
    """
    names = [c for c in lines.columns if c[0] in "hg" and c[1:].isdigit()]
    stacked = F.stack(F.lit(len(names)), *[x for c in names for x in (F.col(c), F.lit(int(c[1:])), F.lit(c[0] == "h"))])
    entries = lines.select("line", stacked.alias("key", "spot", "home")).where("key is not null")
    index = [k for k, (_, s) in enumerate(spots(edits)) if s == 0]
    met = entries.groupBy("key").agg(F.count("*").alias("m"), F.max("home").alias("any_home"), F.max(F.col("spot").isin(index)).alias("any_index"))
    met = scratch.cut(met.where((F.col("m") > 1) & F.col("any_home") & F.col("any_index")).select("key", "m"), "keys", hashes=True)
    met = scratch.cut(entries.join(met.hint("merge"), "key"), "met", hashes=True)
    # The forms of the lines that met another.
    forms = maybe_in(formed(docs).select("form", F.xxhash64("form").alias("line")), "line", met.select("line"))
    texts = forms.withColumn("id", F.unhex(F.md5("form"))).groupBy("line", "id").agg(F.first("form").alias("form"))
    texts = texts.withColumn("n", F.length("form")).withColumn("least", _class(F.col("n"), edits)).withColumn("size", _size(F.col("least"), edits)).withColumn("odd", parity(F.col("form")))
    texts = scratch.cut(texts, "texts")
    met = block_pairs(met, "key", "line", "m", BLOCK).join(texts.hint("merge"), "line")
    # As many tasks as the session has, for the work is in the pairs, not in the bytes by which tasks are merged.
    met = met.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "block_i", "block_j")
    groups = met.groupBy("key", "block_i", "block_j").agg(F.collect_list(F.struct("block", "spot", "home", "id", "n", "least", "size", "odd", "form")).alias("rows"))
    part = lambda c: F.filter("rows", lambda r: r["block"] == F.col(c))
    own = F.col("block_i") == F.col("block_j")
    groups = groups.select(own.alias("own"), part("block_i").alias("left"), part("block_j").alias("right"))
    left, right, own = F.col("left"), F.col("right"), F.col("own")

    def partners(x: Column) -> Column:
        number = lambda y, k: F.when((~own | (x["id"] < y["id"])) & _linked(x, y, edits, share), k + F.when(own, 0).otherwise(_SECOND))
        return F.array_compact(F.transform(right, number))

    edges = F.filter(F.transform(left, lambda x, k: F.struct(k.alias("row"), partners(x).alias("partners"))), lambda e: F.size(e["partners"]) > 0)
    found = groups.select(F.explode(F.flatten(F.transform(F.array(edges), lambda e: _summary(left, right, e)))).alias("link"))
    return scratch.cut(found.select("link.*"), "links")


def judge(docs: DataFrame, edits: int = EDITS, share: float | None = None) -> tuple[Scratch, DataFrame]:
    """(doc_id, place, keeper, links) for each line that has a copy or a link: ``keeper`` is the place of its class's kept line.

    With ``share`` lines link only if the edits are no more than that share of the shorter one's characters.
    """
    if edits not in (1, 2, 3):
        raise ValueError("edits must be 1, 2 or 3")
    scratch = Scratch(docs.sparkSession)
    spots = keys(formed(docs).select("doc_id", "pos", "form", F.unhex(F.md5("form")).alias("id"), F.xxhash64("form").alias("line")), edits)
    spots = scratch.cut(spots.drop("form"), "spots", hashes=True)
    # Buffers of fixed width only, so that this is a hash aggregation.
    of_form = [F.max(c).alias(c) for c in spots.columns if c not in ("doc_id", "pos", "id")]
    lines = scratch.cut(spots.groupBy("id").agg(F.count("*").alias("n"), F.min(_place()).alias("first"), *of_form), "lines", hashes=True)
    linked = links(scratch, docs, lines, edits, share)
    classes = components(scratch, linked.select(F.col("id").alias("a"), F.col("to").alias("b")))
    degree = linked.groupBy("id").agg(F.sum("links").alias("links"))
    in_class = classes.withColumnRenamed("node", "id").join(lines.select("id", "first"), "id").join(degree, "id")
    in_class = scratch.cut(in_class, "in_class")
    keeper = in_class.groupBy("component").agg(F.min("first").alias("keeper"))
    joined = in_class.join(keeper, "component").select("id", "keeper", "links")
    copies = lines.where("n > 1").select("id", F.col("first").alias("own"))
    known = copies.join(joined, "id", "full").select("id", F.coalesce("keeper", "own").alias("keeper"), F.coalesce("links", F.lit(0)).alias("links"))
    known = scratch.cut(known, "known")
    scratch.drop("lines", "keys", "met", "texts", "links", "components", "in_class")
    return scratch, spots.select("doc_id", _place().alias("place"), "id").join(known.hint("merge"), "id").select("doc_id", "place", "keeper", "links")


def report(docs: DataFrame, edits: int = EDITS, share: float | None = None) -> DataFrame:
    """For each row: doc_id, n_lines, n_links (links of its lines to other line forms), removed (places), kept_by (doc_id for each)."""
    scratch, spots = judge(docs, edits, share)
    gone = F.when(F.col("place") != F.col("keeper"), F.struct(_decode(F.col("place"))[1].alias("pos"), _decode(F.col("keeper"))[0].alias("doc_id")))
    per = spots.groupBy("doc_id").agg(F.sum("links").alias("links"), F.array_sort(F.collect_set(gone)).alias("gone"))
    per = scratch.cut(per.withColumnRenamed("doc_id", "id"), "per")
    scratch.drop("spots", "known")
    out = docs.select("doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
    out = out.join(per.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id")), "left")
    gone = F.coalesce("gone", F.array().cast("array<struct<pos:bigint,doc_id:bigint>>"))
    return out.select(
        "doc_id", "n_lines", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.size(gone).cast("long").alias("n_removed"),
        F.transform(gone, lambda g: g["pos"]).alias("removed"), F.transform(gone, lambda g: g["doc_id"]).alias("kept_by"),
    )


def remove(docs: DataFrame, edits: int = EDITS, share: float | None = None) -> DataFrame:
    """The rows of ``docs`` without the removed lines; a document that had lines and keeps none with content goes."""
    scratch, spots = judge(docs, edits, share)
    gone = spots.where(F.col("place") != F.col("keeper")).select("doc_id", _decode(F.col("place"))[1].alias("pos"))
    per = scratch.cut(gone.groupBy("doc_id").agg(F.collect_set("pos").alias("__gone")).withColumnRenamed("doc_id", "__id"), "per")
    scratch.drop("spots", "known")
    joined = docs.join(per.hint("merge"), F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__gone", i.cast("long"))), "\n")
    touched = F.col("__gone").isNotNull()
    joined = joined.withColumn("text", F.when(touched, left).otherwise(F.col("text"))).where(~touched | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(touched, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
