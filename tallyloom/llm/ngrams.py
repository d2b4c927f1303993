"""N-gram Jaccard join with Bayesian candidate pruning.

A document is the set of its runs of ``WORDS`` words (white-space separated, as written; a shorter text is one run of
all its words).  Documents whose sets have a Jaccard similarity of ``THRESHOLD`` or more are linked.

1. Equal texts become one class (summed before the shuffle); MinHash values are taken of each class.
2. Classes that agree in a band of values meet in a bucket.  Buckets with the same members are one; larger ones are
   split into blocks, each two rows of which meet in one pair of blocks.
3. Pairs are compared value by value, ``STEP`` at a time: with m agreements in n values and a uniform prior the
   posterior of the similarity is Beta(m + 1, n - m + 1); a pair goes once the probability of reaching the threshold is
   below ``TOLERANCE``.  Of what stays, a block gives a spanning forest, not the pairs.
4. Components of these forests are the candidate families.  Each two texts of a family are pruned the same way and the
   rest verified exactly on their sets, in blocks again, which yields each row's number of links and a forest.
5. Components of those are the classes; the smallest doc_id of a class is kept.

Defined results: a null text, or one without words, has no links and is its own class; a row whose doc_id is null has
links only if a row with a doc_id has the same text; equal texts with words always
are linked; repeated rows count as copies; other columns are ignored; an empty table gives an empty table.  Runs are
compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Union, block_pairs, components, map_groups, maybe_in, utf8_view

WORDS = 5
THRESHOLD = 0.8
VALUES = 128
ROWS = 5  #: values of a band: two documents at the threshold share one of the 25 bands with probability 0.99995
STEP = 16
TOLERANCE = 1e-5
BUCKET_BLOCK = 256
TEXT_BLOCK = 512
#: Bytes of text whose runs are hashed at once.
SLICE = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_R_INVERSE = pow(_R, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n + 1, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.full(n, base, np.uint64), out=out[1:])
    return out


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of the runs of words of many texts at once."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.power = self.inverse = _powers(1, 0)

    def runs(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, counts): the runs of each text in a row, and how many there are of each."""
        begin, size = int(starts[0]), ends - starts
        solid = int(ends[-1]) - begin == int(size.sum())
        data = raw[begin : int(ends[-1])] if solid else np.concatenate([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
        first = np.cumsum(size) - size
        n = len(data)
        if n >= len(self.power):
            self.power, self.inverse = _powers(_R, n + n // 2), _powers(_R_INVERSE, n + n // 2)
        black = ~_SPACE[data]
        opens = black.copy()
        opens[1:] &= ~black[:-1]
        edge = first[(size > 0)]
        opens[edge] = black[edge]
        closes = black.copy()  # the last byte of a word: the next is blank, or begins a word of the next text
        closes[:-1] &= ~black[1:] | opens[1:]
        word, last = np.flatnonzero(opens), np.flatnonzero(closes)
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.power[:n])])
            value = _mix((total[last + 1] - total[word]) * self.inverse[word] + (last - word).astype(np.uint64))
        per = np.searchsorted(word, first + size) - np.searchsorted(word, first)
        counts = np.where(per >= self.words, per - self.words + 1, (per > 0).astype(np.int64))
        at = np.repeat(np.cumsum(per) - per, counts) + np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
        here = np.repeat(np.minimum(per, self.words), counts)
        out = np.zeros(len(at), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.words):
                use = here > k
                if use.all():
                    out = _mix(out * np.uint64(31) + value[at + k])
                else:
                    out[use] = _mix(out[use] * np.uint64(31) + value[at[use] + k])
        return out, counts


def slices(starts: np.ndarray, ends: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes, one row at least."""
    at, total = 0, np.cumsum(ends - starts)
    while at < len(starts):
        before = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield at, upto
        at = upto


_A, _B = (np.random.default_rng(11).integers(0, 1 << 32, (2, VALUES)) | np.array([[1], [0]])).astype(np.uint32)


def minhash(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts, VALUES) unsigned 32-bit values; texts without runs have zeros."""
    out = np.zeros((len(counts), VALUES), np.uint32)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    first = (np.cumsum(counts) - counts)[some]
    got = np.empty((VALUES, len(some)), np.uint32)
    buffer = np.empty_like(short)
    for k in range(VALUES):
        np.multiply(short, _A[k], out=buffer)
        buffer += _B[k]
        np.minimum.reduceat(buffer, first, out=got[k])
    out[some] = got.T
    return out


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP, values: int = VALUES) -> dict[int, int]:
    """For each number n of values compared: the fewest agreements m with P(similarity >= threshold | m of n) >= tolerance.

    The posterior Beta(m + 1, n - m + 1) exceeds t with the probability that a binomial of n + 1 draws at t is at most m.
    """
    out = {}
    for n in range(step, values + 1, step):
        at_most, m = 0.0, 0
        while True:
            at_most += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if at_most >= tolerance:
                break
            m += 1
        out[n] = m
    return out


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (positions in ``sig``) that no step drops."""
    same, done = np.zeros(len(a), np.int32), 0
    for n, need in least.items():
        same += (sig[a, done:n] == sig[b, done:n]).sum(axis=1, dtype=np.int32)
        keep = same >= need
        if not keep.all():
            a, b, same = a[keep], b[keep], same[keep]
        done = n
        if not len(a):
            break
    return a, b


def _pairs(left: np.ndarray, right: np.ndarray, own: bool, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of two blocks (each once if they are the same block), some at a time."""
    rows = max(1, most // max(1, len(right)))
    for at in range(0, len(left), rows):
        some = left[at : at + rows]
        a, b = np.repeat(some, len(right)), np.tile(right, len(some))
        if own:
            keep = a < b
            a, b = a[keep], b[keep]
        if len(a):
            yield a, b


def _blocks(key: tuple, t: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    i, j = key[-2:]
    block = t.column("block").to_numpy()
    return np.flatnonzero(block == i), np.flatnonzero(block == j), i == j


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        raw, starts, ends = utf8_view(batch.column(2))
        for lo, hi in slices(starts, ends):
            hashes, counts = hasher.runs(raw, starts[lo:hi], ends[lo:hi])
            sig = minhash(hashes, counts)
            data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * VALUES), hi - lo, [None, pa.py_buffer(np.ascontiguousarray(sig))]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(counts, pa.int64()), data], names=["doc_id", "digest", "runs", "sig"])


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, VALUES)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = VALUES // ROWS
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            sig = _signatures(pa.chunked_array([part.column(1)])).astype(np.uint64)
            rep = part.column(0).to_numpy()
            for k in range(bands):
                key = np.full(len(rep), k + 1, np.uint64)
                with np.errstate(over="ignore"):
                    for c in range(k * ROWS, (k + 1) * ROWS):
                        key = _mix(key * np.uint64(_R) + sig[:, c])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(rep)], names=["key", "rep"])


def _candidates(least: dict[int, int]):
    def run(key: tuple, t: pa.Table) -> dict | None:
        left, right, own = _blocks(key, t)
        sig, rep, sets = _signatures(t.column("sig")), t.column("rep").to_numpy(), Union(len(t))
        for a, b in _pairs(left, right, own):
            sets.join(*prune(sig, a, b, least))
        roots = sets.roots()
        has = np.flatnonzero(roots != np.arange(len(roots)))
        return {"a": rep[has], "b": rep[roots[has]]} if len(has) else None

    return run


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets (sorted distinct hashes)."""
    if len(a) <= 256:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a.tolist(), b.tolist())], np.int64)
    rows, cols = np.unique(a), np.unique(b)
    used = np.union1d(rows, cols)
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    value, where, count = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    shared = count[where] > 1  # a run of one text is in no intersection
    owner, where = owner[shared], where[shared]
    where = np.unique(where, return_inverse=True)[1]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    inter = np.zeros((len(rows), len(cols)), np.float32)
    place = np.searchsorted(used, rows), np.searchsorted(used, cols)
    width = 4096
    for at in range(0, int(where[-1]) + 1 if len(where) else 0, width):
        lo, hi = np.searchsorted(where, [at, at + width])
        dense = np.zeros((len(used), width), np.float32)
        dense[owner[lo:hi], where[lo:hi] - at] = 1
        inter += dense[place[0]] @ dense[place[1]].T
    return inter[np.searchsorted(rows, a), np.searchsorted(cols, b)].astype(np.int64)


def _verify(threshold: float, least: dict[int, int]):
    top, bottom = round(threshold * 1000), 1000

    def run(key: tuple, t: pa.Table) -> dict | None:
        left, right, own = _blocks(key, t)
        raw, starts, ends = utf8_view(t.column("text"))
        rep, n = t.column("rep").to_numpy(), t.column("n").to_numpy()
        hasher, sets, sigs = Hasher(), [], []
        for lo, hi in slices(starts, ends):
            hashes, counts = hasher.runs(raw, starts[lo:hi], ends[lo:hi])
            sigs.append(minhash(hashes, counts))
            sets += [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
        sig, size = np.concatenate(sigs), np.array([len(s) for s in sets])
        links, union = np.zeros(len(rep), np.int64), Union(len(rep))
        for a, b in _pairs(left, right, own):
            fits = np.minimum(size[a], size[b]) * bottom >= np.maximum(size[a], size[b]) * top
            a, b = prune(sig, a[fits], b[fits], least)
            if not len(a):
                continue
            inter = _overlaps(sets, a, b)
            linked = inter * bottom >= (size[a] + size[b] - inter) * top
            a, b = a[linked], b[linked]
            links += np.bincount(a, n[b], len(rep)).astype(np.int64) + np.bincount(b, n[a], len(rep)).astype(np.int64)
            union.join(a, b)
        has = np.flatnonzero(links)
        return {"rep": rep[has], "links": links[has], "to": rep[union.roots()[has]]} if len(has) else None

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links, kept) for each row of ``docs`` (doc_id, text)."""
    scratch, least = Scratch(docs.sparkSession), least_matches(threshold, tolerance)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest"), "text")
    sketches = rows.mapInArrow(_sketch, "doc_id long, digest string, runs long, sig binary").where("runs > 0")
    classes = sketches.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("sig").alias("sig"))
    classes = scratch.cut(classes.where("rep is not null"), "classes")
    # Buckets with two members or more.
    keyed = scratch.cut(classes.select("rep", "sig").mapInArrow(_bands, "key long, rep long"), "keyed", hashes=True)
    # Counted before the shuffle, so a key that very many share is not one task's.
    counts = scratch.cut(keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1"), "counts", hashes=True)
    met = scratch.cut(keyed.join(counts, "key"), "met", hashes=True)
    scratch.drop("keyed", "counts")
    small = met.where(F.col("m") <= BUCKET_BLOCK).groupBy("key").agg(F.array_sort(F.collect_list("rep")).alias("reps")).select("reps").distinct()
    small = small.withColumn("bucket", F.xxhash64("reps")).select("bucket", F.explode("reps").alias("rep"), F.size("reps").cast("long").alias("m"))
    large = met.where(F.col("m") > BUCKET_BLOCK).select(F.col("key").alias("bucket"), "rep", "m")
    members = block_pairs(small.unionByName(large), "bucket", "rep", "m", BUCKET_BLOCK)
    members = members.join(classes.select("rep", "sig"), "rep").select("bucket", "block_i", "block_j", "block", "rep", "sig")
    forest = scratch.cut(map_groups(members, ["bucket", "block_i", "block_j"], _candidates(least), "a long, b long"), "forest")
    families = components(scratch, forest)
    families = families.join(families.groupBy("component").agg(F.count("*").alias("m")), "component")
    families = scratch.cut(families.withColumnRenamed("node", "rep").join(classes.select("rep", "n", "digest"), "rep"), "families")
    # Each text once before the join, so that copies under one id are not shuffled.
    texts = maybe_in(rows, "doc_id", families.select("rep")).dropDuplicates(["doc_id", "digest"])
    texts = texts.select("doc_id", "digest", "text").join(families.withColumnRenamed("digest", "d"), (F.col("doc_id") == F.col("rep")) & (F.col("digest") == F.col("d")))
    texts = texts.select("component", "rep", "n", "m", "text")
    texts = block_pairs(texts, "component", "rep", "m", TEXT_BLOCK)
    linked = scratch.cut(map_groups(texts, ["component", "block_i", "block_j"], _verify(threshold, least), "rep long, links long, to long"), "linked")
    links = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(scratch, linked.select(F.col("rep").alias("a"), F.col("to").alias("b")), "groups").withColumnRenamed("node", "rep")
    found = classes.select("digest", "rep", "n").join(links.join(groups, "rep"), "rep", "left")
    found = found.select("digest", F.coalesce("component", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    found = scratch.cut(found, "found")
    scratch.drop("met", "forest", "components", "families", "classes", "linked", "groups")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("digest")).join(found, "digest", "left")
    group = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", group.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("doc_id").eqNullSafe(group).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class: the first by doc_id (nulls last), then digest; of rows equal in both, any one.

    Classes are those of the texts, not of the ids: a text's node is its 64-bit hash, so texts that share a doc_id, or
    have none, are judged each for itself.  Texts without a word are in no class, and all their rows stay.
    """
    scratch, text = Scratch(docs.sparkSession), F.xxhash64("text")
    nodes = near_duplicates(docs.select(text.alias("doc_id"), "text"), threshold).where("n_links > 0")
    nodes = scratch.cut(nodes.select(F.col("doc_id").alias("__node"), F.col("class_id").alias("__class")).distinct(), "nodes")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.md5("text").alias("digest"))
    rows = docs.select(text.alias("__node"), place.alias("place")).groupBy("__node", "place").agg(F.count("*").alias("n")).join(nodes, "__node")
    first = rows.groupBy("__class").agg(F.min(F.struct("place", "n")).alias("__first"))
    known = scratch.cut(nodes.join(first, "__class"), "known")
    joined = docs.withColumn("__node", text).join(known, "__node", "left")
    is_first = F.col("__first").isNotNull() & place.eqNullSafe(F.col("__first.place"))
    stays = joined.where(F.col("__first").isNull() | (is_first & (F.col("__first.n") == 1))).select(*docs.columns)
    # Rows that repeat the first one's id and text: few, so that only they are shuffled.
    again = known.where("__first.n > 1")
    again = maybe_in(docs.withColumn("__node", text), "__node", again.select("__node")).join(again, "__node").where(is_first)
    again = again.groupBy("__class").agg(F.first(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return stays.unionByName(again)
