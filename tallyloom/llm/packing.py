"""Best-fit packing of tokenised documents into sequences, by hierarchical residual packing.

Texts become ids with a public tokenizer.  It cuts texts into words before it encodes them, so the ids of a text are
those of its words in a row; each worker keeps the ids of words it has met.

Packing goes by rounds.  In a round each partition packs its items best-fit in order of falling length; bins that are
nearly full, or into which nothing that is left would fit, are emitted; the others go on as items of the next round,
over fewer partitions, where best-fit merges them, until one partition holds what a tree of rounds could not fill.

Defined results: a null text is an empty one and has the end id alone; repeated rows are packed as often as they occur
(each with its own place); only documents over ``capacity`` are cut; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, give_back, utf8_view
from .ngrams import slices

CAPACITY = 4096
END_ID = 1
#: A bin with no more room than this is emitted.
NEARLY_FULL = 8
#: Rows that a partition of a round gets, about.
ROWS_A_PARTITION = 20_000
#: A round that leaves more than this share of its bins to the next one is not worth repeating.
STUCK = 0.9
#: Words whose ids a worker keeps; when there are more, it begins anew.
KEPT_WORDS = 200_000
#: Bytes of text that are cut into words together.
SLICE = 1 << 21

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Stands between words that are encoded together; its ids are looked up.
_BAR = "\u2603"

# Classes of bytes: the tokenizer cuts a text into runs of letters, single digits and runs of anything else but white
# space.  Bytes of other characters than ASCII count as letters until they are looked at as characters.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[32, 9, 10, 11, 12, 13]] = _SPACE
_CLASS[128:] = _LETTER
_CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def cut_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of lower-cased bytes; ``bounds`` are places where texts begin, which no word crosses.

    What follows an apostrophe that begins a run, and is one of s, t, m, d, re, ve or ll, is one word with it.
    """
    kind = _CLASS[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    edge[len(data)] = True
    fresh |= edge[:-1]
    marks = np.flatnonzero((data == 39) & fresh)
    marks = marks[~edge[marks + 1]]
    if len(marks):
        after = data[marks + 1]
        two = np.where(marks + 2 < len(data), data[np.minimum(marks + 2, len(data) - 1)], 0)
        two[edge[np.minimum(marks + 2, len(data))]] = 0
        one = np.isin(after, np.frombuffer(b"stmd", np.uint8))
        pair = ((after == ord("r")) | (after == ord("v"))) & (two == ord("e")) | (after == ord("l")) & (two == ord("l"))
        for hit, n in ((marks[one], 1), (marks[pair], 2)):
            fresh[hit + 1] = False
            rest = hit + 1 + n
            rest = rest[rest < len(data)]
            fresh[rest] = True  # what is left of the run is a word of its own
    black = kind != _SPACE
    starts = np.flatnonzero(fresh & black)
    last = black.copy()
    last[:-1] &= fresh[1:] | ~black[1:]
    last[:-1] |= black[:-1] & edge[1:-1]
    return starts, np.flatnonzero(last) + 1


class Ids:
    """Unsigned 32-bit ids of texts, end id included.

    Texts are cut into words by steps over all their bytes at once; each different word is encoded once and its ids are
    kept.  Words of ASCII letters, digits and signs need neither normalising nor cutting and go by a copy of the
    tokenizer without these; so do words of other letters, normalised here.  White-space separated chunks that hold
    anything else, or what may be a special token, go through the whole tokenizer as they are.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.lean = Tokenizer.from_file(path)
        self.lean.normalizer = None
        self.lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.end_id = end_id
        self.bar = self.encode(_BAR)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.uint32)

    def together(self, words: list[str]) -> list[np.ndarray]:
        """The ids of words, encoded many at once with bars between, which spares most of a call's cost."""
        out, width = [], len(self.bar)
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            ids = np.array(self.lean.encode_batch_fast([f" {_BAR} ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            hit = np.ones(max(0, len(ids) - width + 1), bool)
            for k in range(width):
                hit &= ids[k : len(ids) - width + 1 + k] == self.bar[k]
            bars = np.flatnonzero(hit)
            if len(bars) != len(part) - 1:  # a word's own ids look like a bar
                out += [np.array(self.lean.encode(w, add_special_tokens=False).ids, np.uint32) for w in part]
                continue
            begin = np.concatenate([[0], bars + width])
            out += [ids[b:e] for b, e in zip(begin.tolist(), [*bars.tolist(), len(ids)])]
        return out

    def learn(self, words: list[str]) -> np.ndarray:
        """The number of each word, under which its ids are kept."""
        get = self.known.get
        numbers = [get(w, -1) for w in words]
        new = list(dict.fromkeys(w for w, k in zip(words, numbers) if k < 0))
        if new:
            ids = self.together(new)
            first = len(self.known)
            self.known.update(zip(new, range(first, first + len(new))))
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, *ids])
            numbers = [self.known[w] for w in words]
        return np.array(numbers, np.int64)

    def of(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's end): texts are slices of UTF-8 bytes that follow each other."""
        if len(self.known) > KEPT_WORDS:
            self.forget()
        begin, stop = int(starts[0]), int(ends[-1])
        sizes = ends - starts
        source = raw[begin:stop] if stop - begin == int(sizes.sum()) else np.concatenate([raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())])
        first = np.cumsum(sizes) - sizes
        data = _LOWER[source]
        w_start, w_end = cut_words(data, first[first < len(data)]) if len(data) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        black = _CLASS[data] != _SPACE
        size = w_end - w_start
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[black]))])
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        distinct = [w.decode("utf-8", "replace") for w in coded.dictionary.to_pylist()]
        plain, odd = [], np.zeros(len(distinct), bool)
        for k, w in enumerate(distinct):
            if not w.isascii():
                w, odd[k] = self.normal(w)
            plain.append(w)
        numbers = self.learn(plain)
        flat, start, length = self.flat, self.start, self.size
        number = numbers[code] if len(code) else code
        whole = odd[code] if len(code) else np.zeros(0, bool)
        special = np.flatnonzero((data[:-1] == 60) & (data[1:] == 124)) if len(data) else np.zeros(0, np.int64)
        if whole.any() or len(special):
            # The chunks (texts' runs without white space) that hold such words go through the whole tokenizer.
            opens = black.copy()
            opens[1:] &= ~black[:-1]
            opens[first[first < len(data)]] = black[first[first < len(data)]]
            chunk_of = np.cumsum(opens) - 1
            bad = np.unique(np.concatenate([chunk_of[w_start[whole]], chunk_of[special]]))
            chunk_start = np.flatnonzero(opens)
            begins = chunk_start[bad]
            limit = np.append(chunk_start, len(data))[bad + 1]
            texts = [source[s:e].tobytes().rstrip(b" \t\n\x0b\x0c\r").decode("utf-8", "replace") for s, e in zip(begins.tolist(), limit.tolist())]
            ids = [self.encode(t) for t in texts]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            start = np.concatenate([start, len(flat) + np.cumsum(n) - n])
            flat, length = np.concatenate([flat, *ids]), np.concatenate([length, n])
            keep = ~np.isin(chunk_of[w_start], bad)
            w_start = np.concatenate([w_start[keep], begins])
            number = np.concatenate([number[keep], len(self.size) + np.arange(len(bad))])
            order = np.argsort(w_start, kind="stable")
            w_start, number = w_start[order], number[order]
        # An end id after each text's words.
        per = np.searchsorted(w_start, first + sizes)
        number = np.insert(number, per, len(start))
        start, length, flat = np.append(start, len(flat)), np.append(length, 1), np.append(flat, np.uint32(self.end_id))
        n = length[number]
        total = np.cumsum(n)
        out = flat[np.repeat(start[number] - (total - n), n) + np.arange(int(total[-1]))]
        return out, total[per + np.arange(len(per))]

    def of_long(self, raw: np.ndarray, begin: int, end: int, size: int = SLICE) -> Iterator[np.ndarray]:
        """The ids of one long text, in parts that end at white space."""
        while begin < end:
            stop = min(end, begin + size)
            if stop < end:
                gaps = np.flatnonzero(_CLASS[raw[begin:stop]] == _SPACE)
                while not len(gaps) and stop < end:
                    stop = min(end, stop + size)
                    gaps = np.flatnonzero(_CLASS[raw[begin:stop]] == _SPACE)
                stop = begin + int(gaps[-1]) + 1 if len(gaps) and stop < end else stop
            ids, _ = self.of(raw, np.array([begin]), np.array([stop]))
            yield ids if stop == end else ids[:-1]
            begin = stop

    @staticmethod
    def normal(word: str) -> tuple[str, bool]:
        """(the word as the tokenizer normalises it, whether that is not certain): certain are words of letters only."""
        low = unicodedata.normalize("NFC", word)
        fine = word.isalpha() and "\u03a3" not in low and "\u03c2" not in low
        low = low.lower()
        return low, not (fine and low.isalpha())


def _worker_ids(path: str, end_id: int) -> Ids:
    """The worker process's own store, which later tasks in it use on."""
    import sys
    import types

    store = sys.modules.setdefault("_tallyloom_worker", types.ModuleType("_tallyloom_worker")).__dict__
    if ("ids", path, end_id) not in store:
        store["ids", path, end_id] = Ids(path, end_id)
    return store["ids", path, end_id]


def tokenise(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: (doc_id, piece, start, length, ids_crc32)."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _worker_ids(path, end_id)
        for batch in batches:
            raw, starts, ends = utf8_view(batch.column(1))
            doc_id = batch.column(0)
            for lo, hi in slices(starts, ends, SLICE):
                rows, at = [], 0
                if ends[lo] - starts[lo] > SLICE:  # a text of its own; its words' ids come part by part
                    data = np.concatenate(list(ids.of_long(raw, int(starts[lo]), int(ends[lo]))))
                    texts_end = [len(data)]
                else:
                    data, texts_end = ids.of(raw, starts[lo:hi], ends[lo:hi])
                    texts_end = texts_end.tolist()
                data = data.astype("<u4", copy=False)
                for i, end in enumerate(texts_end):
                    for k, begin in enumerate(range(at, end, capacity)):
                        cut = data[begin : min(end, begin + capacity)]
                        rows.append((lo + i, k, begin - at, len(cut), zlib.crc32(cut)))
                    at = end
                which, *columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [doc_id.take(pa.array(which)).cast(pa.int64()), *[pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )
        ids.forget()  # a worker that waits for other tasks keeps the tokenizer alone
        give_back()

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of positions): each item, longest first, goes to the fullest bin that has room."""
    rooms: list[int] = []  # sorted distinct rooms, and the bins that have each
    at: dict[int, list[int]] = {}
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        k = bisect.bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = at[room].pop()
            if not at[room]:
                del at[room], rooms[k]
            bins[b].append(i)
            room -= n
        else:
            b, room = len(bins), capacity - n
            bins.append([i])
        if room:
            if room in at:
                at[room].append(b)
            else:
                bisect.insort(rooms, room)
                at[room] = [b]
    return bins


_PART = "struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long,offset:long>"
_ITEM = f"fill long, parts array<{_PART}>"


def _round(items: DataFrame, capacity: int) -> DataFrame:
    """(fill, parts): the bins of each partition; a part's ``offset`` is its place in the bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if t is None:
            return
        t = t.combine_chunks()
        fill = t.column("fill").to_numpy()
        parts = t.column("parts").combine_chunks() if t.column("parts").num_chunks != 1 else t.column("parts").chunk(0)
        bins = best_fit(fill, capacity)
        sizes = np.diff(parts.offsets.to_numpy())
        begin = parts.offsets.to_numpy()[:-1]
        for at in range(0, len(bins), 2000):
            some = bins[at : at + 2000]
            order = np.concatenate([np.arange(begin[i], begin[i] + sizes[i]) for b in some for i in b])
            ends = np.cumsum([int(sizes[b].sum()) for b in some])
            values = parts.values.take(pa.array(order))
            length = values.field("length").to_numpy()
            before = np.cumsum(length) - length
            first = np.concatenate([[0], ends[:-1]])
            offset = before - np.repeat(before[first], np.diff(np.concatenate([[0], ends])))
            names = [values.type.field(k).name for k in range(values.type.num_fields)]
            values = pa.StructArray.from_arrays([pa.array(offset) if n == "offset" else values.field(n) for n in names], names=names)
            packed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)
            yield pa.RecordBatch.from_arrays([pa.array([int(fill[b].sum()) for b in some], pa.int64()), packed], names=["fill", "parts"])

    return items.mapInArrow(run, _ITEM)


def pack(docs: DataFrame, capacity: int = CAPACITY, nearly_full: int = NEARLY_FULL, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    After each round those bins are emitted that are nearly full or into which not even the least full one would fit.
    The others are the next round's items, over as many partitions as ``ROWS_A_PARTITION`` asks for, so no task gets
    more than about that many bins.  When a round no longer makes fewer of them (bins over half full of which no two fit together),
    the rest is emitted as it is, but for the bins at most half full, of which each partition has one at most: these
    are few, and go on alone, for any two of them fit together.

    Each round is written, so a lost executor repeats one partition of one round; items are ordered before best-fit,
    so a repeated task gives the same bins.
    """
    scratch = Scratch(docs.sparkSession)
    pieces = scratch.cut(tokenise(docs, path, capacity, end_id), "pieces")
    parts = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32", F.lit(0).cast("long").alias("offset")))
    items = pieces.select(F.col("length").alias("fill"), parts.alias("parts"))
    done, items = [items.where(F.col("fill") >= capacity - nearly_full)], items.where(F.col("fill") < capacity - nearly_full)
    count = items.count()
    while count:
        partitions = -(-count // ROWS_A_PARTITION)
        dealt = items.repartition(partitions, F.xxhash64("parts")) if partitions > 1 else items.coalesce(1)
        key = F.struct("fill", F.col("parts")[0].getField("doc_id"), F.col("parts")[0].getField("piece"), F.col("parts")[0].getField("ids_crc32"))
        bins = scratch.cut(_round(dealt.sortWithinPartitions(key), capacity), "bins")
        if partitions == 1:
            done.append(bins)
            break
        open_bins = F.col("fill") < capacity - nearly_full
        least = bins.where(open_bins).agg(F.min("fill")).first()[0]
        if least is None:
            done.append(bins)
            break
        more = open_bins & (F.col("fill") + least <= capacity)
        was, count = count, bins.where(more).count()
        if count > STUCK * was:
            more = more & (F.col("fill") <= capacity // 2)
            count = bins.where(more).count()
        done.append(bins.where(~more))
        items = bins.where(more)
    bins = done[0]
    for some in done[1:]:
        bins = bins.unionByName(some)
    # First a number for each bin, then its parts: in one step the numbers would be the parts'.
    bins = bins.select("parts", F.monotonically_increasing_id().alias("sequence_id"))
    bins = bins.select("sequence_id", F.explode("parts").alias("p"))
    return bins.select("p.doc_id", "p.piece", "p.start", "p.length", "p.ids_crc32", "sequence_id", "p.offset")
