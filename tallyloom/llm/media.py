"""Media columns: ISO media containers.

A container is a tree of boxes (32-bit size, four-letter type, body).  The writer stores a payload losslessly as 8-bit
samples; the reader walks nested boxes, decodes the sample tables (stts, stsc, stsz, stco or co64, stss) and returns
codec, duration and the byte ranges of the keyframes without decoding the payload.  Each track's tables are its own; a
container whose samples lie in movie fragments is refused, for its tables are elsewhere.

Defined results: a null text is an empty one, an empty payload is padded to 64 zero bytes, equal texts give equal
containers (ties and repeated rows alike), a very long text is stored whole (64-bit sizes and offsets past 4 GB), other
columns of the input are kept out of the result, an empty table gives an empty table, and bytes that are no container
raise ValueError.  A track without samples has no ranges and no keyframes; one without a sync table has all samples as
keyframes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

UNIT = 64  #: bytes a frame (a sample in the container's sense)
FRAMES_PER_CHUNK = 256
KEY_EVERY = 16
TIMESCALE = 8000
CODEC = b"raw "  #: unsigned 8-bit samples
#: Boxes that hold boxes.
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta"}


def pad(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of UNIT."""
    return data + b"\0" * ((-len(data)) % UNIT or (0 if data else UNIT))


def _box(kind: bytes, *body: bytes) -> bytes:
    size = 8 + sum(map(len, body))
    head = struct.pack(">I4s", size, kind) if size < 1 << 32 else struct.pack(">I4sQ", 1, kind, size + 8)
    return b"".join((head, *body))


def _full(kind: bytes, *body: bytes) -> bytes:
    return _box(kind, b"\0\0\0\0", *body)


def encode(payload: bytes) -> bytes:
    """A container with one track whose frames are the payload's runs of UNIT bytes."""
    if not payload or len(payload) % UNIT:
        raise ValueError(f"the payload must be a positive multiple of {UNIT} bytes")
    frames = len(payload) // UNIT
    chunks = -(-frames // FRAMES_PER_CHUNK)
    last = frames - (chunks - 1) * FRAMES_PER_CHUNK
    ticks = frames * UNIT
    keys = range(1, frames + 1, KEY_EVERY)
    runs = [(1, FRAMES_PER_CHUNK if chunks > 1 else last, 1)] + ([(chunks, last, 1)] if chunks > 1 and last != FRAMES_PER_CHUNK else [])
    entry = _box(CODEC, b"\0" * 6, struct.pack(">H8xHHHHI", 1, 1, 8, 0, 0, TIMESCALE << 16))
    ftyp = _box(b"ftyp", b"qt  ", struct.pack(">I", 0), b"qt  ")

    def moov(base: int) -> bytes:
        offsets = [base + i * FRAMES_PER_CHUNK * UNIT for i in range(chunks)]
        wide = offsets[-1] >= 1 << 32
        table = _full(b"co64" if wide else b"stco", struct.pack(f">I{chunks}{'Q' if wide else 'I'}", chunks, *offsets))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, frames, UNIT)),
            _full(b"stsc", struct.pack(">I", len(runs)), b"".join(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", UNIT, frames)),
            table,
            _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
        )
        mdia = _box(
            b"mdia",
            _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, ticks & 0xFFFFFFFF, 0, 0)),
            _full(b"hdlr", b"mhlrsoun", b"\0" * 12, b"\0"),
            _box(b"minf", _full(b"smhd", b"\0" * 4), stbl),
        )
        return _box(b"moov", _full(b"mvhd", struct.pack(">IIII", 0, 0, TIMESCALE, ticks & 0xFFFFFFFF), b"\0" * 80), _box(b"trak", mdia))

    wide = len(payload) + 8 >= 1 << 32
    base = len(ftyp) + len(moov(1 << 33 if wide else 0)) + (16 if wide else 8)
    return b"".join((ftyp, moov(base), _box(b"mdat", payload)))


def walk(data: memoryview, begin: int, end: int, path: str = "") -> Iterator[tuple[str, int, int]]:
    """(path, begin, end) of the body of each box, depth first."""
    while begin + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, begin)
        head = 8
        if size == 1:
            if begin + 16 > end:
                raise ValueError("a box header is cut off")
            (size,) = struct.unpack_from(">Q", data, begin + 8)
            head = 16
        elif size == 0:
            size = end - begin
        if size < head or begin + size > end:
            raise ValueError(f"box {kind!r} at {begin} leaves its parent")
        here = f"{path}/{kind.decode('latin-1')}"
        yield here, begin + head, begin + size
        if kind in NESTED:
            yield from walk(data, begin + head, begin + size, here)
        begin += size
    if begin != end:
        raise ValueError("bytes after the last box")


@dataclass(frozen=True)
class Track:
    codec: str
    timescale: int
    duration: int
    frames: int
    ranges: list[tuple[int, int]]  #: (offset, size) of each chunk
    keyframes: list[tuple[int, int]]  #: (offset, size) of each sync sample


STBL = "/moov/trak/mdia/minf/stbl/"


def parse(media: bytes) -> Track:
    """The first track's tables; offsets are checked against the container."""
    tracks = parse_all(media)
    if not tracks:
        raise ValueError("no track")
    return tracks[0]


def parse_all(media: bytes) -> list[Track]:
    """Each track's tables, in the container's order."""
    data = memoryview(media)
    per_track: list[dict[str, tuple[int, int]]] = []
    for path, begin, end in walk(data, 0, len(data)):
        if path == "/moof":
            raise ValueError("movie fragments are not read")
        if path == "/moov/trak":
            per_track.append({})
        elif path.startswith("/moov/trak/"):
            per_track[-1].setdefault(path, (begin, end))
    return [_track(data, boxes) for boxes in per_track]


def _track(data: memoryview, boxes: dict[str, tuple[int, int]]) -> Track:
    def read(path: str, at: int, n: int = 1, code: str = "I") -> tuple[int, ...]:
        if path not in boxes:
            raise ValueError(f"no box {path}")
        begin, end = boxes[path]
        if begin + at + struct.calcsize(f">{n}{code}") > end:
            raise ValueError(f"box {path} is cut off")
        return struct.unpack_from(f">{n}{code}", data, begin + at)

    mdhd = "/moov/trak/mdia/mdhd"
    (version,) = read(mdhd, 0, 1, "B")
    (timescale,) = read(mdhd, 20 if version else 12)
    codec = struct.pack(">I", *read(STBL + "stsd", 12)).decode("latin-1")
    (runs,) = read(STBL + "stts", 4)
    steps = read(STBL + "stts", 8, 2 * runs)
    duration = sum(n * d for n, d in zip(steps[::2], steps[1::2]))
    fixed, frames = read(STBL + "stsz", 4, 2)
    sizes = None if fixed else read(STBL + "stsz", 12, frames)
    name, code = (STBL + "co64", "Q") if STBL + "co64" in boxes else (STBL + "stco", "I")
    (chunks,) = read(name, 4)
    offsets = read(name, 8, chunks, code)
    (runs,) = read(STBL + "stsc", 4)
    flat = read(STBL + "stsc", 8, 3 * runs)
    firsts = [*flat[::3], chunks + 1]
    if runs and (firsts[0] != 1 or any(x >= y for x, y in zip(firsts, firsts[1:]))):
        raise ValueError("the runs of chunks are out of order")
    if STBL + "stss" in boxes:
        (n,) = read(STBL + "stss", 4)
        keys = iter(read(STBL + "stss", 8, n))
    else:
        keys = iter(range(1, frames + 1))
    key = next(keys, 0)
    ranges, keyframes, frame = [], [], 1
    for run in range(runs):
        for chunk in range(firsts[run], firsts[run + 1]):
            at = start = offsets[chunk - 1]
            count = flat[3 * run + 1]
            if frame + count > frames + 1:
                raise ValueError("the sample tables disagree")
            if sizes is None:
                while key and key < frame + count:
                    keyframes.append((start + (key - frame) * fixed, fixed))
                    key = next(keys, 0)
                at += count * fixed
                frame += count
            else:
                for _ in range(count):
                    if key == frame:
                        keyframes.append((at, sizes[frame - 1]))
                        key = next(keys, 0)
                    at += sizes[frame - 1]
                    frame += 1
            if at > len(data):
                raise ValueError("a chunk leaves the container")
            ranges.append((start, at - start))
    if frame != frames + 1:
        raise ValueError("the sample tables disagree")
    return Track(codec, timescale, duration, frames, ranges, keyframes)


def payload_of(media: bytes, track: Track) -> bytes:
    """The stored bytes, chunk by chunk."""
    return b"".join(media[o : o + n] for o, n in track.ranges)


def feature(track: Track) -> str:
    """codec, duration and keyframe ranges in one line: count, first and last range, crc32 of them all."""
    packed = b"".join(struct.pack(">QQ", *r) for r in track.keyframes)
    ends = [f"{o}+{n}" for o, n in (track.keyframes[:1] + track.keyframes[-1:])] or ["", ""]
    return (
        f"codec={track.codec.strip()};timescale={track.timescale};duration={track.duration};frames={track.frames};"
        f"keyframes={len(track.keyframes)};first={ends[0]};last={ends[1]};ranges_crc32={zlib.crc32(packed)}"
    )


SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, codec string, duration double, keyframes array<struct<offset:long,size:long>>"
)


def media_columns(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """Store each text in a container, read it back from its tables and describe it.

    codec, duration (in seconds) and keyframes (byte ranges in the container) are columns of their own; ``keep_media``
    adds the container.  One pass without a shuffle; memory holds the described rows of one batch.
    """
    schema = SCHEMA + (", media binary" if keep_media else "")
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                media = encode(pad(data))
                track = parse(media)
                payload = payload_of(media, track)
                row = [
                    doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]),
                    len(media), hashlib.sha256(media).hexdigest(), feature(track), track.codec.strip(), track.duration / track.timescale,
                    [{"offset": o, "size": n} for o, n in track.keyframes],
                ]
                rows.append(row + ([media] if keep_media else []))
            columns = zip(*rows) if rows else [[] for _ in out]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
