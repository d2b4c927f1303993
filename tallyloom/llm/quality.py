"""Quality classifier: a byte-level convolutional network in numpy.

Bytes become small vectors; learned filters answer at each ``STRIDE`` of the text, over two strides of bytes.  Chunks of
``CHUNK`` answers, half a chunk apart, cover the whole text; in each a filter keeps its greatest answer.  A second row
of learned units sees all filters' answers in a chunk and how full it is, so that a chunk that says little (one word
over and over) can be told from a varied one.  Filters and units keep their greatest answer over all chunks; these are
combined into one probability.  Long texts go through in slices of whole half chunks, which give the same chunks.

Training uses a bounded sample of labelled rows (``SAMPLE_ROWS``, in the order of a hash of the id); scoring is one
pass over all rows without a shuffle.

Defined results: null and empty texts are scored as one chunk of padding; without labelled rows every score is 0.5;
with labels of one value the score is that value; repeated label rows each count; a null label is no label; other
columns are ignored; a very long text is scored whole; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import utf8_view

SAMPLE_ROWS = 4000
STRIDE = 8
DIM = 6
FILTERS = 24
#: Answers of half a chunk.
HALF = 16
CHUNK = 2 * HALF
UNITS = 12
EPOCHS = 12
PAD = 256
#: Bytes that are convolved at once, a multiple of STRIDE * HALF.
SLICE = 1 << 21

WEIGHTS = ("embed", "first", "second", "bias", "unit", "unit_bias", "weight", "unit_weight")


@dataclass
class Model:
    embed: np.ndarray  #: (257, DIM)
    first: np.ndarray  #: (STRIDE * DIM, FILTERS), a filter's first stride
    second: np.ndarray  #: its second one
    bias: np.ndarray  #: (FILTERS,)
    unit: np.ndarray  #: (FILTERS + 1, UNITS): a chunk's answers and its fill
    unit_bias: np.ndarray  #: (UNITS,)
    weight: np.ndarray  #: (FILTERS,)
    unit_weight: np.ndarray  #: (UNITS,)
    offset: float
    constant: float | None = None  #: what every row scores if there was nothing to learn


def _layout(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, valid, halves, answers) of texts: padded to whole half chunks with a stride of padding at least after each.

    ``valid`` tells which answers belong to a text, ``halves`` how many half chunks each text has in the layout, and
    ``answers`` how many answers.
    """
    answers = np.maximum(1, -(-(ends - starts) // STRIDE))
    halves = answers // HALF + 1
    begin = np.concatenate([[0], np.cumsum(halves)]) * HALF
    codes = np.full(int(begin[-1]) * STRIDE, PAD, np.uint16)
    for b, s, e in zip((begin[:-1] * STRIDE).tolist(), starts.tolist(), ends.tolist()):
        codes[b : b + e - s] = data[s:e]
    valid = np.arange(int(begin[-1])) - np.repeat(begin[:-1], halves * HALF) < np.repeat(answers, halves * HALF)
    return codes, valid, halves, answers


def _answers(m: Model, codes: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes as vectors, answers): the filters' answers before bias at each stride; -inf where there is no text."""
    x = m.embed[codes].reshape(-1, STRIDE * DIM)
    out = x @ m.first
    out[:-1] += x[1:] @ m.second
    out[~valid] = -np.inf
    return x, out


def _chunks(halves: np.ndarray, answers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first half, second half, fill) of each chunk: positions among the half chunks that hold text; the halves are the same if there is but one."""
    used = -(-answers // HALF)
    counts = np.maximum(1, used - 1)
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(np.cumsum(used) - used, counts) + nth
    right = left + np.repeat((used > 1).astype(np.int64), counts)
    fill = np.minimum(CHUNK, np.repeat(answers, counts) - nth * HALF) / CHUNK
    return left, right, fill.astype(np.float32)


def _halves(m: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Greatest answers of each filter in each half chunk that holds text, text by text."""
    parts, row, n = [], 0, len(starts)
    while row < n:
        size = np.cumsum(ends[row:] - starts[row:])
        upto = row + max(1, int(np.searchsorted(size, SLICE, side="right")))
        if upto == row + 1 and size[0] > SLICE:
            for at in range(int(starts[row]), int(ends[row]), SLICE):
                stop = min(at + SLICE, int(ends[row]))
                # One stride more, for the last answer of the slice; that stride's own answer is the next slice's.
                codes, valid, _, _ = _layout(data, np.array([at]), np.array([min(stop + STRIDE, int(ends[row]))]))
                valid[-(-(stop - at) // STRIDE) :] = False
                parts.append(_answers(m, codes, valid)[1].reshape(-1, HALF, FILTERS).max(axis=1)[valid.reshape(-1, HALF)[:, 0]])
        else:
            codes, valid, _, _ = _layout(data, starts[row:upto], ends[row:upto])
            parts.append(_answers(m, codes, valid)[1].reshape(-1, HALF, FILTERS).max(axis=1)[valid.reshape(-1, HALF)[:, 0]])
        row = upto
    return np.concatenate(parts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def scores(m: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if m.constant is not None or not len(starts):
        return np.full(len(starts), m.constant if m.constant is not None else 0.5)
    answers = np.maximum(1, -(-(ends - starts) // STRIDE))
    half = _halves(m, data, starts, ends)
    left, right, fill = _chunks(answers // HALF + 1, answers)
    chunk = np.maximum(np.maximum(half[left], half[right]) + m.bias, 0)
    unit = np.maximum(chunk @ m.unit[:-1] + fill[:, None] * m.unit[-1] + m.unit_bias, 0)
    counts = np.maximum(1, -(-answers // HALF) - 1)
    at = np.cumsum(counts) - counts
    top, most = np.maximum.reduceat(chunk, at, axis=0), np.maximum.reduceat(unit, at, axis=0)
    return _sigmoid(top.astype(np.float64) @ m.weight + most.astype(np.float64) @ m.unit_weight + m.offset)


def _arg_rows(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of ``counts`` rows and each column, the row of the greatest value."""
    at = np.cumsum(counts) - counts
    return np.stack([s + values[s : s + n].argmax(axis=0) for s, n in zip(at.tolist(), counts.tolist())])


def gradients(m: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """(loss, gradients) of the mean cross-entropy; that of a maximum goes to what gave it."""
    codes, valid, halves, answers = _layout(data, starts, ends)
    x, a = _answers(m, codes, valid)
    a = a.reshape(-1, HALF, FILTERS)
    has = np.flatnonzero(valid.reshape(-1, HALF)[:, 0])
    half_arg = a[has].argmax(axis=1)
    half = np.take_along_axis(a[has], half_arg[:, None, :], 1)[:, 0]
    left, right, fill = _chunks(halves, answers)
    from_right = half[right] > half[left]
    pre = np.where(from_right, half[right], half[left]) + m.bias
    chunk = np.maximum(pre, 0)
    seen = np.concatenate([chunk, fill[:, None]], axis=1)
    unit_pre = seen @ m.unit + m.unit_bias
    unit = np.maximum(unit_pre, 0)
    counts = np.maximum(1, -(-answers // HALF) - 1)
    top_at, most_at = _arg_rows(chunk, counts), _arg_rows(unit, counts)
    top, most = np.take_along_axis(chunk, top_at, 0), np.take_along_axis(unit, most_at, 0)
    p = _sigmoid(top @ m.weight + most @ m.unit_weight + m.offset)
    d = ((p - y) / len(y)).astype(np.float32)
    loss = float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    grad = {"weight": top.T @ d, "unit_weight": most.T @ d, "offset": d.sum()}
    d_unit = np.zeros_like(unit)
    np.add.at(d_unit, (most_at, np.arange(UNITS)), d[:, None] * m.unit_weight)
    d_unit *= unit_pre > 0
    grad["unit"], grad["unit_bias"] = seen.T @ d_unit, d_unit.sum(0)
    d_chunk = d_unit @ m.unit[:-1].T
    np.add.at(d_chunk, (top_at, np.arange(FILTERS)), d[:, None] * m.weight)
    d_chunk *= pre > 0
    grad["bias"] = d_chunk.sum(0)
    d_a = np.zeros_like(a)
    d_half = np.zeros_like(half)
    np.add.at(d_half, (np.where(from_right, right[:, None], left[:, None]), np.arange(FILTERS)), d_chunk)
    d_a[has[:, None], half_arg, np.arange(FILTERS)] = d_half
    d_a = d_a.reshape(-1, FILTERS)
    grad["first"], grad["second"] = x.T @ d_a, x[1:].T @ d_a[:-1]
    d_x = d_a @ m.first.T
    d_x[1:] += d_a[:-1] @ m.second.T
    d_x = d_x.reshape(-1, DIM)
    grad["embed"] = np.stack([np.bincount(codes, d_x[:, k], 257) for k in range(DIM)], axis=1).astype(np.float32)
    return loss, grad


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 1) -> Model:
    """Adam on the cross-entropy."""
    rng = np.random.default_rng(seed)
    norm = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    m = Model(
        norm(257, DIM, by=0.5), norm(STRIDE * DIM, FILTERS, by=0.2), norm(STRIDE * DIM, FILTERS, by=0.2), np.zeros(FILTERS, np.float32),
        norm(FILTERS + 1, UNITS, by=0.2), np.full(UNITS, 0.5, np.float32), norm(FILTERS, by=0.3), norm(UNITS, by=0.3), 0.0,
    )
    if not len(labels):
        m.constant = 0.5
        return m
    if (labels == labels[0]).all():
        m.constant = float(labels[0])
        return m
    names = (*WEIGHTS, "offset")
    mean = {k: np.zeros_like(getattr(m, k)) for k in names}
    var = {k: np.zeros_like(getattr(m, k)) for k in names}
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    step, size = 0, 64
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
        order = rng.permutation(len(labels))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            _, grad = gradients(m, data, starts[rows], ends[rows], labels[rows])
            step += 1
            lr = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k in names:
                mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                var[k] = 0.999 * var[k] + 0.001 * grad[k] ** 2
                new = getattr(m, k) - lr * mean[k] / (np.sqrt(var[k]) + 1e-7)
                setattr(m, k, float(new) if k == "offset" else new.astype(np.float32))
    return m


def train(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on ``rows`` labelled rows for which ``learn`` (on doc_id) holds, at most, in the order of a hash of the id.

    The order is taken on ids first, so that only the texts of the sample move; the bound holds once more after the
    join, for ids that several documents share.
    """
    order = [F.xxhash64("doc_id", F.lit(7)), F.col("doc_id"), F.col("y")]
    some = labels.where(learn & F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("y")).orderBy(*order).limit(rows)
    got = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("doc_id", "y", "text", F.md5("text").alias("digest"))
    got = got.orderBy(*order, "digest").limit(rows).select("doc_id", "y", "text").toArrow().to_pydict()
    order = sorted(range(len(got["y"])), key=lambda i: (got["doc_id"][i], got["y"][i], got["text"][i] or ""))
    return fit([(got["text"][i] or "").encode() for i in order], np.array([got["y"][i] for i in order], np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(model, *utf8_view(batch.column(1))), pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
