"""Language ID: a bidirectional gated recurrent network over bytes, in numpy.

A text's bytes are cut into chunks of ``CHUNK`` steps that cover all of it.  Over each chunk one network runs forwards
and one backwards; at each position their two states give a probability of each language (the position's label is the
greatest); a document's probabilities are the mean over its positions.  Gates are piecewise linear, which costs a
tenth of exponentials and leaves the network as it is otherwise.

Training is backpropagation through time on a bounded sample: up to ``SAMPLE_ROWS`` documents of each language, one of
each bucket of a hash of the id, and ``PIECES`` pieces of each, at places anywhere in the text that a hash gives.

Defined results: a null text or one without a letter is ``und`` with score 0; without training rows every text is;
repeated rows get equal predictions; a null language teaches nothing; of rows that share an id one teaches; a very long
text is read whole; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, utf8_view

SAMPLE_ROWS = 400
PIECES = 4
CHUNK = 128
STATE = 8
STEPS = 260
PAD = 256
#: Chunks that are run side by side.
WIDTH = 1024
UNKNOWN = "und"


@dataclass
class Model:
    langs: list[str]
    table: list[np.ndarray]  #: for each direction (3, 257, STATE): what a byte adds to update, reset and candidate
    inner: list[np.ndarray]  #: for each direction (3, STATE, STATE)
    out: np.ndarray  #: (2 * STATE, languages)
    bias: np.ndarray


def _run(table: np.ndarray, inner: np.ndarray, codes: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (steps, chunks, STATE) of one direction; ``keep`` gets what training needs of each step."""
    steps, n = codes.shape
    out = np.empty((steps, n, STATE), table.dtype)
    h = np.zeros((n, STATE), table.dtype)
    (uz, ur, un), (tz, tr, tn) = inner, table
    z, r, a, c = (np.empty((n, STATE), table.dtype) for _ in range(4))
    for t in range(steps):
        x = codes[t]
        np.matmul(h, uz, out=z)
        z += tz.take(x, axis=0)
        np.matmul(h, ur, out=r)
        r += tr.take(x, axis=0)
        np.matmul(h, un, out=a)
        if keep is None:
            np.maximum(z, 0, out=z)
            np.minimum(z, 1, out=z)
            np.maximum(r, 0, out=r)
            np.minimum(r, 1, out=r)
            a *= r
            a += tn.take(x, axis=0)
            np.maximum(a, -1, out=a)
            np.minimum(a, 1, out=a)
            np.subtract(h, a, out=c)
            c *= z
            h = np.add(c, a, out=out[t])
            continue
        zc, rc = np.clip(z, 0, 1), np.clip(r, 0, 1)
        pre = a * rc + tn[x]
        cand = np.clip(pre, -1, 1)
        new = cand + zc * (h - cand)
        keep.append((x, h, zc, rc, a.copy(), cand, (z > 0) & (z < 1), (r > 0) & (r < 1), np.abs(pre) < 1))
        h = out[t] = new
    return out


def _positions(m: Model, codes: np.ndarray) -> np.ndarray:
    """Probabilities (steps, chunks, languages) at each position."""
    forward = _run(m.table[0], m.inner[0], codes)
    backward = _run(m.table[1], m.inner[1], codes[::-1])[::-1]
    logits = forward.reshape(-1, STATE) @ m.out[:STATE]
    logits += backward.reshape(-1, STATE) @ m.out[STATE:]
    logits += m.bias
    np.clip(logits, -30, 30, out=logits)
    np.exp(logits, out=logits)
    logits /= logits @ np.ones((logits.shape[1], 1), np.float32)
    return logits.reshape(*codes.shape, -1)


def probabilities(m: Model, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean probabilities (texts, languages) over all positions of each text."""
    sizes = ends - starts
    counts = -(-sizes // CHUNK)
    owner = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = starts[owner] + nth * CHUNK
    length = np.minimum(CHUNK, ends[owner] - begin)
    total = np.zeros((len(sizes), len(m.langs)))
    order = np.argsort(-length, kind="stable")  # so that short chunks share short runs
    span = np.arange(CHUNK)
    for at in range(0, len(order), WIDTH):
        some = order[at : at + WIDTH]
        steps = int(length[some[0]])
        index = np.minimum(begin[some][None, :] + span[:steps, None], len(data) - 1)
        codes = data[index].astype(np.int64)
        real = span[:steps, None] < length[some][None, :]
        if not real.all():
            codes[~real] = PAD
            p = _positions(m, codes) * real[:, :, None]
        else:
            p = _positions(m, codes)
        summed = p.sum(axis=0)
        for k in range(len(m.langs)):
            total[:, k] += np.bincount(owner[some], summed[:, k], len(sizes))
    return total / np.maximum(1, sizes)[:, None]


def gradients(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """(loss, gradients) of the mean cross-entropy over all positions of chunks (steps, chunks): tables, inner, out, bias."""
    size, real = x.shape[1], (x != PAD)[:, :, None]
    kept: tuple[list, list] = ([], [])
    f = _run(m.table[0], m.inner[0], x, kept[0])
    b = _run(m.table[1], m.inner[1], x[::-1], kept[1])[::-1]
    both = np.concatenate([f, b], axis=2)
    logits = both @ m.out + m.bias
    p = np.exp(logits - logits.max(axis=2, keepdims=True))
    p /= p.sum(axis=2, keepdims=True)
    loss = float(-(np.log(p[:, np.arange(size), y]) * real[:, :, 0]).sum() / max(1, real.sum()))
    p[:, np.arange(size), y] -= 1
    d = (p * real / max(1, real.sum())).astype(m.out.dtype)
    g_out, g_bias = np.einsum("tns,tnl->sl", both, d), d.sum(axis=(0, 1))
    back = d @ m.out.T
    grads = []
    for way in (0, 1):
        dh_out = back[:, :, :STATE] if way == 0 else back[::-1, :, STATE:]
        uz, ur, un = m.inner[way]
        g_inner, g_table = np.zeros_like(m.inner[way]), np.zeros_like(m.table[way])
        dh = np.zeros((size, STATE), m.out.dtype)
        for t in range(len(x) - 1, -1, -1):
            code, h, z, r, a, cand, z_in, r_in, c_in = kept[way][t]
            dh = dh + dh_out[t]
            dz = dh * (h - cand) * z_in
            dc = dh * (1 - z) * c_in
            dr, da = dc * a * r_in, dc * r
            g_inner += np.stack([h.T @ dz, h.T @ dr, h.T @ da])
            for k, v in enumerate((dz, dr, dc)):
                np.add.at(g_table[k], code, v)
            dh = dh * z + dz @ uz.T + dr @ ur.T + da @ un.T
        g_table[:, PAD] = 0
        grads.append((g_table, g_inner))
    return loss, [grads[0][0], grads[1][0], grads[0][1], grads[1][1], g_out, g_bias]


def fit(chunks: list[bytes], langs: list[str], seed: int = 1) -> Model:
    """Adam on the cross-entropy of every position, over chunks drawn evenly from the languages."""
    rng = np.random.default_rng(seed)
    names = sorted(set(langs))
    table = [(rng.standard_normal((3, 257, STATE)) * 0.3).astype(np.float32) for _ in range(2)]
    inner = [(rng.standard_normal((3, STATE, STATE)) * 0.3).astype(np.float32) for _ in range(2)]
    for t in table:
        t[0] += 0.7  # states are kept at first
        t[1] += 0.5
        t[:, PAD] = np.array([100, 0, 0], np.float32)[:, None]  # padding leaves the state as it is
    m = Model(names, table, inner, (rng.standard_normal((2 * STATE, len(names))) * 0.3).astype(np.float32), np.zeros(len(names), np.float32))
    if len(names) < 2:
        return m
    y = np.array([names.index(x) for x in langs])
    by = [np.flatnonzero(y == k) for k in range(len(names))]
    codes = np.full((len(chunks), CHUNK), PAD, np.int64)
    for i, c in enumerate(chunks):
        codes[i, : len(c)] = np.frombuffer(c, np.uint8)
    weights = [m.table[0], m.table[1], m.inner[0], m.inner[1], m.out, m.bias]
    mean, var = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    size = 96
    for step in range(1, STEPS + 1):
        rows = np.array([rng.choice(by[k]) for k in rng.integers(0, len(names), size)])
        cut = int(rng.integers(0, CHUNK // 2 + 1))
        _, all_grads = gradients(m, codes[rows, cut : cut + CHUNK // 2].T, y[rows])
        scale = min(1.0, 1.0 / float(np.sqrt(sum((g**2).sum() for g in all_grads)) + 1e-9))
        rate = 0.02 * (1 - step / STEPS) + 0.001
        for w, g, mu, v in zip(weights, all_grads, mean, var):
            g = g * scale
            mu *= 0.9
            mu += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            w -= (rate * (mu / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return m


def remainder(k: int) -> Column:
    """crc32 of doc_id as text, modulo k; a null id has the remainder 0."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(k)), F.lit(0))


def train(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, pieces: int = PIECES) -> Model:
    """Fit on up to ``rows`` documents of each language for which ``learn`` (on doc_id) holds, some pieces of each.

    Of each of ``rows`` buckets of a hash of the id the first document by another hash is taken: a minimum a bucket, so
    a language that most documents have costs no more than others.  The ids are written; Spark broadcasts them if that
    table is small enough.  One row a bucket is left after the join too, whatever number of documents share an id.
    """
    scratch = Scratch(docs.sparkSession)
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    bucket = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(rows))
    ids = known.groupBy(F.col("lang").alias("y"), bucket.alias("bucket")).agg(F.min_by("doc_id", F.xxhash64("doc_id", F.lit(10))).alias("id"))
    ids = scratch.cut(ids, "sample")
    last = F.greatest(F.lit(1), F.length("text") - (CHUNK - 1)).cast("long")
    cuts = [F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(20 + k)), last) + 1).cast("int"), F.lit(CHUNK)) for k in range(pieces)]
    got = known.select("lang", "doc_id", F.array(*cuts).alias("cuts")).join(ids, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("lang") == F.col("y")))
    got = got.groupBy("lang", "bucket").agg(F.min("cuts").alias("cuts")).toArrow().to_pylist()
    scratch.drop("sample")
    got.sort(key=lambda r: (r["lang"], r["bucket"]))
    chunks = [(c.encode()[:CHUNK], r["lang"]) for r in got for c in r["cuts"] if c.strip()]
    return fit([c for c, _ in chunks], [lang for _, lang in chunks])


def _judge(model: Model, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """(language, score) of each text."""
    import regex

    letter = regex.compile(r"\p{L}").search
    names = np.array([*model.langs, UNKNOWN], dtype=object)
    known = np.array([t is not None and letter(t) is not None for t in texts.to_pylist()], bool)
    best, top = np.full(len(known), len(model.langs)), np.zeros(len(known))
    if model.langs and known.any():
        p = probabilities(model, *utf8_view(texts))
        best[known], top[known] = p.argmax(axis=1)[known], p.max(axis=1)[known]
    return pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(top, 0, 1), pa.float64())


def keep_known(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose language scores ``least`` or more, with ``lang`` set to the prediction."""
    columns = docs.columns
    text, lang = columns.index("text"), columns.index("lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                found, score = _judge(model, part.column(text))
                arrays = part.columns
                arrays[lang] = found
                keep = pa.compute.and_(pa.compute.greater_equal(score, least), pa.compute.not_equal(found, UNKNOWN))
                yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(keep)

    return docs.mapInArrow(run, docs.schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for each row: one pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                yield pa.RecordBatch.from_arrays([part.column(0), *_judge(model, part.column(1))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
