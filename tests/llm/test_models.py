import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import language, quality, queries
from tallyloom.llm.common import utf8_view

from .common import LONG, awkward, clashing, empty


def gru(m, way, text):
    """States of one direction, byte by byte."""
    tables, (uz, ur, un) = m.table[way], m.inner[way]
    h, out = np.zeros(language.STATE), []
    for byte in text if way == 0 else text[::-1]:
        update = np.clip(tables[0, byte] + h @ uz, 0, 1)
        reset = np.clip(tables[1, byte] + h @ ur, 0, 1)
        candidate = np.clip(tables[2, byte] + reset * (h @ un), -1, 1)
        h = update * h + (1 - update) * candidate
        out.append(h)
    return out if way == 0 else out[::-1]


def test_language_network_matches_a_plain_loop():
    model = language.fit([b"abc abd abe", b"xyz xyw xyv", b"mno mop"], ["a", "x", "m"])
    texts = ["a", "abc xyz", LONG[:127], LONG[:128], LONG[:129], LONG[:1000], "日本語 é"]
    got = language.probabilities(model, *utf8_view(pa.array(texts)))
    for text, p in zip(texts, got):
        data, total = text.encode(), np.zeros(3)
        for at in range(0, len(data), language.CHUNK):
            chunk = data[at : at + language.CHUNK]
            for f, b in zip(gru(model, 0, chunk), gru(model, 1, chunk)):
                e = np.exp(np.concatenate([f, b]) @ model.out + model.bias)
                total += e / e.sum()
        assert np.allclose(p, total / len(data), atol=1e-4)


def test_language_gradients():
    """Backpropagation through time against the loss on both sides of each weight."""
    rng = np.random.default_rng(8)
    model = language.fit([b"abc abd abe" * 3, b"xyz xyw xyv"], ["a", "x"])
    model.table, model.inner = [t.astype(np.float64) for t in model.table], [t.astype(np.float64) for t in model.inner]
    model.out, model.bias = model.out.astype(np.float64), model.bias.astype(np.float64)
    x, y = rng.choice(np.frombuffer(b"abcxyz ", np.uint8), (20, 5)).astype(np.int64), np.array([0, 1, 0, 1, 1])
    x[15:, 2] = language.PAD
    weights = [model.table[0], model.table[1], model.inner[0], model.inner[1], model.out, model.bias]
    _, grads = language.gradients(model, x, y)
    for w, g in zip(weights, grads):
        far = np.argsort(-np.abs(g), axis=None)[:15]  # where there is something to see
        for at in zip(*np.unravel_index(far, w.shape)):
            was, loss = w[at], []
            for by in (1e-6, -1e-6):
                w[at] = was + by
                loss.append(language.gradients(model, x, y)[0])
            w[at] = was
            assert abs((loss[0] - loss[1]) / 2e-6 - g[at]) < 1e-4 + 1e-3 * abs(g[at])


def test_language_training_takes_pieces_of_the_whole_text_and_bounds_hot_ids(spark):
    """What distinguishes the languages stands past the first 128 characters; 500 rows share one id."""
    rows = [(i, "0" * 400 + ("abcd " if i % 2 else "wxyz ") * 80, "x" if i % 2 else "w") for i in range(60)]
    rows += [(7, "abcd " * 100, "x")] * 500
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), rows=50)
    p = language.probabilities(model, *utf8_view(pa.array(["abcd abcd " * 9, "wxyz wxyz " * 9])))
    assert [model.langs[k] for k in p.argmax(axis=1)] == ["x", "w"]


def test_language_held_out_accuracy():
    rng = random.Random(2)
    vocabulary = {"xx": "abcde", "yy": "fghij", "zz": "aeiou"}
    make = lambda k: "".join(rng.choice(vocabulary[k] + " ") for _ in range(rng.randint(1, 700)))
    chunks = [(make(k).encode()[: language.CHUNK], k) for k in vocabulary for _ in range(60)]
    model = language.fit([c for c, _ in chunks], [k for _, k in chunks])
    texts = [(make(k) + k[0] * 0, k) for k in vocabulary for _ in range(30)]
    p = language.probabilities(model, *utf8_view(pa.array([t for t, _ in texts])))
    right = np.mean([model.langs[i] == k for i, (t, k) in zip(p.argmax(axis=1), texts) if len(t) > 20])
    assert right > 0.95
    assert np.allclose(p[[len(t) > 0 for t, _ in texts]].sum(axis=1), 1, atol=1e-3)


def test_a_text_scores_alike_alone_and_among_others():
    model = language.fit([b"abc abd", b"xyz xyw"], ["a", "x"])
    texts = ["abc", "xyz " * 200, "", "a"]
    together = language.probabilities(model, *utf8_view(pa.array(texts)))
    for k, t in enumerate(texts):
        assert np.allclose(together[k], language.probabilities(model, *utf8_view(pa.array([t])))[0], atol=1e-5)


def test_languages_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    model = language.train(docs, F.lit(True))
    got = {(r.doc_id, r.lang_pred) for r in language.predict(docs, model).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "und")} <= got and len(got) == 9
    assert all(0 <= r.score <= 1 for r in language.predict(docs, model).collect())
    assert language.predict(empty(spark), model).count() == 0
    kept = language.keep_known(docs, model, 0.0)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 6, 8, None}
    blank = language.train(empty(spark), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, blank).collect()} == {"und"}


@pytest.mark.parametrize("make", [queries.op9_language_id])
def test_language_query_on_held_out_rows(spark, sf, make):
    out = {r.doc_id: r for r in make(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(out) == len(docs)
    assert all(out[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) for d in docs)
    held = [d for d in docs if out[d.doc_id].held_out]
    assert np.mean([out[d.doc_id].lang_pred == d.lang for d in held]) > 0.95


def plain_score(m, text):
    """A text's score, chunk by chunk and answer by answer."""
    q = quality
    answers = max(1, -(-len(text) // q.STRIDE))
    codes = np.full((answers + 1) * q.STRIDE, q.PAD)
    codes[: len(text)] = np.frombuffer(text, np.uint8)
    both = np.concatenate([m.first, m.second])
    answer = [m.embed[codes[k * q.STRIDE : (k + 2) * q.STRIDE]].ravel() @ both for k in range(answers)]
    top, most = np.zeros(q.FILTERS), np.zeros(q.UNITS)
    for begin in range(0, max(1, answers - q.HALF), q.HALF):
        seen = answer[begin : begin + q.CHUNK]
        chunk = np.maximum(np.max(seen, axis=0) + m.bias, 0)
        top = np.maximum(top, chunk)
        most = np.maximum(most, np.append(chunk, len(seen) / q.CHUNK) @ m.unit + m.unit_bias)
    return 1 / (1 + np.exp(-(top @ m.weight + most @ m.unit_weight + m.offset)))


def small_model():
    rng = np.random.default_rng(5)
    model = quality.fit([b"good words here", b"JUNK!! JUNK!!"] * 4, np.array([1, 0] * 4, np.float32))
    model.embed = rng.standard_normal(model.embed.shape).astype(np.float32) * 0.5
    return model


def test_quality_network_matches_a_plain_loop():
    model = small_model()
    lengths = [0, 1, 5, 8, 100, 127, 128, 129, 255, 256, 257, 384, 385, 3000]
    texts = [b"", *(LONG.encode()[:n] for n in lengths)]
    got = quality.scores(model, *utf8_view(pa.array([t.decode() for t in texts])))
    assert np.allclose(got, [plain_score(model, t) for t in texts], atol=1e-4)


def test_quality_gradients():
    """Each weight's gradient against the loss on both sides of it."""
    model = small_model()
    texts = [LONG.encode()[:900], b"JUNK " * 90, b"a", b"some words that come once each, and then no more of them"]
    ends = np.cumsum([len(t) for t in texts])
    args = np.frombuffer(b"".join(texts), np.uint8), ends - [len(t) for t in texts], ends, np.array([1, 0, 1, 0], np.float32)
    for k in quality.WEIGHTS:
        setattr(model, k, getattr(model, k).astype(np.float64))
    _, grad = quality.gradients(model, *args)
    rng = np.random.default_rng(3)
    for name in quality.WEIGHTS:
        w = getattr(model, name)
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in w.shape)
            was, loss = w[at], []
            for by in (1e-5, -1e-5):
                w[at] = was + by
                loss.append(quality.gradients(model, *args)[0])
            w[at] = was
            assert abs((loss[0] - loss[1]) / 2e-5 - grad[name][at]) < 1e-3


def test_quality_sees_repetition():
    """Texts that differ in nothing but that one repeats few words are told apart."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    varied = lambda: " ".join(rng.choices(words, k=rng.randint(60, 400)))
    dull = lambda: " ".join(w for w in rng.choices(words, k=8) for _ in range(rng.randint(8, 50)))
    model = quality.fit([f().encode() for _ in range(200) for f in (varied, dull)], np.array([1, 0] * 200, np.float32))
    texts = [f() for _ in range(50) for f in (varied, dull)]
    got = quality.scores(model, *utf8_view(pa.array(texts))) >= 0.5
    assert np.mean(got == np.array([True, False] * 50)) > 0.95


def test_a_text_longer_than_a_slice(monkeypatch):
    model = small_model()
    texts = pa.array([LONG + "JUNK!! JUNK!!", "good", LONG[:8192], LONG[:8193], LONG[:4100], "x" * 4096])
    whole = quality.scores(model, *utf8_view(texts))
    monkeypatch.setattr(quality, "SLICE", 4096)
    assert np.allclose(quality.scores(model, *utf8_view(texts)), whole, atol=1e-5)


def test_a_text_longer_than_the_shipped_slice():
    model = small_model()
    text = LONG * 13
    assert len(text) > quality.SLICE
    assert abs(quality.scores(model, *utf8_view(pa.array([text])))[0] - plain_score(model, text.encode())) < 1e-4


def test_quality_of_awkward_rows(spark):
    docs = clashing(awkward(spark))
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (6, 0, "x"), (3, 1, "x"), (9, 1, "x"), (2, None, "x")], "doc_id long, quality int, text string")
    model = quality.train(docs, labels, "quality", F.lit(True))
    got = quality.score(docs, model).collect()
    assert len(got) == 10 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(empty(spark), model).count() == 0
    nothing = quality.train(docs, labels.where("false"), "quality", F.lit(True))
    assert {r.score for r in quality.score(docs, nothing).collect()} == {0.5}
    ones = quality.train(docs, labels.where("quality = 1"), "quality", F.lit(True))
    assert {r.score for r in quality.score(docs, ones).collect()} == {1.0}


def test_quality_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op2_quality_classifier(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [r for r in labels if out[r.doc_id].held_out]
    right = np.mean([out[r.doc_id].predicted == r.quality for r in held])
    base = max(np.mean([r.quality for r in held]), 1 - np.mean([r.quality for r in held]))
    assert right > base + 0.05
