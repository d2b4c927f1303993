import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from tallyloom.llm import language, mixing, packing

from . import test_lines, test_ngrams, test_texts
from .common import SCHEMA, awkward, clashing, empty
from .test_models import gru


def test_stages_take_and_give_documents(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard_join", "mix_sources", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        if name != "best_fit_packing":
            assert docs.columns == columns
    assert corpus_pipeline.run(spark, sf).count() == docs.count() > 0


def test_each_stage_takes_awkward_and_empty_tables(spark, sf):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), sf).count() == 0
        assert stage(spark, clashing(awkward(spark)), sf).count() >= 0
        assert stage(spark, spark.createDataFrame([(None, None, None, None, None)], SCHEMA), sf).count() >= 0


# ---------------------------------------------------------------- the pipeline in plain loops


def predicted(model, text):
    """(language, score) by the recurrent network, byte by byte."""
    if text is None or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    data, total = text.encode(), np.zeros(len(model.langs))
    for at in range(0, len(data), language.CHUNK):
        chunk = data[at : at + language.CHUNK]
        for f, b in zip(gru(model, 0, chunk), gru(model, 1, chunk)):
            e = np.exp(np.concatenate([f, b]) @ model.out + model.bias)
            total += e / e.sum()
    return model.langs[int(total.argmax())], float(total.max() / len(data))


def without_lines(rows):
    gone = test_lines.brute([(i, t) for i, t, _ in rows], share=corpus_pipeline.EDITED_SHARE)
    out = []
    for i, text, source in rows:
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone[i][1])
        if not gone[i][1] or left.strip(" "):
            out.append((i, left, source))
    return out


def one_of_each(rows):
    classes = test_ngrams.brute([(i, t) for i, t, _ in rows])
    best = {}
    for i, (c, _) in classes.items():
        best[c] = min(best.get(c, i), i)
    return [r for r in rows if best[classes[r[0]][0]] == r[0]]


def mixed(rows):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    size = {i: len(word.findall(t)) for i, t, _ in rows}
    by = Counter()
    for i, _, s in rows:
        by[s] += size[i]
    order = sorted(s for s in by if s is not None) + [None] * (None in by)
    want = test_texts.fill({s: 2 * by[s] for s in by}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(by.values()))
    out = []
    for s in by:
        whole = int((want[s] + 1e-9) // by[s]) if by[s] else 0
        rest = int(want[s] + 1e-9 - whole * by[s])
        for i, text, _ in sorted((r for r in rows if r[2] == s), key=lambda r: hashlib.md5(f"{mixing.SEED}:{r[0]}".encode()).hexdigest()):
            more = min(size[i], rest)
            rest -= more
            out += [(i, text)] * whole if size[i] else []
            if more:
                cut = [m.end() for m in word.finditer(text)][more - 1]
                out.append((i, text if more == size[i] else text[:cut]))
    return out


def pieces(rows):
    from tokenizers import Tokenizer

    model, out = Tokenizer.from_file(packing.tokenizer_path()), Counter()
    for i, text in rows:
        ids = np.array(model.encode(text, add_special_tokens=False).ids + [packing.END_ID], "<u4")
        for k, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            cut = ids[at : at + packing.CAPACITY]
            out[i, k, at, len(cut), zlib.crc32(cut)] += 1
    return out


def test_the_whole_pipeline_against_plain_loops(spark, tmp_path):
    rng = random.Random(17)
    words = {"xx": ["".join(rng.choice("abcdef") for _ in range(rng.randint(4, 9))) for _ in range(900)], "yy": ["".join(rng.choice("uvwxyz") for _ in range(rng.randint(4, 9))) for _ in range(900)]}
    line = lambda lang: " ".join(rng.choices(words[lang], k=rng.randint(6, 14)))
    shared = [line("xx") for _ in range(4)]
    rows = []
    for i in range(90):
        lang = rng.choice(["xx", "yy"])
        text = [line(lang) for _ in range(rng.randint(2, 6))]
        if i % 4 == 0:
            text.insert(1, test_lines.edited(rng, shared[i % 3], rng.randint(0, 2)))
        if i % 9 == 8:
            text = rows[i - 3][1].replace(rows[i - 3][1].split()[0], "zuvx", 1).replace("\n", " ").split("\n")  # a near copy, in one line
        if i == 7:
            text = [line(lang) for _ in range(900)]  # longer than a sequence
        rows.append((i, "\n".join(text), rng.choice(["a", "a", "a", "b", "c", None]), lang))
    rows += [(90, "123 456", "a", "xx"), (91, "", "b", "xx")]
    docs = spark.createDataFrame([(i, t, lang, s, len(t)) for i, t, s, lang in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()

    model = language.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), language.remainder(4) != 2)
    judged = [(i, t, s, *predicted(model, t)) for i, t, s, _ in rows]
    known = [(i, t, s) for i, t, s, lang, score in judged if lang != "und" and score >= corpus_pipeline.LEAST_SCORE]
    assert 80 < len(known) <= 90
    assert min(abs(score - corpus_pipeline.LEAST_SCORE) for *_, score in judged) > 1e-4  # no document is a matter of rounding
    lines_left = without_lines(known)
    kept = one_of_each(lines_left)
    assert len(kept) < len(lines_left) and sum(len(t) for _, t, _ in lines_left) < sum(len(t) for _, t, _ in known)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces(mixed(kept))
    filled = Counter()
    for r in got:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= packing.CAPACITY
