import random
import re

import numpy as np

from tallyloom.llm import ngrams

from .common import awkward, clashing, empty


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    links, up = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a + 1, len(rows)):
            both = len(sets[a] & sets[b])
            if sets[a] and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (rows[root(k)][0], links[k]) for k, (i, _) in enumerate(rows)}


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BUCKET_BLOCK", 7)
    monkeypatch.setattr(ngrams, "TEXT_BLOCK", 16)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 30, 120, 400]))]
        for _ in range(60 if family == 0 else rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), "  ".join(text) if len(rows) % 5 == 0 else " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.class_id, r.n_links) for r in ngrams.near_duplicates(df).collect()}
    assert got == brute(rows)
    kept = {r.doc_id for r in ngrams.keep_one(df).collect()}
    assert kept == {i for i, (c, _) in got.items() if i == c}


def test_posterior_of_a_threshold_pair_is_not_dropped():
    least = ngrams.least_matches()
    assert least[128] < 0.8 * 128 and all(least[n] <= n for n in least)
    rng = np.random.default_rng(1)
    sig = rng.integers(0, 1 << 32, (2000, 128), dtype=np.uint32)
    sig[1000:] = np.where(rng.random((1000, 128)) < 0.8, sig[:1000], sig[1000:])
    a, _ = ngrams.prune(sig, np.arange(1000), np.arange(1000, 2000), least)
    assert len(a) >= 998
    a, _ = ngrams.prune(sig, np.arange(0, 999), np.arange(1, 1000), least)
    assert len(a) == 0


def test_awkward_rows(spark):
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngrams.near_duplicates(clashing(awkward(spark))).collect()), key=str)
    assert (1, 1, 2) in got and (2, 1, 2) in got and (3, 3, 0) in got and (4, 4, 0) in got and (5, 5, 0) in got and len(got) == 10
    assert ngrams.near_duplicates(empty(spark)).count() == 0
    assert ngrams.keep_one(clashing(awkward(spark))).count() == 8  # of three rows with one text, the first


def test_one_row_of_each_class_stays(spark):
    a, b, near = "the quick brown fox jumps over the lazy dog again and again", "a text of its own that has nothing to do with foxes", " ".join(f"w{k}" for k in range(60))
    rows = [(5, a, "x"), (5, a, "y"), (7, a, "x"), (None, a, "x"), (7, b, "x"), (None, near, "x"), (None, near, "x"), (None, near + " end", "x"), (8, None, "x"), (8, None, "x"), (9, "", "x"), (9, "", "x")]
    kept = [(r.doc_id, r.text) for r in ngrams.keep_one(spark.createDataFrame(rows, "doc_id long, text string, digest string")).collect()]
    small = sorted(kept, key=str)
    loose = [r for r in small if r[1] and r[1].startswith("w0")]
    assert len(loose) == 1 and loose[0][0] is None
    assert sorted((r for r in small if r not in loose), key=str) == sorted([(5, a), (7, b), (8, None), (8, None), (9, ""), (9, "")], key=str)
