import random
import re

from pyspark.sql import functions as F

from tallyloom.llm import lines

from .common import awkward, clashing, empty


def distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k, how = rng.randrange(len(out)), rng.random()
        if how < 0.34:
            del out[k]
        elif how < 0.67:
            out.insert(k, rng.choice("abc "))
        else:
            out[k] = rng.choice("abcd")
    return "".join(out)


def test_banded_distance(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abcd") for _ in range(rng.randint(6, 60)))
        b = edited(rng, a, rng.randint(0, 4))
        if abs(len(a) - len(b)) <= 1:
            rows.append((a, b))
    for edits in (1, 2, 3):
        got = spark.createDataFrame(rows, "a string, b string").select("a", "b", lines.within(F.col("a"), F.col("b"), edits).alias("w")).collect()
        assert all(r.w == (distance(r.a, r.b) <= edits) for r in got)


def form(line):
    return re.sub(r"\s+", " ", line.lower()).strip()


def brute(rows, edits=2, kept_by=False, share=None):
    """{doc: (links, places of removed lines)}; with ``kept_by`` also the document that keeps each removed line's class."""
    at = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if form(line):
                at.setdefault(form(line), []).append((i, k))
    forms, up, degree = list(at), {f: f for f in at}, dict.fromkeys(at, 0)

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for x in range(len(forms)):
        for y in range(x + 1, len(forms)):
            a, b = forms[x], forms[y]
            most = edits if share is None else min(edits, int(min(len(a), len(b)) * share + 1e-9))
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                degree[a] += 1
                degree[b] += 1
                up[root(a)] = root(b)
    keeper = {}
    for f, spots in at.items():
        keeper[root(f)] = min([keeper.get(root(f), min(spots)), *spots])
    removed, linked = {}, {}
    for f, spots in at.items():
        for spot in spots:
            linked[spot[0]] = linked.get(spot[0], 0) + degree[f]
            if spot != keeper[root(f)]:
                removed.setdefault(spot[0], []).append((spot[1], keeper[root(f)][0]))
    out = {i: (linked.get(i, 0), sorted(removed.get(i, []))) for i, _ in rows}
    return {i: (n, [p for p, _ in gone], *([[k for _, k in gone]] if kept_by else [])) for i, (n, gone) in out.items()}


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 5)
    rng = random.Random(7)
    rows, pool = [], ["".join(rng.choice("abcde ") for _ in range(rng.choice([30, 31, 80, 200]))).strip().ljust(26, "q") for _ in range(25)]
    hot = [edited(rng, pool[0], 1) for _ in range(14)]  # many lines that share segments
    for i in range(60):
        some = [edited(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 5))]
        some += [rng.choice(hot), "short", f"Page {i}  of a long and steady title"]
        rows.append((i, "\n".join(some)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.removed) for r in lines.report(df).collect()}
    want = brute(rows)
    assert got == want
    left = {r.doc_id: r.text for r in lines.remove(df).collect()}
    for i, text in rows:
        kept = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in want[i][1])
        assert left.get(i) == (kept if kept.strip() else None)  # a document that keeps no line goes


def test_awkward_rows(spark):
    got = {(r.doc_id, r.n_lines, r.n_links, r.n_removed) for r in lines.report(clashing(awkward(spark))).collect()}
    assert {(1, 1, 0, 0), (2, 1, 0, 1), (3, 0, 0, 0), (4, 1, 0, 0), (5, 2, 0, 0), (None, 1, 0, 0)} <= got
    assert lines.report(empty(spark)).count() == 0 and lines.remove(empty(spark)).count() == 0
    df = clashing(awkward(spark))
    kept = lines.remove(df)
    assert kept.columns == df.columns and kept.count() == 9  # the copy in document 2 goes


def test_banded_distance_of_short_strings(spark):
    rng = random.Random(5)
    pairs = {("".join(rng.choice("ab1") for _ in range(rng.randint(3, 8))), "".join(rng.choice("ab1") for _ in range(rng.randint(3, 8)))) for _ in range(600)}
    rows = [p for p in pairs if abs(len(p[0]) - len(p[1])) <= 2]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", (lines._alike(F.col("a"), F.col("b"), 2) & lines.within(F.col("a"), F.col("b"), 2)).alias("w")).collect()
    assert all(r.w == (distance(r.a, r.b) <= 2) for r in got)


def report(spark, rows):
    return {r.doc_id: (r.n_links, r.removed, r.kept_by) for r in lines.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_short_lines(spark):
    got = report(spark, [(1, "Menu\nx\n\nqrs"), (2, "menu\nX\n\nabcdefgh"), (3, "men\nx\nabcdefghijkl")])
    assert got == {1: (1, [], []), 2: (1, [0, 1], [1, 1]), 3: (1, [0, 1], [1, 1])}


def test_digits_are_content(spark):
    got = report(spark, [(1, "Invoice 4711 total 1999 EUR due"), (2, "Invoice 8 total 35 EUR due"), (3, "Invoice 4712 total 1998 EUR due")])
    assert got == {1: (1, [], []), 2: (0, [], []), 3: (1, [0], [1])}


def test_a_row_without_an_id_loses_no_link(spark):
    a, b, c = "a long and steady title of some page", "a long and steadi title of some page", "another line that only rows without an id hold"
    got = report(spark, [(None, f"{a}\n{c}"), (1, a), (2, b), (3, c.replace("only", "onli"))])
    assert got == {None: (2, [0, 1], [1, 3]), 1: (1, [], []), 2: (1, [0], [1]), 3: (1, [], [])}


def test_all_pairs_of_short_lines_and_digits(spark):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abc12 ") for _ in range(rng.choice([3, 5, 30]))).strip().ljust(3, "q") for _ in range(12)]
    rows = [(i, "\n".join([edited(rng, rng.choice(pool), rng.choice([0, 1])).ljust(3, "q"), f"Page {i}  of a title"])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for share in (None, 0.1, 0.4):
        got = {r.doc_id: (r.n_links, r.removed, r.kept_by) for r in lines.report(docs, share=share).collect()}
        assert got == brute(rows, kept_by=True, share=share)


def test_classes_of_lengths_and_every_edit_number(spark):
    """All pairs of lines of each length from 3 to 40 and three edits, with copies that have lost or gained characters."""
    rng = random.Random(11)
    rows = []
    for n in range(4, 41):
        base = "".join(rng.choice("abcdefgh") for _ in range(n))
        rows.append((n, "\n".join([base, *(edited(rng, base, k) for k in (1, 2, 3))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for edits in (1, 2, 3):
        got = {r.doc_id: (r.n_links, r.removed) for r in lines.report(docs, edits).collect()}
        assert got == brute([(i, "\n".join(x if len(form(x)) > edits else "" for x in t.split("\n"))) for i, t in rows], edits)


def test_a_hot_key_goes_by_blocks(spark, monkeypatch):
    """Many lines that share a third, some of them linked across blocks, and a dense group: counts hold in any block size."""
    rng = random.Random(13)
    common = "the same beginning of all "
    some = [common + "".join(rng.choice("abcdefghijkl") for _ in range(50)) for _ in range(40)]
    some += [edited(rng, some[0], 1) for _ in range(20)] + [edited(rng, x, 2) for x in some[20:30]]
    rows = [(i, x) for i, x in enumerate(some)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (7, 128):
        monkeypatch.setattr(lines, "BLOCK", block)
        assert {r.doc_id: (r.n_links, r.removed) for r in lines.report(docs).collect()} == brute(rows)


def test_parity_holds_what_edits_allow_and_little_else(spark):
    """A pair within some edits never differs by more bits than twice their number; lines that share a segment mostly do."""
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinshrdlué日\U0001f600") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    near, far = [], []
    for _ in range(300):
        line = " ".join(rng.choice(words) for _ in range(8))
        near += [(line, edited(rng, line, n), n) for n in (0, 1, 2, 3)]
        far.append((line, " ".join([*line.split(" ")[:3], *(rng.choice(words) for _ in range(5))]), 2))
    flips = F.bit_count(lines.parity(F.col("a")).bitwiseXOR(lines.parity(F.col("b"))))
    count = lambda rows: spark.createDataFrame(rows, "a string, b string, n int").where(flips <= 2 * F.col("n")).count()
    assert count(near) == len(near) and count(far) < 0.4 * len(far)
