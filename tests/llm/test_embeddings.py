import numpy as np

from tallyloom.llm import embeddings


def brute(rows, threshold=0.93):
    """(n_links, component) by id, over all pairs."""
    ok = {i: np.array(v, float) / np.linalg.norm(v) for i, v, label in rows if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    label = {i: y for i, _, y in rows}
    links, up = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}
    ids = sorted(ok)
    for a in ids:
        for b in ids:
            if a < b and label[a] == label[b] and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = a, b
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    return {i: (links[i], root(i), root(i) == i) for i, _, _ in rows}


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, **how).collect()}
    assert got == brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows])


def test_against_all_pairs_over_many_cells_and_blocks(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal((40, 16))
    rows = []
    for i in range(600):
        v = centre[i % 40] + rng.standard_normal(16) * (0.02 if i % 3 else 0.4)
        rows.append((i, [float(x) for x in v], int(i % 40 % 3)))
    rows += [(1000 + k, rows[0][1], 0) for k in range(150)]  # one hot vector
    check(spark, rows, cell_rows=12, block=32)


def test_differences_along_the_line_between_centroids(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(240):
        v = rng.standard_normal(64) * 0.005  # 64 dimensions, nearly all of the spread in two
        turn = 2 * np.pi * rng.random()
        v[:2] += np.cos(turn), np.sin(turn)
        rows.append((i, [float(x) for x in v], 0))
    check(spark, rows, cell_rows=24)


def test_no_pair_is_missed_by_any_number_of_cells():
    """Vectors along arcs, spread by dimension and in clusters: linked ones meet in a cell that one of them is at home in."""
    rng = np.random.default_rng(12)
    turn = np.linspace(0, 3, 1500)
    arc = np.zeros((1500, 64))
    arc[:, 0], arc[:, 1] = np.cos(turn), np.sin(turn)
    uneven = rng.standard_normal((1500, 64)) / np.arange(1, 65)
    clustered = rng.standard_normal((30, 64))[rng.integers(0, 30, 1500)] + 0.3 * rng.standard_normal((1500, 64))
    for x in (arc, uneven, clustered):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(np.triu(x @ x.T >= embeddings.THRESHOLD, 1))
        assert len(a) > 500
        for cells in (4, 16, 64, 256):
            home, visits = embeddings.cells_of(x, embeddings.kmeans(x, cells), embeddings.THRESHOLD)
            assert visits[a, home[b]].all() and visits[b, home[a]].all()
            meet = visits & (np.arange(visits.shape[1])[None, :] >= home[:, None])
            assert np.where(home[a] <= home[b], meet[a, home[b]], meet[b, home[a]]).all()


def test_labels_have_cells_by_their_own_number(spark):
    """One hot label with many cells beside small ones with one."""
    rng = np.random.default_rng(9)
    rows = [(i, [float(x) for x in rng.standard_normal(3)], 0 if i % 4 else i % 9) for i in range(300)]
    check(spark, rows, cell_rows=20)


def test_what_links_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [0.0, 0.0], 1), (2, [1.0, nan], 1), (3, [inf, 1.0], 1), (4, [1.0, None], 1), (5, [1.0, 0.0], None), (6, [1.0, 0.0], 1), (7, [2.0, 0.0], 1), (8, [1.0, 0.0, 0.0], 1), (9, [], 1), (10, [1.0, 0.0], 2), (11, [-1.0, 0.0], 1), (12, [1e-30, 0.0], 1)]
    check(spark, rows)


def test_empty_and_clashing(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    df = spark.createDataFrame([(1, [1.0], 1, 7, "x"), (1, [1.0], 1, 7, "y")], "vec_id long, embedding array<float>, label int, rep long, digest string")
    assert [tuple(r) for r in embeddings.near_duplicates(df).collect()] == [(1, 1, 1, True), (1, 1, 1, True)]


def test_cells_are_used_only_where_they_separate():
    """Vectors without clusters would visit most cells, each visit a copy on disk; tight clusters have a cell each."""
    rng = np.random.default_rng(3)
    plain = rng.standard_normal((1500, 64))
    tight = rng.standard_normal((16, 64))[rng.integers(0, 16, 1500)] + 0.01 * rng.standard_normal((1500, 64))
    best = []
    for x in (plain, tight):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        best.append(embeddings.worth(x, [embeddings.kmeans(x, n) for n in (1, 4, 16)], embeddings.THRESHOLD))
    assert best[0] == [0, 0, 0] and best[1][2] > 0
