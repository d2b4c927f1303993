"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one kept row a group.

1. Equal vectors with equal labels become one class (pre-aggregated, so a vector that a third of all rows hold is one
   row from then on).
2. Spherical k-means on a bounded sample gives sets of 1, 4, 16, .. cells.  A label's classes are only compared with each
   other, so each label uses the smallest set that leaves ``CELL_ROWS`` of its classes a cell at most, on average, or a
   smaller set if that leaves fewer pairs to compare (``worth``): cells that most vectors must visit only cost.
3. A class belongs to its nearest cell, and visits each later-numbered cell in which a partner may lie.  All of cell d
   lies on its side of the border to each other cell e, and x lies asin((x.e - x.d) / |e - d|) beyond that border; a
   vector with cosine t or more is at most acos(t) away.  So x need not visit d if for some e that is more than
   sin(acos(t)); the ``NEAREST`` cells of x are tried as e.  No pair is missed, however the vectors lie.
4. Rows of a (label, cell) meet in blocks of ``BLOCK_BYTES``, each two in just one pair of blocks, so no task ever holds
   more than two blocks however many rows a cell has.  A block pair gives, per row, how many vectors it links to, and
   the edges of a spanning forest: as many rows as it got at most.  Vectors are written once, with their class; they join
   the narrow rows of visits on the way to their blocks, in single precision if they came in it.
5. Components of those edges give the groups.

Defined results: vectors that are null, empty, zero, or hold a null or a non-finite component, and rows whose label is
null, link with nothing and are their own component; vectors of different lengths never link; rows that share a vec_id
count as one node of the link graph; a row whose vec_id is null has links only if an equal one has a vec_id; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, Union, block_pairs, components, map_groups

THRESHOLD = 0.93
CELL_ROWS = 2048  #: classes a cell, on average, at most (beyond MOST_CELLS cells there are more)
MOST_CELLS = 4096
SAMPLE_ROWS = 32_768  #: classes that the cells are fitted on
SAMPLE_VISITS = 2048  #: classes whose visits tell which set of cells leaves the fewest pairs
ROUNDS = 8
NEAREST = 4
BLOCK_BYTES = 1 << 23  #: a block in double precision; the larger, the fewer copies of a vector are shuffled


def kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 3) -> np.ndarray:
    """Unit centroids; an emptied cell is seeded anew with the row that is worst served."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)].copy()
    for _ in range(rounds):
        sims = x @ c.T
        near, best = sims.argmax(axis=1), sims.max(axis=1)
        order = np.argsort(near, kind="stable")
        first = np.flatnonzero(np.diff(near[order], prepend=-1))
        sums = np.zeros_like(c)
        sums[near[order][first]] = np.add.reduceat(x[order], first, axis=0)
        lost = np.flatnonzero(np.bincount(near, minlength=len(c)) == 0)
        if len(lost):
            sums[lost] = x[np.argsort(best, kind="stable")[: len(lost)]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), c)
    return c


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), dims)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def levels(most: int = MOST_CELLS) -> list[int]:
    """The sizes of the sets of cells."""
    out = [1]
    while out[-1] * 4 <= most:
        out.append(out[-1] * 4)
    return out


def cells_of(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(home, visits) of unit vectors: the nearest cell, and whether a partner at home in each cell is possible."""
    sims = x @ c.T
    home = sims.argmax(axis=1)
    visits = np.ones(sims.shape, bool)
    if threshold > 0 and len(c) > 1:
        gaps = np.sqrt(np.maximum(1e-18, 2 - 2 * (c @ c.T)))  # between unit vectors
        np.fill_diagonal(gaps, 1)
        near = np.argpartition(-sims, min(NEAREST, len(c)) - 1, axis=1)[:, :NEAREST]
        for k in range(near.shape[1]):
            e = near[:, k]
            visits &= (sims[np.arange(len(x)), e][:, None] - sims) / gaps[e] <= np.sqrt(1 - threshold**2) + 1e-9
    visits[np.arange(len(x)), home] = True
    return home, visits


def worth(x: np.ndarray, centroids: list[np.ndarray], threshold: float) -> list[int]:
    """For each set of cells the one up to it that leaves the fewest pairs to compare, by the visits of some vectors."""
    out, least = [], np.inf
    for k, c in enumerate(centroids):
        home, visits = cells_of(x, c, threshold)
        each = (visits & (np.arange(len(c))[None, :] >= home[:, None])).sum(axis=0) / len(x)
        work = float((each**2).sum())
        out.append(k if work < least else out[-1])
        least = min(least, work)
    return out


def _visits(classes: DataFrame, centroids: dict[int, list[np.ndarray]], threshold: float) -> DataFrame:
    """(label, dims, cell, home, digest): a row for each cell that a class belongs to or visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch])
            key = t.column("dims").to_numpy().astype(np.int64) * 64 + t.column("level").to_numpy()
            for one in np.unique(key).tolist():
                dims, level = divmod(one, 64)
                some = t.filter(pa.array(key == one)).combine_chunks()
                c = centroids[dims][level]
                step = max(64, (1 << 21) // len(c))
                for at in range(0, len(some), step):
                    part = some.slice(at, step)
                    home, visits = cells_of(_unit(_matrix(part.column("embedding"), dims)), c, threshold)
                    row, cell = np.nonzero(visits & (np.arange(len(c))[None, :] >= home[:, None]))
                    for lo in range(0, len(row), 20_000):
                        r, k = row[lo : lo + 20_000], cell[lo : lo + 20_000]
                        got = part.take(pa.array(r))
                        yield pa.RecordBatch.from_arrays(
                            [got.column(n).combine_chunks() for n in ("label", "dims", "digest")] + [pa.array(k.astype(np.int32)), pa.array(home[r] == k)],
                            names=["label", "dims", "digest", "cell", "home"],
                        )

    return classes.select("label", "dims", "level", "digest", "embedding").mapInArrow(run, f"label {dict(classes.dtypes)['label']}, dims int, digest binary, cell int, home boolean")


def _compare(threshold: float):
    def pair(key: tuple, t: pa.Table) -> dict | None:
        """Links between the blocks of a pair: at least one of the two rows is at home in this cell."""
        i, j = key[-2:]
        dims = t.column("dims")[0].as_py()
        x = _unit(_matrix(t.column("embedding"), dims))
        block, home = t.column("block").to_numpy(), t.column("home").to_numpy()
        rep, n = t.column("rep").to_numpy(), t.column("n").to_numpy()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        links, sets, chunk = np.zeros(len(rep), np.int64), Union(len(rep)), max(16, (1 << 21) // max(1, len(right)))
        for at in range(0, len(left), chunk):
            l_rows = left[at : at + chunk]
            a, b = np.nonzero((x[l_rows] @ x[right].T >= threshold) & (home[l_rows][:, None] | home[right][None, :]))
            a, b = l_rows[a], right[b]
            if i == j:
                a, b = a[a < b], b[a < b]
            if len(a):
                links += np.bincount(a, n[b], len(rep)).astype(np.int64) + np.bincount(b, n[a], len(rep)).astype(np.int64)
                # A star from each row to its first partner would lose links; a forest does not.
                sets.join(a, b)
        has = np.flatnonzero(links)
        if not len(has):
            return None
        return {"rep": rep[has], "links": links[has], "to": rep[sets.roots()[has]]}

    return pair


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS, block: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label)."""
    scratch = Scratch(vectors.sparkSession)
    e = F.col("embedding")
    odd = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(e) > 0) & ~odd & F.exists(e, lambda v: v != 0), F.lit(False))
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.cast("array<float>" if single else "array<double>").alias("embedding"), usable.alias("usable"))
    digest = F.unhex(F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.col("embedding").cast("array<string>")), 256))
    rows = rows.withColumn("digest", F.when(F.col("usable"), digest))
    usable_rows = rows.where("usable")
    classes = usable_rows.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    classes = scratch.cut(classes.where("rep is not null").withColumn("dims", F.size("embedding")), "classes", hashes=True)
    sizes = levels()
    level = F.lit(len(sizes) - 1)
    for k in range(len(sizes) - 2, -1, -1):
        level = F.when(F.col("m") <= sizes[k] * cell_rows, k).otherwise(level)
    by_label = scratch.cut(classes.groupBy("label", "dims").agg(F.count("*").alias("m")).select("label", "dims", level.alias("level")), "labels")
    centroids: dict[int, list[np.ndarray]] = {}
    better: dict[int, list[int]] = {}
    for r in by_label.groupBy("dims").agg(F.max("level").alias("level")).collect():  # one row a vector length
        dims = r["dims"]
        sample = classes.where(F.col("dims") == dims).select("embedding", "digest").orderBy("digest").limit(SAMPLE_ROWS if r["level"] else 1).select("embedding").toArrow()
        x = _unit(_matrix(sample.column("embedding"), dims))
        centroids[dims] = [kmeans(x, n) for n in sizes[: r["level"] + 1]]
        better[dims] = worth(x[:SAMPLE_VISITS], centroids[dims], threshold)
    use = F.col("level")
    for dims, levels_ in better.items():
        for k, best in enumerate(levels_):
            if best != k:
                use = F.when((F.col("dims") == dims) & (F.col("level") == k), best).otherwise(use)
    by_label = by_label.withColumn("level", use)
    visits = scratch.cut(_visits(classes.join(by_label, ["label", "dims"]), centroids, threshold), "visits")
    by = ["label", "dims", "cell"]
    counts = visits.groupBy(*by).agg(F.count("*").alias("m"))
    size = F.greatest(F.lit(1), F.floor(F.lit(BLOCK_BYTES // 8) / F.col("dims"))) if block is None else block
    pairs = block_pairs(visits.join(counts, by), "cell", "digest", "m", size).join(classes.select("digest", "rep", "n", "embedding"), "digest").drop("digest", "m")
    met = scratch.cut(map_groups(pairs, [*by, "block_i", "block_j"], _compare(threshold), "rep long, links long, to long"), "met")
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(scratch, met.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    found = scratch.cut(
        classes.select("digest", "rep", "n").join(links, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select("digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")),
        "found",
    )
    scratch.drop("classes", "labels", "visits", "met", "components")
    out = rows.select("vec_id", "digest").join(found, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
