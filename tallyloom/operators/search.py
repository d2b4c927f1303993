"""Vector search over chunks of text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions.money import cosine
from ..functions.text import chunks


def index_texts(texts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(source_id, chunk_index, chunk, hash) of the chunks that the index does not hold as they are."""
    cut = texts.select("source_id", F.posexplode(chunks("text")).alias("chunk_index", "chunk"))
    cut = cut.withColumn("hash", F.sha2("chunk", 256))
    return cut if known is None else cut.join(known.select("source_id", "chunk_index", "hash"), ["source_id", "chunk_index", "hash"], "left_anti")


def stale(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Chunks of the index that a shorter text no longer has."""
    now = texts.select("source_id", F.posexplode(chunks("text")).alias("chunk_index", "chunk"))
    return known.join(now.select("source_id", "chunk_index"), ["source_id", "chunk_index"], "left_anti")


def top_k(vectors: DataFrame, query: list[float], k: int = 10, where: Column | None = None, prefetch: int = 5, rerank: Column | None = None) -> DataFrame:
    """The k nearest by cosine (ties by id): one pass, of which each task keeps k rows.  With ``rerank`` the first
    k * prefetch are ordered anew by that column."""
    found = vectors if where is None else vectors.where(where)
    found = found.withColumn("score", cosine(F.col("embedding"), F.array(*map(F.lit, query)))).where("score is not null")
    order = (F.col("score").desc(), F.col("vec_id").asc())
    if rerank is None:
        return found.orderBy(*order).limit(k)
    return found.orderBy(*order).limit(k * prefetch).withColumn("reranked", rerank).orderBy(F.col("reranked").desc_nulls_last(), F.col("vec_id").asc()).limit(k)


def hash_embedding(texts: Sequence[str], dims: int = 64) -> list[list[float]]:
    """Unit vectors from hashed words: an embedding that needs no model, for tests and machines without one."""
    import zlib

    out = np.zeros((len(texts), dims))
    for i, text in enumerate(texts):
        for word in text.lower().split():
            h = zlib.crc32(word.encode())
            out[i, h % dims] += 1 if h & 0x10000 else -1
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.where(norms > 0, norms, 1)).tolist()


def embedder(call: Callable[[Sequence[str]], list[list[float]]] = hash_embedding, size: int = 32, threads: int = 4):
    """A column function that embeds texts in batches of ``size``, several at a time, in order; null texts stay null.

    A batch that fails among others is tried once more alone; if it fails again, so does the task, which Spark repeats.
    """

    @F.pandas_udf(ArrayType(DoubleType()))
    def embed(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with ThreadPoolExecutor(threads) as pool:
            for texts in series:
                known = texts.dropna()
                parts = [known.iloc[k : k + size].tolist() for k in range(0, len(known), size)]
                waiting = [pool.submit(call, p) for p in parts]
                vectors = [v for p, f in zip(parts, waiting) for v in (f.result() if f.exception() is None else call(p))]
                yield pd.Series(vectors, index=known.index, dtype=object).reindex(texts.index).where(lambda x: x.notna(), None)

    return embed


def with_metadata(texts: DataFrame, required: Sequence[str] = ("tenant_id", "source_id", "kind", "title", "updated_at")) -> DataFrame:
    """Texts with what an index must know of each; a missing column is refused now, a null when its row is read."""
    if missing := [c for c in required if c not in texts.columns]:
        raise ValueError(f"missing {missing}")
    for c in required:
        texts = texts.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is null"))).otherwise(F.col(c)))
    return texts


def retrieve(
    vectors: DataFrame, query: list[float], tenant: str, client: str | None = None, k: int = 10, where: Column | None = None, prefetch: int = 5, rerank: Column | None = None,
    store: Callable[[str, list[float], int], list[tuple[int, float]]] | None = None,
) -> DataFrame:
    """The k nearest of a tenant's vectors (vec_id, embedding, tenant_id, client_id), with ``source``: store or table.

    An outer store is asked first, for it needs a client's namespace; without one, without a client, or when it fails
    or knows nothing, the table answers.  What the store names is read from the table, so other tenants' rows never come.
    Where ``rerank`` is null for all, the order by cosine stays.
    """
    mine = vectors.where(F.col("tenant_id") == tenant)
    if client is not None:
        mine = mine.where(F.col("client_id") == client)
    if store is not None and client is not None:
        try:
            hits = store(f"{tenant}/{client}", query, k * prefetch if rerank is not None else k)
        except Exception:  # noqa: BLE001 - the table holds the same vectors
            hits = []
        if hits:
            mine = mine.where(F.col("vec_id").isin([i for i, _ in hits]))
            return top_k(mine, query, k, where, prefetch, rerank).withColumn("source", F.lit("store"))
    return top_k(mine, query, k, where, prefetch, rerank).withColumn("source", F.lit("table"))
