"""Driver queries of the ten operators and the pipeline, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, language, lines, media, mixing, ngrams, packing, pii, quality, urls
from .common import table
from .language import remainder


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality", remainder(3) != 1)
    scored = quality.score(docs, model)
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.near_duplicates(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_columns(pii.find(table(spark, sf_dir, "documents")))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs, remainder(4) != 2)
    return language.predict(docs, model).select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.report(table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(c, ",", "null").alias(c)
    return found.select("doc_id", "n_lines", "n_links", "n_removed", listed("removed"), listed("kept_by"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_embedding_near_dedup, op2_quality_classifier, op3_url_filters, op4_ngram_jaccard_join, op5_best_fit_packing, op6_pii, op7_mixing, op8_media_columns, op9_language_id, op10_line_dedup)}


#: All pairs of vectors with equal labels, then what links reach.
_OP1 = """WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT vec_id AS n, vec_id AS c FROM e UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.n),
m AS (SELECT n, min(c) AS c FROM r GROUP BY n), k AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, m.c AS component_id, vec_id = m.c AS kept FROM e JOIN m ON m.n = vec_id LEFT JOIN k ON k.a = vec_id"""

#: All pairs of documents that share a run of five words, by the sizes of their sets.
_OP4 = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS run FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY 1, 2),
p AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
r AS (SELECT doc_id AS n, doc_id AS c FROM documents UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.n), m AS (SELECT n, min(c) AS c FROM r GROUP BY n), k AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT doc_id, m.c AS class_id, coalesce(k.n, 0) AS n_links, doc_id = m.c AS kept FROM documents JOIN m ON m.n = doc_id LEFT JOIN k ON k.a = doc_id"""

#: All pairs of line forms of nearly equal lengths that share a third somewhere, by their edit distance.  That function
#: counts bytes, so the tables' letters with marks go by capitals, which no form has.
_OP10 = r"""WITH RECURSIVE t AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(range(len(lines))) AS pos, trim(regexp_replace(lower(unnest(lines)), '[ \t\v\f\r]+', ' ', 'g')) AS f FROM t),
g AS (SELECT f, length(f) AS n, length(f) // 3 AS q, min(CAST(doc_id AS HUGEINT) * 4294967296 + pos) AS first FROM l WHERE f <> '' GROUP BY f),
h AS (SELECT a.f AS a, b.f AS b FROM (SELECT *, unnest([n - 2, n - 1, n, n + 1, n + 2]) AS near FROM g WHERE n > 2) a JOIN g b ON b.n = a.near AND a.f <> b.f AND b.n > 2
  WHERE (contains(b.f, left(a.f, a.q)) OR contains(b.f, substr(a.f, a.q + 1, a.q)) OR contains(b.f, substr(a.f, 2 * a.q + 1))) AND levenshtein(translate(a.f, 'éóèñüçäöêßí', 'ABCDEFGHIJK'), translate(b.f, 'éóèñüçäöêßí', 'ABCDEFGHIJK')) <= 2),
p AS (SELECT a, b FROM h UNION SELECT b, a FROM h), r AS (SELECT f AS n, f AS c FROM g WHERE f IN (SELECT a FROM p) UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.n),
c AS (SELECT n, min(c) AS c FROM r GROUP BY n), keep AS (SELECT g.f, min(g.first) OVER (PARTITION BY coalesce(c.c, g.f)) AS keeper FROM g LEFT JOIN c ON c.n = g.f), d AS (SELECT a, count(*) AS n FROM p GROUP BY a),
x AS (SELECT doc_id, pos, coalesce(d.n, 0) AS links, CAST(doc_id AS HUGEINT) * 4294967296 + pos <> keeper AS gone, CAST(keeper // 4294967296 AS BIGINT) AS kept_in FROM l JOIN keep USING (f) LEFT JOIN d ON d.a = f)
SELECT o.doc_id, CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS n_lines, CAST(coalesce(sum(links), 0) AS BIGINT) AS n_links, count(*) FILTER (WHERE gone) AS n_removed,
coalesce(string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE gone), '') AS removed, coalesce(string_agg(CAST(kept_in AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE gone), '') AS kept_by FROM documents o LEFT JOIN x ON x.doc_id = o.doc_id GROUP BY o.doc_id, text"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; all pairs, so for tables on which that ends."""
    return {"op1_embedding_near_dedup": _OP1, "op4_ngram_jaccard_join": _OP4, "op7_mixing": mixing.ORACLE_SQL, "op10_line_dedup": _OP10}
