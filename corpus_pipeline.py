"""The corpus pipeline: five stages over ``documents``, each of which keeps, changes or drops rows for the next.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.  ``run`` applies them
in order; each stage's rows are written as Parquet in the shared folder and read again as the next one's ``docs``.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import language, lines, mixing, ngrams, packing
from tallyloom.llm.common import Scratch, made, sweep, table

#: Documents whose language is less sure than this go.
LEAST_SCORE = 0.5
#: Lines of which more than this share differs from an earlier one stay: two edits make another line of a short one.
EDITED_SHARE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language the network is unsure of, go; ``lang`` becomes the prediction.

    Null and empty texts have no letter, so they go.  A score of LEAST_SCORE stays; of two languages with equal scores the
    first by name is taken; repeated rows are judged alike; without a known language to learn from all documents go.
    """
    model = language.train(docs, language.remainder(4) != 2)
    return language.keep_known(docs, model, LEAST_SCORE)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line, within the edit threshold and a tenth of their length, go; documents left without a line go.

    Null texts stay, empty lines are no repetition; the first line is the one of the least doc_id (nulls last), then of
    the least place; rows with equal doc_ids share places, so what stands at one place of both stays in both.
    """
    return lines.remove(docs, share=EDITED_SHARE)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays.

    It is the one of the least doc_id (nulls last), then of the least digest; of repeated rows one stays; texts without a
    word, null ones too, are in no class and stay.
    """
    return ngrams.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the last repetition of a document at a source's cut is its first words.

    A null source is a source; documents without words, null ones too, are taken no time; repeated rows share evenly.
    """
    return mixing.repeat(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per piece its sequence and place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone; each row is packed, repeated ones as often as they occur; ties among
    lengths go by doc_id, piece and crc.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the recurrent network nor the tokenizer; the whole pipeline is tested against plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order.  When a stage's rows are written, what it wrote on the way is deleted."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        begun = made()
        docs = scratch.cut(stage(spark, docs, sf_dir), f"stage{k}")
        sweep(spark, begun, scratch.paths[f"stage{k}"])
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
