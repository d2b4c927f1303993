"""Small tables with the rows that break things."""

LONG = "word and more text here " * 8000
AWKWARD = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 10),
    (2, "the quick brown fox jumps over the lazy dog again and again", "en", "b", None),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "fr", "b", 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "123 456 !!!", None, "é", 1),
    (8, "日本語 \U0001f600 é", "de", "b", 2),
    (None, "a row without an id that has five words", "fr", "a", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns named as the operators name theirs inside.
CLASHES = ["digest", "sig", "rep", "n", "m", "key", "block", "size", "h", "sk", "id", "forms", "pos", "label_", "score"]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    for c in CLASHES:
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
