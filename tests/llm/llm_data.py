"""Small tables with the awkward cases that every operator has to take."""

import random

from pyspark.sql import types as T

WORDS = "the of and to in that was for with his they this from have not are but had by which one".split()

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def prose(n, seed=0, words=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + (rng.choice("abcdefgh") * rng.randint(0, 2)) for _ in range(n))


def awkward():
    """Nulls, empty, blank and very long texts, ties, copies, a repeated row."""
    long = prose(60_000, 9)
    rows = [
        (1, prose(80, 1), "en", "a"), (2, prose(80, 1), "en", "b"), (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "fr", "a"),
        (6, long, "de", "a"), (7, long + " end", "de", "a"), (8, "one two three", "en", "a"), (9, "one two three", None, "c"),
        (10, "12 34 !!", "en", None), (11, prose(300, 3), "fr", "a"), (11, prose(300, 3), "fr", "a"), (12, "x" * 70_000, "en", "a"),
        (13, "日本語 テスト。 naïve café — “q”   z\x1cw", "en", "a"), (14, prose(300, 3) + " tail", "fr", "b")]
    return [(i, t, l, s, None if t is None else len(t)) for i, t, l, s in rows]


def docs_of(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, DOCS)


def clashing(df):
    """Extra columns with names that operators use inside or return."""
    from pyspark.sql import functions as F

    names = ["kept", "size", "path", "uid", "tokens", "shard", "slot", "keep_id", "group_size", "text_sha256", "group", "part", "ids", "perplexity", "component", "links"]
    return df.withColumns({n: F.lit("x") for n in names})
