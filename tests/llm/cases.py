"""Small tables with everything that operators must stand."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # extra columns under names that operators use themselves
        T.StructField("size", T.StringType()),
        T.StructField("gram", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("_metadata", T.StringType()),
        T.StructField("a.b", T.IntegerType()),
        T.StructField("__row_file", T.StringType()),
        T.StructField("__Row_Pos", T.LongType()),
        T.StructField("__text", T.LongType()),
        T.StructField("__words", T.StringType()),
        T.StructField("given__words", T.StringType()),
    ]
)

WORDS = "the quick brown fox jumps over lazy dogs while seven grey wolves sleep near old mills and rivers run down".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ing", "ed"]) for _ in range(words))


def messy_rows() -> list[tuple]:
    """doc_id, text, lang, source: nulls in every column, empty and long texts, ties, repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 80), "en", "b"),
        (2, prose(2, 80), "en", "a"),
        (3, prose(2, 80).replace(" ", "\n"), "de", "a"),
        (4, prose(2, 80) + "  \t", "en", None),
        (5, "", "en", "a"),
        (6, None, "en", "a"),
        (7, " \n\t\x0b", None, "b"),
        (8, long, "en", "é"),
        (9, "ünïcödé 😀 text 漢字 <|endoftext|> of words", "fr", "é"),
        (9, "ünïcödé 😀 text 漢字 <|endoftext|> of words", "fr", "é"),
        (None, prose(3, 40), "en", "b"),
        (None, prose(3, 40), "en", "b"),
        (None, None, None, None),
        (12, "one", "en", "b"),
        (13, "one two three four", "en", "b"),
        (14, "x" * 70_000, None, "a"),
        (-5, "a b  c", "en", ""),
    ]
    return rows + [(100 + i, prose(50 + i % 12, 20 + 3 * (i % 12)), ["en", "de"][i % 2], ["a", "b", None][i % 3]) for i in range(40)]


def frame(spark, rows):
    full = [(*r, None if r[1] is None else len(r[1]), "s", 1, 2, i % 2 == 0, "m", i, "f", -1, 7, "w", "g") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def messy(spark):
    return frame(spark, messy_rows())


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
