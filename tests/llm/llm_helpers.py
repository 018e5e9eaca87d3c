"""Small tables with the odd rows every operator must take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
WORDS = {"en": "the of and to in that is for with was on are as by this from have not be it".split(),
         "de": "der die und das ist nicht mit dem von auf ein eine für wird sich auch als über".split()}


def docs_frame(spark, rows, partitions=3):
    """Rows (doc_id, text, lang, source) as a documents table."""
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(partitions)


def prose(seed, words=40, lang="en"):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS[lang]) + pick.choice(["", "", "er", "ing", "en"]) for _ in range(words))


def odd_rows():
    """NULLs in every column, empty, blank and very long texts, repeated rows, non-ASCII."""
    rows = [(1, prose(1), "en", "a"), (1, prose(1), "en", "a"), (2, None, "en", "a"), (3, "", None, None),
            (None, prose(2), "de", "b"), (None, None, None, None), (4, " \t\n\x0b ", "en", "a"),
            (5, prose(3, 30_000), "en", "b"), (6, "Ünï 😀 ▁x " + prose(4), "de", "c"), (7, "one two", "en", "c"),
            (8, "x" * 50_000, "en", "c"), (9, "1" * 30_000, "en", "c"), (10, "a@" * 5_000, "en", "c")]
    return rows + [(20 + i, prose(i % 7, 60, "de" if i % 2 else "en"), "de" if i % 2 else "en", "abc"[i % 3])
                   for i in range(30)]
