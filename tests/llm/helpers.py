"""Small tables with the awkward cases that every operator must bear."""

from __future__ import annotations

import random

SMOKE = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sentence(rng, n=12):
    return " ".join(rng.choice(("the", "of", "and")) if rng.random() < 0.4 else "".join(rng.choice("aeioubdfgklmnprst") for _ in range(rng.randint(3, 9)))
                    for _ in range(n)) + "."


def awkward_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, near copies."""
    rng = random.Random(5)
    long = " ".join(sentence(rng) for _ in range(4000))
    copy = " ".join(sentence(rng) for _ in range(40))
    rows = [(1, copy, "en", "a", len(copy)), (2, copy + " tail", "en", "b", 0), (3, copy, "en", "a", len(copy)), (3, copy, "en", "a", len(copy)),
            (4, None, None, None, None), (None, sentence(rng), "en", "a", 3), (None, None, None, None, None), (5, "", "en", "b", 0),
            (6, long, "en", "a", len(long)), (7, "\x00\t \n", "en", None, 4), (8, "ß é 漢字 😀 token = abcdef123", "de", "c", 9)]
    rows += [(100 + i, sentence(rng, 30), rng.choice(["en", "de"]), rng.choice("abc"), None) for i in range(20)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(df):
    """The same with columns named as the operators' own."""
    from pyspark.sql import functions as F
    for c in ("spans", "score", "fp", "_text", "k_0", "in_0", "src", "_row", "copy_no", "hits", "n_assign", "component_id", "_id", "rate", "vec"):
        df = df.withColumn(c, F.lit(c))
    return df


def empty(spark, df):
    return spark.createDataFrame([], df.schema)
