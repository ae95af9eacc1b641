"""Odd documents that every operator has to take: NULLs, empty and long texts, repeated rows, clashing names."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for their own columns.
    T.StructField("score", T.StringType()), T.StructField("Shard", T.StringType()), T.StructField("ids", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
])


def row(doc, text, lang="en", source="a"):
    return (doc, text, lang, source, len(text or ""), "x", "y", "z", "k", "w", 7)


LONG = " ".join(f"word{k % 977} and thing{k % 31}" for k in range(40_000))
PLAIN = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions beside a quiet river today"


@pytest.fixture(scope="session")
def odd_rows():
    near = PLAIN.replace("today", "tonight")
    return [
        row(1, None), row(2, ""), row(3, " \t\n "), row(4, PLAIN), row(5, PLAIN.upper()), row(6, near), row(6, near),
        row(None, PLAIN), row(7, LONG), row(8, "one two"), row(9, "one two"), row(10, PLAIN, None, None), row(11, "é" * 3000),
        row(12, "!!! ### $$$"), row(13, "a\x00b \U0001f600"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
