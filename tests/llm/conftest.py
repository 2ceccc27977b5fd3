from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
LONG = " ".join(f"word{i % 977} x{i % 13}" for i in range(40_000))
# NULLs in every column, empty and blank texts, a very long text, ties and repeated rows.
MESSY = [
    (1, "Alpha beta GAMMA delta epsilon", "en", "b", 30), (2, "alpha BETA gamma delta epsilon", "en", "a", 30),
    (3, None, None, None, None), (4, "", "", "", 0), (5, " \t\n ", "en", "a", 4), (6, LONG, "en", "a", len(LONG)),
    (7, "É eins", "de", "b", 6), (8, "é eins", "de", "b", 6), (None, "no key here at all", "en", "c", 5),
    (None, "no key here at all", "en", "c", 5), (None, None, None, None, None), (9, "same row", "en", "a", 8),
    (9, "same row", "en", "a", 8), (9, "other text, same key", "en", "b", 9), (10, "one\r\ntwo\n\nthree   four\x0bfive", "en", "b", 9),
    (11, "emoji \U0001F600\U0001F601 and 漢字 words", "zh", "d", 20), (-12, "minus", "en", "a", 5),
]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(MESSY, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture()
def make_docs(spark):
    """Documents from texts, numbered from 0, or from (doc_id, text) or (doc_id, text, source)."""
    def make(*rows):
        full = [(i, row) if isinstance(row, str) or row is None else row for i, row in enumerate(rows)]
        return spark.createDataFrame(
            [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in full], SCHEMA)
    return make
