from __future__ import annotations

import zlib

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])

#: nulls in any column, empty and long texts, ties, repeated rows
ODD_ROWS = [
    (7, "The cat sat on the mat, and it's fine.", "en", "a", 10),
    (7, "The cat sat on the mat, and it's fine.", "en", "a", 10),
    (3, None, None, None, None),
    (None, "null id here 123 abc", "en", "b", 3),
    (None, None, None, None, None),
    (5, "", "de", "a", 0),
    (6, " \n\t ", "de", "a", 0),
    (9, "été où la ñ ΟΔΟΣ <|endoftext|> \x1c x", "fr", "a", 1),
    (11, "long words here " * 3000, "en", "a", 1),
    (12, "z" * 30000, None, "a", 1),
    (13, "### &&& 123", "en", "c", 1),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The rows above with extra columns named like ones the operators make."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA).selectExpr(
        "*", "1 AS score", "'x' AS hits", "2 AS length", "3 AS rank", "'k' AS key", "4 AS shard", "5 AS id", "6 AS component_id"
    )


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def crc_mod(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus
