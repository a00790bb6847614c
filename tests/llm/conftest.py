import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"

#: Odd texts that every operator must take.
ODD = [
    None, "", " \n\t ", "a", "one two three four", "Ünïcode wörds ×÷ 漢字 and 🙂 emoji \x1c sep",
    "don't we'll I'M 'tis ''s", "x" * 50_000, "word " * 30_000, "line\n" * 2000,
    "<|endoftext|> in the text <|startoftext|>", "\r\n\r\n  spaced   out\u00a0here ",
    "password = hunter2xyz and \ufdd0 token:'abcdefgh'", "a b c d e f g h i j",
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, a row without id, repeated rows, and columns with the operators' names."""
    rows = [(i, text) for i, text in enumerate(ODD)]
    rows += [(None, "a b c d e f g h i j"), (13, "a b c d e f g h i j"), (99, "a b c d e f g h i j")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    clashing = ("print", "kinds", "bucket", "cluster", "size", "toxic", "spans", "length", "task",
                "rep", "component_id", "words", "hash", "item_id")
    extra = {name: F.lit("clash") for name in clashing}
    return df.withColumns({**extra, "lang": F.lit("en"), "source": F.lit(None).cast("string"),
                           "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
