import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Odd rows: nulls everywhere, empty and long texts, ties, repeated rows, clashing columns."""
    words = [f"word{i}" for i in range(400)]
    passage = " ".join(words[100:170])
    long = " ".join(words[i * 7 % 400] for i in range(30_000))
    rows = [
        (1, "The cat sat on the mat. " * 3, "en", "b", 72, 0.5, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 0.1, "y"),
        (4, " \n\t ", "en", "a", 4, 0.1, "y"),
        (5, long, "en", "b", len(long), 0.1, "y"),
        (6, "alpha beta " + passage + " omega one", "en", "b", 1, 0.1, "y"),
        (7, "gamma " + passage + " delta two", "de", "c", 1, 0.1, "y"),
        (8, "gamma " + passage + " delta two", "de", "c", 1, 0.1, "y"),
        (8, "gamma " + passage + " delta two", "de", "c", 1, 0.1, "y"),
        (9, "Ünïcödé 漢字 text\u00a0with 'quotes' it's <|endoftext|> \x00\x1c end", "fr", "a", 1, 0.1, "y"),
        (None, "an orphan without an id", "en", "a", 23, 0.1, "y"),
        (10, "one", "en", None, 3, 0.1, "y"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, row string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(documents):
    return documents.where("false")
