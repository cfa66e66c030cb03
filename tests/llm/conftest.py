from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty texts, repeated rows, and columns whose names clash with results."""
    rows = [
        (1, None), (2, ""), (None, "one two three"), (None, None), (3, "one two three"), (3, "one two three"),
        (4, " \n\t "), (5, "x" * 5000), (6, "😀 ſecret \x1c é" * 40), (7, "a " * 3000),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["k1", "row", "score", "kinds", "n_words", "ids", "item", "coverage", "n_lines", "spans", "votes", "id"]
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("false")
