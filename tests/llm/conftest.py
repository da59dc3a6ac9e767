"""The operators of ``freshet.llm`` against brute force; the session comes from the folder above."""

import pytest

DOCS = "doc_id long, text string, _k string, name string, n int"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text) as documents with more columns, whose names the operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(k, t, "x", None, 1) for k, t in rows], DOCS).repartition(3)

    return make


LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
# Nulls, empty and blank texts, ties, repeated rows and ids, a missing id, a very long text, one word over and over.
EDGES = [
    (1, LONG * 2), (2, LONG), (2, LONG), (3, None), (4, ""), (5, " \n\t "), (6, "x " + LONG + "y"), (7, "a " * 60), (8, "a " * 20 + "b"),
    (None, LONG), (9, "é" * 60 + LONG[:70]), (10, "é" * 60), (11, "one"), (2, "another text of the same id " + LONG[:80]), (12, "ab" * 100), (13, "ba" * 40),
    (14, (LONG * 400)), (15, "The End"), (16, "the end"), (17, "zzz 漢字 😀 " * 3),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES
