import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, id long, row long, __block0 long, score double, blob string"


def rows(pairs):
    """(doc_id, text, source) with other columns whose names operators use too."""
    return [(i, t, None, s, None, None, None, None, None, None, None, "x") for i, t, s in pairs]


@pytest.fixture(scope="session")
def docs(spark):
    """Makes a documents table of (doc_id, text, source)."""
    return lambda pairs: spark.createDataFrame(rows(pairs), SCHEMA).repartition(3)


LONG = " ".join(f"word{i % 9173}x{i % 31}" for i in range(40_000))
EDGES = [
    (1, None, "a"), (2, "", "a"), (3, "", None), (4, "one two three", "b"), (4, "one two three", "b"), (5, "one two three", "c"),
    (6, LONG, "b"), (7, LONG, "c"), (None, "no id here", "a"), (None, None, None), (8, " \t\r\n ", "a"), (9, "é ü K \U0001f600 x y", "c"),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES
