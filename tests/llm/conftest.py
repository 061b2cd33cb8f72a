import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run int, size long, `key` string, kept string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(30000))
    rows = [
        (1, None, "en", "a", None, 1, 2, "k", "x"),
        (2, "", None, "a", 0, None, None, None, None),
        (3, " \t\n", "en", None, 3, 1, 2, "k", "x"),
        (4, long, "en", "b", len(long), 1, 2, "k", "x"),
        (5, long, "en", "b", len(long), 1, 2, "k", "x"),
        (5, long, "en", "b", len(long), 1, 2, "k", "x"),
        (6, "one two", "en", "b", 7, 1, 2, "k", "x"),
        (7, "One  two ", "en", "c", 9, 1, 2, "k", "x"),
        (8, "one\x0btwo three   password: hunter22 AKIA" + "B" * 16 + " " + "0123456789abcdef" * 2, "en", "c", 9, 1, 2, "k", "x"),
        (None, "one two", "en", "c", 7, 1, 2, "k", "x"),
        (None, None, None, None, None, None, None, None, None),
        (9, "x" * 20000, "en", "c", 7, 1, 2, "k", "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
