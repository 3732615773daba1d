import pytest

TEXT = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """Rows with nulls, empty texts, repeated rows, repeated ids and columns that clash with results."""
    prose = "The quick brown fox jumps over the lazy dog while nineteen calm readers watch from a small wooden bridge near town. "
    rows = [
        (1, prose * 3, "kept"),
        (2, None, None),
        (3, "", "x"),
        (4, prose * 3, "y"),
        (4, prose * 3, "y"),
        (5, prose + "extra words follow here", None),
        (5, "another text under the same id with a mail to jane.doe@example.org in it", None),
        (None, prose * 3, "z"),
        (None, None, None),
        (6, " \t\n ", "q"),
        (7, "é ünïcode Ωmega 日本語 <|endoftext|> 👍🏽 don't stop 12345", "q"),
        (8, "word " * 5000 + "a" * 5000, "long"),
        (9, "THE QUICK  brown\tfox", None),
        (10, "The quick brown fox", None),
    ]
    return spark.createDataFrame([(i, t, x, x, 1, x) for i, t, x in rows], "doc_id long, text string, kept string, id string, print int, hash string")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], TEXT)
