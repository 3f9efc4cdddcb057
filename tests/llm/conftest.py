import pytest


@pytest.fixture
def documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash with those of the operators."""
    long = "wort " * 60_000 + "\n" + "x" * 30_000
    rows = [
        (5, "The same line of text\nalone one", "en", 1), (3, "the same line of TEXT  \nalone two", "en", 2),
        (5, "The same line of text\nalone one", "en", 1), (9, None, None, 3), (10, "", "de", 4), (11, " \t\n ", "fr", 5),
        (None, "The same line of text\nno id", "en", 6), (12, long, "de", 7), (13, long, "de", 8), (14, "Éa même LIGNE\nÉa même ligne", "fr", 9),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, position int").selectExpr(
        "*", "1 as n", "2 as `lines`", "3 as gone", "4 as `id`", "5 as found", "6 as bucket", "7 as `an odd.name`")
