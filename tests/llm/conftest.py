from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, one id twice, and columns whose names clash."""
    rows = [
        (1, "One line.\nTwo lines.\nThree lines.\nFour lines.", "en", "src1", 1, "k", 5),
        (1, "One line.\nTwo lines.\nThree lines.\nFour lines.", "en", "src1", 1, "k", 5),
        (2, None, "en", "src1", None, None, None),
        (3, "", None, "src2", 0, "k", 5),
        (4, " \t\n\r\n  ", "de", None, 7, "k", 5),
        (5, "other text with the same id as the next row and more", "xx", "a.example.org", 1, "k", 5),
        (5, "One line.\nTwo lines.\nThree lines.\nFour lines.", "en", "b.example.org", 1, "k", 5),
        (None, "Zero.\nTwo lines.\nThree lines.\nFour lines.\nFive.", "en", "src1", 1, None, 5),
        (None, None, None, None, None, None, None),
        (6, LONG, "en", "src3", len(LONG), "k", 5),
        (7, "é 😀 <|endoftext|> x y ﬁ İ ß", "fr", "src3", 9, "k", 5),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `KEY` string, `start` int")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
