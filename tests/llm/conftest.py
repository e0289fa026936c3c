import pytest

#: Rows that any table may hold: nulls, empty and blank texts, repeated rows and ids, a very long text.
ODD = [
    (None, None, None), (None, "a text without id", "s"), (None, "another text without id", None), (1, None, "s"), (2, "", "s"),
    (3, " \t\n ", "t"), (4, "one", "t"), (5, "two words", "t"), (5, "two words", "t"), (5, "other words of the same id", "t"),
    (6, "größe ünï 日本語 😀 ' don't", "ü"), (7, "word " * 30_000, "t"), (8, "x" * 60_000, "t"), (9, "a\x00b\x1c c d", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with more columns whose names the operators use themselves."""
    rows = [(i, t, "en", s, len(t) if t else None, 1, "k", 2.0, [1]) for i, t, s in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, rank int, key_ string, score double, spans array<int>"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
