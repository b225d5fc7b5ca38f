import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, spread over several partitions."""

    def make(rows, extra=""):
        full = [(i, t, "en", "src", None if t is None else len(t), *(["x"] if extra else [])) for i, t in rows]
        return spark.createDataFrame(full, DOCS + (f", {extra} string" if extra else "")).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empties, white space, ties, repeats, long and non-Latin texts."""
    return [(1, "A b c d e f g"), (2, None), (3, ""), (4, " \t\n"), (5, "A b c d e f g"), (5, "A b c d e f g"), (None, "no id here"), (6, "word " * 20000), (7, "日本語 テキスト ñandú Ωmega <|endoftext|> x"), (8, "two  spaces\n\n  and lines \r\n end "), (9, "it's a can't we'll 12345 !!??   x́")]
