import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A ``documents`` table from ``(doc_id, text)`` or longer tuples; missing cells are null."""

    def build(*rows):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def awkward(documents):
    """Nulls, empty and long texts, ties, repeated rows."""
    return documents(
        (1, "the quick brown fox jumps over the lazy dog " * 3, "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog " * 3, "en", "a"),
        (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "fr", "b"), (None, "sans numéro", "fr", None),
        (None, None, None, None), (5, "x" * 20_000, "en", "b"), (6, "mot " * 9000, "fr", ""),
        (7, "\U0001F600 ́ é \x00 <|endoftext|>", None, "a"), (-3, "negative id here", "en", "b"),
    )
