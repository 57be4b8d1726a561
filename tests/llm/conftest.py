import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, pii string, shard string, score string, key string"


def row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, len(text or ""), "x", "y", "z", "w", "k")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, blanks, repeated rows, ties, a very long word and a long text, and columns whose names clash."""
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \t\n\x0b\x0c\r "),
        row(4, "one"),
        row(5, "two words"),
        row(6, "Mail a.b@c.de or call +1 (555) 010-9999, card 4111 1111 1111 1111 \U0001f600 x@y.zz"),
        row(6, "Mail a.b@c.de or call +1 (555) 010-9999, card 4111 1111 1111 1111 \U0001f600 x@y.zz"),
        row(7, "x" * 120_000),
        row(8, "the quick brown fox jumps over the lazy dog " * 4_000, None, None),
        row(9, "The quick brown fox JUMPS over the lazy dog " * 4_000, "en", None),
        row(None, "nobody's text of some length here", None, "s1"),
        row(None, None, None, None),
        row(10, "12345 !!! ... 1.2.3.4 999.1.1.1 GB82 WEST 1234 5698 7654 32"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
