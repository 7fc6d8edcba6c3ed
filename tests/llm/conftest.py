import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven eight nine ten", "en", "a"),
        (2, "ONE two three four five six seven eight nine ten", "en", None),
        (3, None, "en", "a"), (4, "", None, "b"), (5, "   \n\t ", "de", "b"),
        (6, "alone", "fr", "c"), (7, "alone", "fr", "c"), (6, "alone", "fr", "c"),
        (None, "alone", None, None), (None, None, None, None), (None, None, None, None),
        (8, long_text, "en", "a"), (9, long_text, "en", "a"), (10, "naïve Ünïcode words 😀 <|im_end|>", "es", "d"),
        (11, "mail a.b@c.example.com or 10.0.0.1, card 4111 1111 1111 1111, call +1 (555) 010-9999", "en", "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    # extra columns named like those the operators make
    return (df.selectExpr("*", "cast(length(text) as bigint) as n_chars", "1 as key", "'x' as h", "2 as n",
                          "3 as `set`", "true as kept", "'z' as spans", "5 as g", "6 as fold"))


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
