import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table of (doc_id, text[, source]) rows, with extra columns whose names clash with internal ones."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        return df.selectExpr("*", "1 AS n", "'x' AS fp", "2 AS part", "3 AS bin", "4 AS size", "5 AS shard", "6 AS key", "'y' AS n_tokens")

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i} of the long text." for i in range(20_000))
    return [(1, None, "a"), (2, "", "a"), (3, long, None), (4, "one two  three\tfour\n\n five", "b"), (5, "same text here", "b"), (5, "same text here", "b"), (6, "same text here", None), (None, "no id", "c"), (None, None, None), (7, "   \n ", "a"), (8, "<|endoftext|> café naïve 漢字  x \U0001f600!", "b")]
