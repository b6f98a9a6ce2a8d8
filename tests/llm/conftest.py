import pytest

from stationlake.llm.registry import VOCABULARY

#: Texts that any operator on documents must stand.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \n\t ", "en", "b"),
    (5, "word " * 30_000, "en", "b"),
    (6, "x" * 50_000, "en", None),
    (7, "日本語 émigré naïve 𝒜 <|endoftext|> \u0000 \u0001m", "fr", "a"),
    (8, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (8, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a"),
    (None, "no id here", None, "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with a column that clashes with what operators add."""
    df = spark.createDataFrame(ODD, SCHEMA)
    clashing = ("n_tokens", "ids", "size", "score", "kept", "state", "shard", "id", "h")
    return df.selectExpr("*", *[f"'mine' AS {c}" for c in clashing])


@pytest.fixture(scope="session")
def none(spark):
    """A table of documents without rows."""
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def path():
    return VOCABULARY
