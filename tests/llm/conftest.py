import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, keep_id long, __digest string, fingerprint string, "
    "bucket int, label string"
)
PROSE = "the quick brown fox jumps over the lazy dog near a quiet river while seven old men watch the water rise"


@pytest.fixture(scope="session")
def awkward(spark):
    """NULLs in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    extra = (7, "x", "y", 1, "z")
    rows = [
        (1, PROSE, "en", "s", 5, *extra),
        (2, PROSE.upper(), "en", "s", 5, *extra),
        (3, PROSE + " ÄÖ", "en", "s", 5, *extra),
        (3, PROSE + " ÄÖ", "en", "s", 5, *extra),
        (4, PROSE + " äö", None, None, None, None, None, None, None, None),
        (5, "", "en", "s", 0, *extra),
        (6, None, None, None, None, *extra),
        (None, "text without an id", "en", "s", 5, *extra),
        (None, "text without an id", "en", "s", 5, *extra),
        (None, None, None, None, None, None, None, None, None, None),
        (8, "one", "en", "s", 3, *extra),
        (9, "one two", "en", "s", 7, *extra),
        (10, " ".join(f"w{i % 977}" for i in range(60_000)), "en", "s", 1, *extra),
        (11, "Orre " * 3000, "en", "s", 1, *extra),
        (12, "12 34 !!!", "en", "s", 1, *extra),
        (13, "a" * 40_000, "en", "s", 1, *extra),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
