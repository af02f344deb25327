"""Text cleaning and surface features as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Col = str | Column

# What cleaning removes, in this order.
URLS = r"http\S+|www.\S+"
EMAILS = r"\S+@\S+"
PHONES = r"\b\d{10}\b|\b\d{3}[-.\s]\d{3}[-.\s]\d{4}\b"
NON_LETTERS = r"[^a-zA-Z\s]"
# Accepted length of a message.
MIN_MESSAGE, MAX_MESSAGE = 10, 50_000


def _c(value: Col) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Col) -> Column:
    """Lower-case letters and single spaces; URLs, addresses and phones removed."""
    out = F.lower(_c(value))
    for pattern in (URLS, EMAILS, PHONES, NON_LETTERS):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def words(value: Col) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(_c(value), r"\s+"), lambda w: w != "")


def valid_email_text(value: Col) -> Column:
    v = _c(value)
    return F.coalesce((F.length(F.trim(v)) >= MIN_MESSAGE) & (F.length(v) <= MAX_MESSAGE), F.lit(False))


def surface_features(value: Col) -> dict[str, Column]:
    """Length, words, capitals, marks and their shares."""
    v = _c(value)
    length = F.length(v)
    capitals = F.regexp_count(v, F.lit(r"\p{Lu}"))
    # What is left of the text is counted: a list of all matches is much slower to make.
    special = F.length(F.regexp_replace(v, r"[a-zA-Z0-9\s]+", ""))
    return {
        "length": length,
        "num_words": F.size(words(v)),
        "num_capitals": capitals,
        "num_exclamation": F.regexp_count(v, F.lit("!")),
        "num_question": F.regexp_count(v, F.lit(r"\?")),
        "num_dots": F.regexp_count(v, F.lit(r"\.")),
        "capital_ratio": capitals / (length + 1),
        "special_char_ratio": special / (length + 1),
    }


def word_features(value: Col) -> dict[str, Column]:
    """Word-length statistics, distinct words, diversity and sentence marks."""
    v = _c(value)
    tokens = words(v)
    n = F.size(tokens)
    lengths = F.transform(tokens, lambda w: F.length(w).cast("double"))
    zero = F.lit(0.0)
    mean = F.try_divide(F.aggregate(lengths, zero, lambda a, x: a + x), n)
    squares = F.aggregate(lengths, zero, lambda a, x: a + x * x)
    variance = F.greatest(zero, F.try_divide(squares, n) - mean * mean)
    distinct = F.size(F.array_distinct(tokens))
    return {
        "avg_word_length": F.coalesce(mean, zero),
        "std_word_length": F.when(n > 1, F.sqrt(variance)).otherwise(zero),
        "num_unique_words": distinct,
        "lexical_diversity": distinct / (n + 1),
        "num_sentences": F.regexp_count(v, F.lit(r"[.!?]")),
    }
