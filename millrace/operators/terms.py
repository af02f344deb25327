"""Token, n-gram and TF-IDF tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import words
from millrace.operators import grams
from millrace.operators.ordered import first_rows, join_on
from millrace.session import pin
from millrace.tables import spread

# Fixed value: a token is two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: str | Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case tokens in order, without stop words."""
    value = F.lower(F.col(text) if isinstance(text, str) else text)
    found = F.regexp_extract_all(value, F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop_words)) if stop_words else found


def ngrams(items: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams of ``low`` to ``high`` items, joined by spaces."""
    parts = []
    for n in range(low, high + 1):
        if n == 1:
            parts.append(items)
        else:
            grams = F.transform(
                F.sequence(F.lit(1), F.size(items) - (n - 1)), lambda i: F.array_join(F.slice(items, i, n), " ")
            )
            parts.append(F.when(F.size(items) >= n, grams).otherwise(F.array().cast("array<string>")))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def term_counts(
    df: DataFrame, doc_id: str, text: str, ngram_range: tuple[int, int] = (1, 1), stop_words: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """(doc, term, tf) rows.

    Texts are spread by document first: the count per document and every later
    step per document then need no exchange of the much larger term rows.
    """
    spread = df.select(doc_id, *by, text).repartition(doc_id)
    listed = spread.select(doc_id, *by, tokens(text, stop_words).alias("_t"))
    terms = listed.select(doc_id, *by, F.explode(ngrams(F.col("_t"), *ngram_range)).alias("term"))
    return terms.groupBy(doc_id, *by, "term").agg(F.count("*").alias("tf"))


def vocabulary(
    counts: DataFrame, documents: DataFrame, max_features: int, min_df: int = 1, max_df: float = 1.0, by: Sequence[str] = ()
) -> DataFrame:
    """(term, df, idf): the most frequent terms among those in enough and not in
    too many documents. Ties go by term."""
    stats = counts.groupBy(*by, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    return _most_frequent(stats, documents, max_features, min_df, max_df, by)


def _most_frequent(
    stats: DataFrame, documents: DataFrame, max_features: int, min_df: int, max_df: float, by: Sequence[str] = ()
) -> DataFrame:
    by = list(by)
    totals = documents.groupBy(*by).agg(F.count("*").alias("n_docs"))
    if by:
        sized = stats.join(totals, by)
    else:
        sized = stats.withColumn("n_docs", totals.select("n_docs").scalar())
    fit = sized.filter((F.col("df") >= min_df) & (F.col("df") <= F.col("n_docs") * max_df))
    order = [F.desc("total"), F.col("term")]
    if by:
        top = first_rows(fit, order, max_features, by)
    else:
        top = fit.orderBy(*order).limit(max_features)
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    return top.select(*by, "term", "df", "total", idf.alias("idf"))


# Terms of a vocabulary that every task may hold.
HELD_TERMS = 100_000


def _apart(listed: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None, int]:
    """The rows that are a document each, those that share one's key with others, and how many more rows than
    documents these are. Only the former can be counted where they lie."""
    many = pin(listed.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"))
    surplus = many.agg(F.sum(F.col("_n") - 1)).first()[0] or 0
    if not surplus:
        return listed, None, 0
    marked = join_on(listed, many, keys)
    return marked.where("_n IS NULL").drop("_n"), marked.where("_n IS NOT NULL").drop("_n"), surplus


def _merged(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per row summed up to counts per document."""
    return counts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def _summed(parts: DataFrame, merged: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """(by, term, total, df) from those of blocks and counts of documents."""
    if merged is not None:
        parts = parts.unionByName(merged.select(*by, "term", F.col("tf").alias("total"), F.lit(1).cast("bigint").alias("df")))
    return parts.groupBy(*by, "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def _counted(
    listed: DataFrame, doc_id: str, max_features: int, ngram_range: tuple[int, int] = (1, 1), min_df: int = 1,
    max_df: float = 1.0, by: Sequence[str] = (),
) -> tuple[DataFrame, list[str], DataFrame, DataFrame | None] | None:
    """Vocabulary, its terms, counts of these per document that is a row of its own, and of the others.
    None where tasks can't hold the terms, or n-grams are asked for per group."""
    keys, by = [doc_id, *by], list(by)
    if max_features > HELD_TERMS or by and tuple(ngram_range) != (1, 1):
        return None
    alone, shared, surplus = _apart(listed, keys)
    if tuple(ngram_range) == (1, 1):
        each = None if shared is None else _merged(
            shared.select(*keys, F.explode("_tokens").alias("term"), F.lit(1).alias("tf")), keys
        )
        stats = _summed(grams.block_totals(alone, by=by), each, by)
    else:
        found = grams.candidates(listed, ngram_range, max_features, min_df, max_df * listed.count(), surplus)
        if found is None:
            return None
        each = None if shared is None else _merged(grams.known_counts(shared, keys, found), keys)
        stats = _summed(grams.known_totals(alone, found), each, by)
    vocab = pin(_most_frequent(stats, listed, max_features, min_df, max_df, by))
    names = sorted({r.term for r in vocab.select("term").distinct().limit(HELD_TERMS + 1).collect()})
    if len(names) > HELD_TERMS:
        return None
    return vocab, names, alone, shared


def tfidf(
    df: DataFrame, doc_id: str, text: str, ngram_range: tuple[int, int] = (1, 3), max_features: int = 5000,
    min_df: int = 2, max_df: float = 0.95, stop_words: Sequence[str] = (), by: Sequence[str] = (),
) -> DataFrame:
    """(doc, term, weight): smoothed TF-IDF with unit-length documents.

    With ``by`` each group of documents gets a vocabulary and weights of its own. Rows of one key are one document.
    """
    by = list(by)
    keys = [doc_id, *by]
    # Written once, as both the vocabulary and the weights read them.
    listed = pin(spread(df).select(*keys, tokens(text, stop_words).alias("_tokens")))
    known = _counted(listed, doc_id, max_features, ngram_range, min_df, max_df, by)
    if known is None:
        counts = pin(term_counts(df, doc_id, text, ngram_range, stop_words, by))
        vocab = vocabulary(counts, df, max_features, min_df, max_df, by)
        return _weighted(counts, vocab, keys, by)
    vocab, names, alone, shared = known
    if by:
        counts = grams.known_counts(alone, keys, names)
        if shared is not None:
            counts = counts.unionByName(_merged(grams.known_counts(shared, keys, names), keys))
        return _weighted(counts, F.broadcast(vocab), keys, by)
    idf = {r.term: r.idf for r in vocab.select("term", "idf").collect()}
    out = grams.known_counts(alone, keys, names, [idf[n] for n in names]).select(*keys, "term", "weight")
    if shared is not None:
        counts = _merged(grams.known_counts(shared, keys, names), keys)
        out = out.unionByName(_weighted(counts, F.broadcast(vocab), keys, by))
    return out


def _weighted(counts: DataFrame, vocab: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    raw = counts.join(vocab, [*by, "term"]).withColumn("_w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*keys)))
    return raw.select(*keys, "term", (F.col("_w") / norm).alias("weight"))


def top_terms(weights: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The ``k`` terms with the largest summed weight per group."""
    sums = weights.groupBy(*by, "term").agg(F.sum("weight").alias("score"))
    w = Window.partitionBy(*by).orderBy(F.round("score", 9).desc(), "term")
    return sums.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def binary_counts(
    df: DataFrame, doc_id: str, text: str, max_features: int = 3000, stop_words: Sequence[str] = ()
) -> DataFrame:
    """(doc, term) rows of the most frequent terms: presence, not counts."""
    listed = pin(spread(df).select(doc_id, tokens(text, stop_words).alias("_tokens")))
    known = _counted(listed, doc_id, max_features)
    if known is None:
        counts = term_counts(df, doc_id, text, (1, 1), stop_words)
        found = counts.join(vocabulary(counts, df, max_features).select("term"), "term")
    else:
        _, names, alone, shared = known
        found = grams.known_counts(alone, [doc_id], names)
        if shared is not None:
            found = found.unionByName(_merged(grams.known_counts(shared, [doc_id], names), [doc_id]))
    return found.select(doc_id, "term", F.lit(1).alias("present"))


def word_frequency(df: DataFrame, text: Column, k: int = 100) -> DataFrame:
    """The ``k`` most frequent words."""
    return (
        df.select(F.explode(words(text)).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "word").limit(k)
    )


def content_tokens(
    df: DataFrame, doc_id: str, text: str, stop_words: Sequence[str], lemmas: DataFrame | None = None, min_length: int = 3
) -> DataFrame:
    """(doc, position, token): tokens long enough and no stop words, replaced by
    their base form where the ``lemmas`` table (form, lemma) knows one."""
    kept = F.filter(tokens(text, stop_words), lambda t: F.length(t) >= min_length)
    rows = df.select(doc_id, F.posexplode(kept).alias("position", "token"))
    if lemmas is None:
        return rows
    forms = lemmas.select(F.col("form").alias("token"), "lemma")
    return rows.join(forms, "token", "left").select(
        doc_id, "position", F.coalesce("lemma", "token").alias("token")
    )
