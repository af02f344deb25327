"""Text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import text as tx
from millrace.operators import aggregate as agg
from millrace.operators import terms
from millrace.plans.sales import _round
from millrace.registry import query
from millrace.tables import documents, table

# A short list for the checks; callers pass their own.
STOP_WORDS = ("the", "and", "of", "to", "in", "is", "it", "for", "on", "with", "as", "at", "by", "an", "be", "or",
              "that", "this", "was", "are", "from")
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"


def _clean_sql(value):
    out = f"lower({value})"
    for pattern in (tx.URLS, tx.EMAILS, tx.PHONES, tx.NON_LETTERS):
        out = f"regexp_replace({out}, '{pattern}', '', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


@query("clean_text", "TXT-01 TXT-10", f"""
SELECT doc_id, {_clean_sql("text")} AS cleaned_text FROM documents""")
def clean_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", tx.clean_text("text").alias("cleaned_text"))


@query("clean_urls_and_mail", "TXT-01", f"""
SELECT page_id, {_clean_sql("'See ' || url || ' or Mail a' || page_id || '@x.org, call 555-123-4567 now!!'")} AS cleaned
FROM pages""")
def clean_urls_and_mail(spark, sf_dir):
    message = F.concat(F.lit("See "), "url", F.lit(" or Mail a"), F.col("page_id").cast("string"),
                       F.lit("@x.org, call 555-123-4567 now!!"))
    return table(spark, sf_dir, "pages").select("page_id", tx.clean_text(message).alias("cleaned"))


def _count(pattern):
    return f"len(regexp_extract_all(text, '{pattern}'))"


_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


@query("surface_features", "TXT-02", rf"""
SELECT doc_id, length(text) AS length, len({_WORDS}) AS num_words, {_count(r'\p{Lu}')} AS num_capitals,
  {_count('!')} AS num_exclamation, {_count(r'\?')} AS num_question, {_count(r'\.')} AS num_dots,
  round({_count(r'\p{Lu}')} / (length(text) + 1), 6) AS capital_ratio,
  round({_count(r'[^a-zA-Z0-9\s]')} / (length(text) + 1), 6) AS special_char_ratio
FROM documents""")
def surface_features(spark, sf_dir):
    cols = [c.alias(n) for n, c in tx.surface_features("text").items()]
    return _round(documents(spark, sf_dir).select("doc_id", *cols), 6)


@query("word_features", "TXT-03", rf"""
WITH w AS (SELECT doc_id, text, {_WORDS} AS ws FROM documents),
l AS (SELECT *, list_transform(ws, lambda x: length(x)) AS ls FROM w)
SELECT doc_id, round(coalesce(list_avg(ls), 0), 6) AS avg_word_length,
  round(CASE WHEN len(ls) > 1 THEN list_stddev_pop(ls) ELSE 0 END, 6) AS std_word_length,
  len(list_distinct(ws)) AS num_unique_words, round(len(list_distinct(ws)) / (len(ws) + 1), 6) AS lexical_diversity,
  {_count('[.!?]')} AS num_sentences
FROM l""")
def word_features(spark, sf_dir):
    cols = [c.alias(n) for n, c in tx.word_features("text").items()]
    return _round(documents(spark, sf_dir).select("doc_id", *cols), 6)


@query("labelled_text", "TXT-10", f"""
SELECT doc_id, {_clean_sql("text")} AS cleaned_text, len({_WORDS}) AS num_words,
  CASE label WHEN 'ham' THEN 0 WHEN 'spam' THEN 1 END AS label_encoded
FROM (SELECT d.doc_id, text, CASE toxic WHEN 1 THEN 'spam' ELSE 'ham' END AS label FROM documents d JOIN labels USING (doc_id))""")
def labelled_text(spark, sf_dir):
    docs = _labelled(spark, sf_dir).withColumn("label", F.when(F.col("toxic") == 1, "spam").otherwise("ham"))
    return docs.select(
        "doc_id", tx.clean_text("text").alias("cleaned_text"), F.size(tx.words("text")).alias("num_words"),
        F.when(F.col("label") == "ham", 0).when(F.col("label") == "spam", 1).alias("label_encoded"),
    )


def _labelled(spark, sf_dir):
    return documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")


@query("content_tokens", "TXT-04 UDF-04", rf"""
WITH t AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{terms.TOKEN}'),
    lambda w: w NOT IN {_STOP_SQL} AND length(w) >= 3) AS ts FROM documents),
e AS (SELECT doc_id, unnest(range(len(ts))) AS position, unnest(ts) AS token FROM t),
forms AS (SELECT DISTINCT token AS form, token[1:-2] AS lemma FROM e WHERE length(token) > 4 AND token LIKE '%s' AND token NOT LIKE '%ss')
SELECT doc_id, position::INT AS position, coalesce(lemma, token) AS token FROM e LEFT JOIN forms ON token = form""")
def content_tokens(spark, sf_dir):
    docs = documents(spark, sf_dir)
    seen = docs.select(F.explode(terms.tokens("text", STOP_WORDS)).alias("form")).distinct()
    plural = (F.length("form") > 4) & F.col("form").endswith("s") & ~F.col("form").endswith("ss")
    lemmas = seen.filter(plural).withColumn("lemma", F.expr("substring(form, 1, length(form) - 1)"))
    return terms.content_tokens(docs, "doc_id", "text", STOP_WORDS, lemmas)


_TOKENS_SQL = rf"""
tok AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '{terms.TOKEN}'), lambda w: w NOT IN {_STOP_SQL}) AS ts FROM documents)"""
_GRAMS_SQL = f"""{_TOKENS_SQL},
grams AS (
  SELECT doc_id, unnest(ts) AS term FROM tok
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(ts)), lambda i: ts[i] || ' ' || ts[i + 1])) FROM tok
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(ts) - 1), lambda i: ts[i] || ' ' || ts[i + 1] || ' ' || ts[i + 2])) FROM tok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY 1, 2),
n AS (SELECT count(*) AS n FROM documents),
vocab AS (SELECT term, count(*) AS df, sum(tf) AS total, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM tf, n
  GROUP BY 1 HAVING count(*) >= 2 AND count(*) <= 0.95 * any_value(n) ORDER BY total DESC, term LIMIT 5000)"""


@query("tfidf_weights", "TXT-06", f"""WITH {_GRAMS_SQL}
SELECT doc_id, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS weight
FROM tf JOIN vocab USING (term)""")
def tfidf_weights(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return _round(terms.tfidf(docs, "doc_id", "text", stop_words=STOP_WORDS), 6)


@query("top_terms_per_class", "TXT-11 SRT-03", rf"""
WITH d AS (SELECT doc_id, toxic, list_filter(regexp_extract_all(lower(text), '{terms.TOKEN}'), lambda w: w NOT IN {_STOP_SQL}) AS ts
  FROM documents JOIN labels USING (doc_id)),
tf AS (SELECT doc_id, toxic, term, count(*) AS tf FROM (SELECT doc_id, toxic, unnest(ts) AS term FROM d) GROUP BY ALL),
n AS (SELECT toxic, count(*) AS n FROM d GROUP BY 1),
v AS (SELECT toxic, term, sum(tf) AS total, ln((1 + any_value(n)) / (1 + count(*))) + 1 AS idf FROM tf JOIN n USING (toxic) GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY toxic ORDER BY sum(tf) DESC, term) <= 15),
w AS (SELECT doc_id, toxic, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id, toxic)) AS weight FROM tf JOIN v USING (toxic, term)),
s AS (SELECT toxic, term, sum(weight) AS score FROM w GROUP BY 1, 2)
SELECT toxic, term, round(score, 6) AS score, row_number() OVER (PARTITION BY toxic ORDER BY round(score, 9) DESC, term)::INT AS rank FROM s""")
def top_terms_per_class(spark, sf_dir):
    docs = _labelled(spark, sf_dir)
    weights = terms.tfidf(docs, "doc_id", "text", (1, 1), 15, 1, 1.0, STOP_WORDS, ["toxic"])
    return _round(terms.top_terms(weights, 15, ["toxic"]), 6)


@query("binary_counts", "TXT-05", f"""WITH {_TOKENS_SQL},
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM tok) GROUP BY 1, 2),
v AS (SELECT term FROM tf GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 3000)
SELECT doc_id, term, 1 AS present FROM tf JOIN v USING (term)""")
def binary_counts(spark, sf_dir):
    return terms.binary_counts(table(spark, sf_dir, "documents"), "doc_id", "text", 3000, STOP_WORDS)


@query("word_frequency", "TXT-12 SRT-03", f"""
SELECT word, count(*) AS n FROM (SELECT unnest(list_filter(string_split({_clean_sql("text")}, ' '), lambda w: w <> '')) AS word FROM documents)
GROUP BY 1 ORDER BY n DESC, word LIMIT 100""")
def word_frequency(spark, sf_dir):
    return terms.word_frequency(documents(spark, sf_dir), tx.clean_text("text"))


@query("length_by_class", "TXT-12 AGG-09", r"""
SELECT toxic, count(*) AS n, round(avg(length(text)), 4) AS mean_length, round(stddev(length(text)), 4) AS std_length,
  max(length(text)) AS max_length, round(avg(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))), 4) AS mean_words
FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def length_by_class(spark, sf_dir):
    docs = _labelled(spark, sf_dir).select(
        "toxic", F.length("text").cast("long").alias("length"), F.size(tx.words("text")).alias("n_words")
    )
    out = agg.aggregate(docs, "toxic", {
        "length": {"n": "count", "mean_length": "mean", "std_length": "std", "max_length": "max"},
        "n_words": {"mean_words": "mean"},
    })
    return _round(out)
