"""Block-wise n-gram counts against plain counting; blocks are made small so that many of them meet."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import grams, terms


def _texts(n, seed=3):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(60)]
    # Later texts prefer other words, so blocks differ.
    return [" ".join(f"w{(w + (i // 100) * 7) % 60}" for w in rng.choices(range(60), weights, k=rng.randint(0, 40))) for i in range(n)]


def _grams(words, low, high):
    return [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def _stats(docs, low, high):
    """Total and documents of every n-gram; ``docs`` maps a document to its texts."""
    total, df = Counter(), Counter()
    for texts in docs.values():
        own = Counter(g for t in texts for g in _grams(t.split(), low, high))
        total.update(own)
        df.update(own.keys())
    return total, df


@pytest.mark.parametrize("reported", [5, 40, 100_000])
@pytest.mark.parametrize("wanted", [30, 10**6])
def test_candidates_hold_every_wanted_term(spark, reported, wanted):
    texts = _texts(400)
    df = spark.createDataFrame([(t.split(),) for t in texts], "_tokens array<string>").repartition(3)
    total, docs = _stats(dict(enumerate([t] for t in texts)), 1, 3)
    fit = {g: n for g, n in total.items() if 2 <= docs[g] <= 0.5 * 400}
    best = sorted(fit, key=lambda g: (-fit[g], g))[:wanted]
    ties = {g for g in fit if fit[g] >= fit[best[-1]]}
    found = grams.candidates(df, (1, 3), wanted, 2, 0.5 * 400, block=500, reported=reported)
    assert ties <= set(found)
    if wanted == 30:
        assert len(found) < len(total) / 10
    rows = grams.known_totals(df, found, block=500).groupBy("term").agg(F.sum("total").alias("n"), F.sum("df").alias("df")).collect()
    assert {r.term: (r.n, r.df) for r in rows} == {g: (total[g], docs[g]) for g in found if g in total}


@pytest.mark.parametrize("step", [1, 3])
def test_tfidf_with_rows_of_one_key_as_one_document(spark, monkeypatch, step):
    monkeypatch.setattr(grams.candidates, "__defaults__", (0, 300, 50))
    texts = [*_texts(300), "", None, "one"]
    rows = [(i // step if i % 50 else None if step > 1 else i, t) for i, t in enumerate(texts)]
    docs = {}
    for key, t in rows:
        docs.setdefault(key, []).append(t or "")
    total, df = _stats(docs, 1, 3)
    fit = {g: n for g, n in total.items() if 2 <= df[g] <= 0.9 * len(rows)}
    idf = {g: math.log((1 + len(rows)) / (1 + df[g])) + 1 for g in sorted(fit, key=lambda g: (-fit[g], g))[:50]}
    expected = {}
    for key, own in docs.items():
        tf = Counter(g for t in own for g in _grams(t.split(), 1, 3) if g in idf)
        norm = math.sqrt(sum((n * idf[g]) ** 2 for g, n in tf.items()))
        expected |= {(key, g): n * idf[g] / norm for g, n in tf.items()}
    out = terms.tfidf(spark.createDataFrame(rows, "id long, text string"), "id", "text", max_features=50, max_df=0.9).collect()
    assert len(out) == len(expected)
    assert {(r.id, r.term): r.weight for r in out} == pytest.approx(expected)


def test_terms_are_counted_without_a_row_per_token(spark):
    """The plan of the counts has no generator, whose rows a task would have to hold per document."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(_texts(50))], "id long, text string")
    for out in (terms.binary_counts(df, "id", "text", 20), terms.tfidf(df, "id", "text", max_features=20)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Generate" not in plan and "Window" not in plan and "Exchange" not in plan
