"""Text features and splits against plain counting, and how their rows are spread."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import features as ft
from millrace.operators import learn
from tests.test_grams import _stats, _texts


def test_text_features_hold_the_most_frequent_terms(spark):
    texts = _texts(200)
    df = spark.createDataFrame([(i, t, float(len(t))) for i, t in enumerate(texts)], "id int, text string, size double").repartition(3)
    model = learn.fit_text_features(df, max_features=40, max_df=0.5, dense=["size"])
    total, docs = _stats({i: [t] for i, t in enumerate(texts)}, 1, 3)
    fit = {g: n for g, n in total.items() if 2 <= docs[g] <= 100}
    names = sorted(fit, key=lambda g: (-fit[g], g))[:40]
    assert model.stages[-5].vocabulary == names
    for r in model.transform(df).collect():
        words = r.text.split()
        tf = Counter(" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))
        raw = [tf[g] * (math.log(201 / (1 + docs[g])) + 1) for g in names]
        norm = math.sqrt(sum(x * x for x in raw)) or 1.0
        assert r.features.toArray().tolist() == pytest.approx([*(x / norm for x in raw), r["size"]])


def test_rows_of_a_class_stay_in_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(4000).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"))
        for out in (ft.class_weights(rows, "label"), ft.stratified_split(rows, "label", "id", {"a": 0.8, "b": 0.2})):
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_elimination_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return float(x)

    rows = spark.range(60).select((F.col("id") % 2).cast("int").alias("y"), *[counted(F.col("id") * k % 7 + F.col("id") % 2 * k).alias(f"f{k}") for k in (1, 2, 3)])
    assert "f3" in learn.recursive_elimination(rows, ["f1", "f2", "f3"], "y", 2, trees=5)
    assert seen.value == 180


def test_candidates_of_a_rung_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    from pyspark.ml.linalg import Vectors

    meet, fitted = threading.Barrier(2, timeout=60), learn.classifier

    def waits(*args, **params):
        if threading.current_thread() is not threading.main_thread():
            meet.wait()
        return fitted(*args, **params)

    monkeypatch.setattr(learn, "classifier", waits)
    train = spark.createDataFrame([(i, float(i % 2), Vectors.dense([i % 2 + 1.0, i % 3])) for i in range(60)], ["id", "label", "features"])
    _, rows = learn.successive_halving(train, [("nb", {}), ("nb", {"smoothing": 2.0})], "id", shares=(1.0,), parallelism=2)
    assert not meet.broken and len(rows) == 2


def test_wide_columns_of_a_split_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def made(x):
        seen.add(1)
        return f"text {x}"

    rows = spark.range(400).select("id", (F.col("id") % 10 == 0).cast("int").alias("label"), made("id").alias("text"))
    out = ft.stratified_split(rows, "label", "id", {"a": 0.5, "b": 0.25, "c": 0.25}).collect()
    assert seen.value == 400
    assert Counter((r.label, r.split) for r in out) == {(0, "a"): 180, (0, "b"): 90, (0, "c"): 90, (1, "a"): 20, (1, "b"): 10, (1, "c"): 10}


def test_split_of_repeated_and_null_keys(spark):
    rows = spark.createDataFrame([(None if i < 30 else i // 20, None if i % 3 else 1) for i in range(120)], "id int, label int").repartition(4)
    out = ft.stratified_split(rows, "label", "id", {"a": 0.4, "none": 0.0, "b": 0.6}).collect()
    assert Counter((r.label, r.split) for r in out) == {(None, "a"): 32, (None, "b"): 48, (1, "a"): 16, (1, "b"): 24}


def test_term_counts_are_those_of_a_count_vectorizer(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel

    from millrace.operators import grams
    from millrace.operators.terms import ngrams

    lists = [t.split() for t in _texts(60)] + [[], ["a"], ["", "é"]] * 2
    df = spark.createDataFrame(list(enumerate(lists)), "id int, _t array<string>").repartition(3)
    every = sorted({g for words in lists for n in (1, 2, 3) for g in (" ".join(words[i : i + n]) for i in range(len(words) - n + 1))})
    terms = [g for g in every if g.strip()][::5]
    path = str(tmp_path / "model")
    PipelineModel(stages=[grams.TermCounts(vocabulary=terms, inputCol="_t", outputCol="v")]).write().save(path)
    plain = CountVectorizerModel.from_vocabulary(terms, "_g", "v").transform(df.withColumn("_g", ngrams(F.col("_t"), 1, 3)))
    wanted = {r.id: r.v for r in plain.collect()}
    assert {r.id: r.v for r in PipelineModel.load(path).transform(df).collect()} == wanted
    small = df.coalesce(1).select("id", grams._count_vectors(terms, block=7)("_t").alias("v"))
    assert {r.id: r.v for r in small.collect()} == wanted


def test_text_features_spell_no_list_of_all_ngrams(spark):
    df = spark.createDataFrame([(t,) for t in _texts(50)], "text string")
    model = learn.fit_text_features(df, max_features=20)
    assert "NGram" not in {type(s).__name__ for s in model.stages}
    assert model.transform(df).columns == ["text", "features"]


@pytest.mark.parametrize("name", ["saved_model_scores", "classify_rbf"])
def test_models_are_fitted_on_features_made_once(spark, tmp_path, monkeypatch, name):
    from millrace.plans import load_all

    texts = [f"{t} end {'offer now' if i % 3 == 0 else 'see you'}" for i, t in enumerate(_texts(60))]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 3 == 0), i % 2) for i in range(60)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    columns, made = [], learn.classifier

    class Fitted:
        def __init__(self, estimator):
            self.estimator = estimator

        def fit(self, df):
            columns.extend(df.columns)
            return self.estimator.fit(df)

    monkeypatch.setattr(learn, "classifier", lambda *a, **k: Fitted(made(*a, **k)))
    out = load_all()[name].run(spark, str(tmp_path)).collect()
    assert len(out) == 12 and set(columns) <= {"label", "weight", "features" if name == "saved_model_scores" else "rbf"}
