"""Feature preparation, training and evaluation queries."""

from __future__ import annotations

import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import scalar
from millrace.functions import text as tx
from millrace.operators import evaluate as ev
from millrace.operators import features as ft
from millrace.operators import isotonic, kernel, learn
from millrace.operators import terms
from millrace.operators.neighbours import nearest_neighbours
from millrace.plans.sales import _round
from millrace.plans.text import STOP_WORDS
from millrace.registry import query
from millrace.session import pin
from millrace.tables import boxes, table

_BUCKET = "('0x' || substr(md5({}), 1, 8))::BIGINT % {}"


@query("stratified_split", "ML-01", f"""
WITH h AS (SELECT doc_id, toxic, {_BUCKET.format("'42|' || doc_id", 1 << 30)} AS h FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY toxic ORDER BY h, doc_id) AS rn, count(*) OVER (PARTITION BY toxic) AS n FROM h)
SELECT doc_id, toxic, CASE WHEN rn <= round(n * 0.7) THEN 'train' WHEN rn <= round(n * 0.9) THEN 'valid' ELSE 'test' END AS split FROM r""")
def stratified_split(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return ft.stratified_split(labels, "toxic", "doc_id", {"train": 0.7, "valid": 0.2, "test": 0.1})


@query("label_encode", "ML-02", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code, dense_rank() OVER (ORDER BY p_brand) - 1 AS p_brand_code FROM part""")
def label_encode(spark, sf_dir):
    out = ft.label_encode(table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"])
    return out.select("p_partkey", "p_type_code", "p_brand_code")


@query("one_hot", "ML-02", """
SELECT doc_id, (lang = 'de')::INT AS lang_de, (lang = 'en')::INT AS lang_en, (lang = 'es')::INT AS lang_es, (lang = 'fr')::INT AS lang_fr FROM documents""")
def one_hot(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return ft.one_hot(docs, "lang", ["de", "en", "es", "fr"]).drop("lang")


@query("one_hot_vector", "ML-02", """
SELECT p_partkey, (SELECT count(DISTINCT p_name) FROM part) AS size, dense_rank() OVER (ORDER BY p_name) - 1 AS index FROM part""")
def one_hot_vector(spark, sf_dir):
    out = ft.one_hot_vector(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name")
    return out.select("p_partkey", "one_hot.size", "one_hot.index")


@query("scale_standard", "ML-03", """
SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size,
  round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice FROM part""")
def scale_standard(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return _round(ft.zscore(part, ["p_size", "p_retailprice"]), 6)


@query("scale_minmax", "ML-03", """
SELECT p_partkey, round((p_retailprice - min(p_retailprice) OVER ()) / (max(p_retailprice) OVER () - min(p_retailprice) OVER ()), 6) AS p_retailprice FROM part""")
def scale_minmax(spark, sf_dir):
    return _round(ft.minmax(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), ["p_retailprice"]), 6)


@query("class_weights", "ML-04", """
SELECT doc_id, toxic, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY toxic)), 6)::DOUBLE AS weight FROM labels""")
def class_weights(spark, sf_dir):
    return _round(ft.class_weights(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "toxic"), 6)


@query("oversampled_counts", "ML-04", """
SELECT toxic, max(n) OVER () AS n, n AS own FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)""")
def oversampled_counts(spark, sf_dir):
    rows = _surface(spark, sf_dir).select("doc_id", "toxic", "length", "num_words", "num_dots")
    out = ft.oversample(rows, "toxic", ["length", "num_words", "num_dots"], "doc_id")
    return out.groupBy("toxic").agg(F.count("*").alias("n"), F.count_if(~F.col("synthetic")).alias("own"))


@query("oversampled_near_counts", "ML-04", """
SELECT toxic, max(n) OVER () AS n, n AS own FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY 1)""")
def oversampled_near_counts(spark, sf_dir):
    rows = _surface(spark, sf_dir).select("doc_id", "toxic", "length", "num_words", "num_dots")
    out = ft.oversample_near(rows, "toxic", ["length", "num_words", "num_dots"], "doc_id")
    return out.groupBy("toxic").agg(F.count("*").alias("n"), F.count_if(~F.col("synthetic")).alias("own"))


@query("nearest_rows", "ML-04")
def nearest_rows(spark, sf_dir):
    rows = ft.zscore(pin(_surface(spark, sf_dir)), _SURFACE, suffix="_z")
    return nearest_neighbours(rows, "doc_id", [f"{c}_z" for c in _SURFACE], 5, by=["quality"])


_SURFACE = ["length", "num_words", "num_capitals", "num_exclamation", "num_question", "num_dots", "capital_ratio", "special_char_ratio"]


def _surface(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    cols = {n: c.cast("double") for n, c in tx.surface_features("text").items()}
    return docs.select("doc_id", "toxic", "quality", *[c.alias(n) for n, c in cols.items()])


_F_SQL = """
SELECT '{c}' AS feature, round((sum(n * m * m) - sum(n) * pow(sum(n * m) / sum(n), 2)) / (count(*) - 1)
  / (sum(n * v) / (sum(n) - count(*))), 4) AS f_value
FROM (SELECT quality, count(*) AS n, avg({e}) AS m, var_pop({e}) AS v FROM documents JOIN labels USING (doc_id) GROUP BY 1)"""
_WORDS_SQL = r"len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))"
_F_EXPR = {
    "length": "length(text)", "num_words": _WORDS_SQL,
    **{n: f"len(regexp_extract_all(text, '{p}'))" for n, p in (
        ("num_capitals", r"\p{Lu}"), ("num_exclamation", "!"), ("num_question", r"\?"), ("num_dots", r"\."))},
    "capital_ratio": r"len(regexp_extract_all(text, '\p{Lu}')) / (length(text) + 1)",
    "special_char_ratio": r"len(regexp_extract_all(text, '[^a-zA-Z0-9\s]')) / (length(text) + 1)",
}
_ALL_F_SQL = "\nUNION ALL\n".join(_F_SQL.format(c=c, e=e) for c, e in _F_EXPR.items())


@query("anova_f", "ML-10", _ALL_F_SQL)
def anova_f(spark, sf_dir):
    return _round(ft.anova_f(_surface(spark, sf_dir), _SURFACE, "quality"))


@query("select_k_best", "ML-10 SRT-03", f"""SELECT * FROM ({_ALL_F_SQL}) 
ORDER BY CASE WHEN NOT isnan(f_value) THEN f_value END DESC NULLS LAST, feature LIMIT 3""")
def select_k_best(spark, sf_dir):
    return _round(ft.select_k_best(_surface(spark, sf_dir), _SURFACE, "quality", 3))


@query("recursive_elimination", "ML-10")
def recursive_elimination(spark, sf_dir):
    kept = learn.recursive_elimination(_surface(spark, sf_dir), _SURFACE, "toxic", 3)
    return spark.createDataFrame([(n,) for n in kept], "feature string")


# --- evaluation of a score that follows from the row ---------------------------------

_SCORED_SQL = f"""
scored AS (SELECT doc_id, toxic AS label, round(({_BUCKET.format("CAST(doc_id AS VARCHAR)", 100)} / 100.0 + toxic * 0.3), 2)::DOUBLE AS score FROM labels),
judged AS (SELECT *, (score > 0.6)::INT AS prediction FROM scored)"""


def _scored(spark, sf_dir):
    score = F.round(scalar.stable_bucket("doc_id", 100) / 100.0 + F.col("toxic") * 0.3, 2)
    rows = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"), score.alias("score"))
    return rows.withColumn("prediction", (F.col("score") > 0.6).cast("int"))


_COUNTS_SQL = """c AS (SELECT count(*) AS n, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
  count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM judged)"""


@query("eval_metrics", "EV-01", f"""WITH {_SCORED_SQL}, {_COUNTS_SQL}
SELECT *, round((tp + tn) / n, 6) AS accuracy, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""")
def eval_metrics(spark, sf_dir):
    return _round(ev.classification_metrics(_scored(spark, sf_dir)), 6)


@query("confusion", "EV-02", f"""WITH {_SCORED_SQL}
SELECT label, prediction, count(*) AS n FROM judged GROUP BY 1, 2""")
def confusion(spark, sf_dir):
    return ev.confusion_matrix(_scored(spark, sf_dir))


@query("class_report", "EV-02", f"""WITH {_SCORED_SQL}
SELECT c::DOUBLE AS class, round(count(*) FILTER (WHERE label = c AND prediction = c) / count(*) FILTER (WHERE prediction = c), 6) AS precision,
  round(count(*) FILTER (WHERE label = c AND prediction = c) / count(*) FILTER (WHERE label = c), 6) AS recall,
  round(2 * count(*) FILTER (WHERE label = c AND prediction = c) / (count(*) FILTER (WHERE label = c) + count(*) FILTER (WHERE prediction = c)), 6) AS f1,
  count(*) FILTER (WHERE label = c) AS support
FROM judged, (SELECT unnest([0, 1]) AS c) GROUP BY c""")
def class_report(spark, sf_dir):
    return _round(ev.class_report(_scored(spark, sf_dir)), 6)


@query("roc_auc", "EV-03", f"""WITH {_SCORED_SQL},
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM scored),
s AS (SELECT sum(rk) FILTER (WHERE label = 1) AS w, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label = 0) AS n FROM r)
SELECT round((w - p * (p + 1) / 2) / (p * n), 6) AS auc, p AS positives, n AS negatives FROM s""")
def roc_auc(spark, sf_dir):
    return _round(ev.roc_auc(_scored(spark, sf_dir)), 6)


_CUM_SQL = """d AS (SELECT score AS threshold, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1),
k AS (SELECT threshold, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM d
  WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""


@query("roc_points", "EV-03 WIN-07", f"""WITH {_SCORED_SQL}, {_CUM_SQL}
SELECT threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM k""")
def roc_points(spark, sf_dir):
    return _round(ev.roc_points(_scored(spark, sf_dir)), 6)


@query("pr_points", "EV-03 WIN-07", f"""WITH {_SCORED_SQL}, {_CUM_SQL}
SELECT threshold, round(tp / (tp + fp), 6) AS precision, round(tp / p, 6) AS recall FROM k""")
def pr_points(spark, sf_dir):
    return _round(ev.precision_recall_points(_scored(spark, sf_dir)), 6)


@query("model_ranking", "EV-04", f"""WITH {_SCORED_SQL},
m AS (SELECT 'half' AS model, label, (score > 0.5)::INT AS prediction FROM scored
  UNION ALL SELECT 'most', label, (score > 0.8)::INT FROM scored)
SELECT model, round(avg((label = prediction)::INT), 6) AS accuracy, row_number() OVER (ORDER BY avg((label = prediction)::INT) DESC, model) AS place
FROM m GROUP BY 1""")
def model_ranking(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    parts = [rows.select(F.lit(n).alias("model"), "label", (F.col("score") > t).cast("int").alias("prediction")) for n, t in (("half", 0.5), ("most", 0.8))]
    ranked = ev.compare_models(parts[0].union(parts[1]), "model").select("model", F.round("accuracy", 6).alias("accuracy")).collect()
    return spark.createDataFrame([(r.model, r.accuracy, i) for i, r in enumerate(ranked, 1)], "model string, accuracy double, place long")


@query("compare_models", "EV-06", f"""WITH {_SCORED_SQL},
m AS (SELECT 'half' AS model, label, (score > 0.5)::INT AS prediction FROM scored
  UNION ALL SELECT 'most', label, (score > 0.8)::INT FROM scored),
c AS (SELECT model, avg((label = prediction)::INT) AS accuracy,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) / count(*) FILTER (WHERE prediction = 1) AS precision,
  count(*) FILTER (WHERE label = 1 AND prediction = 1) / count(*) FILTER (WHERE label = 1) AS recall FROM m GROUP BY 1)
SELECT model, 'accuracy' AS metric, round(accuracy, 6) AS value FROM c
UNION ALL SELECT model, 'precision', round(precision, 6) FROM c UNION ALL SELECT model, 'recall', round(recall, 6) FROM c
UNION ALL SELECT model, 'f1', round(2 * precision * recall / (precision + recall), 6) FROM c""")
def compare_models(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    half = rows.select(F.lit("half").alias("model"), "label", (F.col("score") > 0.5).cast("int").alias("prediction"))
    most = rows.select(F.lit("most").alias("model"), "label", (F.col("score") > 0.8).cast("int").alias("prediction"))
    return _round(ev.report_rows(half.union(most), "model"), 6)


@query("error_analysis", "EV-05", f"""WITH {_SCORED_SQL}, {_COUNTS_SQL}
SELECT fp + fn AS misclassified, round((fp + fn) / n, 6) AS error_rate, fp AS false_positives, fn AS false_negatives,
  round(fp / (fp + tn), 6) AS false_positive_rate, round(fn / (fn + tp), 6) AS false_negative_rate FROM c""")
def error_analysis(spark, sf_dir):
    return _round(ev.error_analysis(_scored(spark, sf_dir)), 6)


@query("misclassified_sample", "EV-05 SRT-02", f"""WITH {_SCORED_SQL}
SELECT doc_id, label, prediction FROM judged WHERE label <> prediction ORDER BY doc_id LIMIT 5""")
def misclassified_sample(spark, sf_dir):
    return ev.misclassified(_scored(spark, sf_dir), "doc_id", 5).select("doc_id", "label", "prediction")


# --- training -------------------------------------------------------------------------


def _train_test(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    dense = {n: c.cast("double") for n, c in tx.surface_features("text").items()}
    rows = docs.select("doc_id", "text", F.col("toxic").cast("double").alias("label"))
    # Features are made after the split, which reads its rows more than once.
    split = ft.stratified_split(rows, "label", "doc_id", {"train": 0.8, "test": 0.2}).select(
        "doc_id", "text", "label", *[c.alias(n) for n, c in dense.items()], "split"
    )
    train = ft.class_weights(_dealt(split.filter("split = 'train'").drop("split"), "doc_id"), "label")
    # A fit may hang on the order of sums; rows of a part go by label and place in the split, however they came.
    train = train.sortWithinPartitions("label", scalar.stable_bucket([F.lit("42"), "doc_id"], 1 << 30), "doc_id")
    return pin(train), _dealt(split.filter("split = 'test'").drop("split"), "doc_id")


# Rows for a task of the training.
TASK_ROWS = 5_000


def _dealt(rows, key):
    """Rows in parts of about one size, so that every core has its share."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, math.ceil(rows.select(key).count() / TASK_ROWS)), key)


def _text_model(train):
    return learn.fit_text_features(
        train, ngram_range=(1, 3), max_features=5000, stop_words=STOP_WORDS, dense=_SURFACE
    )


def _register_classifier(name, **params):
    def run(spark, sf_dir):
        train, test = _train_test(spark, sf_dir)
        features = _text_model(train)
        ready = pin(features.transform(train).select("doc_id", "label", "weight", "features"))
        width = ready.select("features").first()[0].size if name == "mlp" else None
        model = learn.classifier(name, weight="weight", width=width, **params).fit(ready)
        return learn.score(model, features.transform(test), ["doc_id", "label"])

    run.__module__ = __name__
    query(f"classify_{name}", "ML-05 TXT-06 TXT-09")(run)


_register_classifier("nb")
_register_classifier("lr")
_register_classifier("svc")
_register_classifier("rf")
_register_classifier("gbt")
_register_classifier("mlp")


@query("classify_rbf", "ML-05 TXT-06 TXT-09")
def classify_rbf(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    features = _text_model(train)
    ready = pin(features.transform(train).select("doc_id", "label", "weight", "features"))
    gamma = kernel.scale_gamma(ready, "features")
    mapped = pin(kernel.rbf_features(ready, "features", "rbf", gamma, 512).select("label", "weight", "rbf"))
    model = learn.classifier("svc", features="rbf", weight="weight").fit(mapped)
    return learn.score(model, kernel.rbf_features(features.transform(test), "features", "rbf", gamma, 512), ["doc_id", "label"])


@query("cv_scores", "ML-06")
def cv_scores(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    ready = pin(_text_model(train).transform(train).select("doc_id", "label", "features"))
    fitted = learn.cross_validate(ready, learn.classifier("nb"), "doc_id", learn.GRIDS["nb"], k=5, metric="f1")
    return learn.cv_table(spark, fitted, "nb")


@query("random_search", "ML-06")
def random_search(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    ready = pin(_text_model(train).transform(train).select("doc_id", "label", "features"))
    settings = learn.random_settings(learn.GRIDS["lr"] | {"elasticNetParam": [0.0, 0.5]}, 3, seed=7)
    fitted = learn.cross_validate(ready, learn.classifier("lr"), "doc_id", k=5, metric="f1", settings=settings)
    return learn.cv_table(spark, fitted, "lr")


@query("halving_search", "ML-06")
def halving_search(spark, sf_dir):
    train, _ = _train_test(spark, sf_dir)
    ready = pin(_text_model(train).transform(train).select("doc_id", "label", "features"))
    _, rows = learn.successive_halving(ready, learn.grid_settings(["nb", "lr", "svc", "rf"]), "doc_id")
    named = [(rung, name, ", ".join(f"{k}={v}" for k, v in s.items()), n, score, goes) for rung, name, s, n, score, goes in rows]
    return spark.createDataFrame(named, "rung int, model string, parameters string, rows long, score double, survives boolean")


@query("ensemble_vote", "ML-07 ML-11")
def ensemble_vote(spark, sf_dir):
    train, test = _train_test(spark, sf_dir)
    features = _text_model(train)
    ready = pin(features.transform(train).select("doc_id", "label", "weight", "features"))
    tests = features.transform(test)
    scored = [
        learn.score(learn.classifier(n, weight="weight").fit(ready), tests, ["doc_id", "label"]) for n in ("nb", "lr", "rf")
    ]
    return learn.soft_vote(scored, ["doc_id", "label"], [1.0, 2.0, 1.0])


@query("saved_model_scores", "ML-08 ML-11")
def saved_model_scores(spark, sf_dir):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegressionModel

    from millrace.session import new_path

    train, test = _train_test(spark, sf_dir)
    features = _text_model(train)
    ready = pin(features.transform(train).select("label", "weight", "features"))
    model = learn.classifier("lr", weight="weight").fit(ready)
    path = new_path(spark, "model")
    features.write().overwrite().save(f"{path}/features")
    model.write().overwrite().save(f"{path}/model")
    loaded = PipelineModel.load(f"{path}/features"), LogisticRegressionModel.load(f"{path}/model")
    return learn.score_with_errors(*loaded, test, "text", tx.valid_email_text("text"), ["doc_id", "label"])


@query("feature_importance", "ML-09")
def feature_importance(spark, sf_dir):
    rows = _surface(spark, sf_dir)
    ready = VectorAssembler(inputCols=_SURFACE, outputCol="features").transform(rows)
    model = learn.classifier("rf", label="toxic").fit(ready)
    return learn.feature_importance(spark, model, _SURFACE)


@query("kmeans_anchors", "ML-12")
def kmeans_anchors(spark, sf_dir):
    rows = boxes(spark, sf_dir).select((F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"))
    return learn.kmeans_anchors(rows, "w", "h")


# On distinct scores: the largest over starts up to a score of the smallest mean of a block from there to an end beyond it.
@query("calibration", "ML-13", f"""WITH {_SCORED_SQL},
d AS (SELECT score, sum(label)::DOUBLE AS s, count(*)::DOUBLE AS n FROM scored GROUP BY 1),
k AS (SELECT score, row_number() OVER (ORDER BY score) AS i, sum(s) OVER (ORDER BY score) AS cs, sum(n) OVER (ORDER BY score) AS cn FROM d),
b AS (SELECT a.i AS i, e.i AS j, (e.cs - coalesce(p.cs, 0)) / (e.cn - coalesce(p.cn, 0)) AS m
  FROM k a JOIN k e ON e.i >= a.i LEFT JOIN k p ON p.i = a.i - 1),
lo AS (SELECT i, j, min(m) OVER (PARTITION BY i ORDER BY j DESC) AS m FROM b),
fit AS (SELECT k.score, max(lo.m) AS calibrated FROM k JOIN lo ON lo.j = k.i GROUP BY 1)
SELECT doc_id, label, score, round(calibrated, 6) AS calibrated FROM scored JOIN fit USING (score)""")
def calibration(spark, sf_dir):
    rows = _scored(spark, sf_dir)
    blocks = isotonic.fit_isotonic(rows, "score", "label")
    return _round(isotonic.calibrate(rows, blocks, "score").select("doc_id", "label", "score", "calibrated"), 6)


@query("word2vec_documents", "TXT-07")
def word2vec_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", terms.tokens("text", STOP_WORDS).alias("tokens"))
    model = learn.fit_word2vec(docs, "tokens")
    return model.transform(docs).select("doc_id", vector_to_array("features").alias("vector"))


@query("svd_reduced", "TXT-08")
def svd_reduced(spark, sf_dir):
    from pyspark.ml.functions import array_to_vector

    rows = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    out = learn.truncated_svd(rows, "features", "vec_id")
    return out.select("vec_id", vector_to_array("reduced").alias("reduced"))
