"""Training and scoring with MLlib, on features that are fitted on the training rows."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml import classification as mc
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover,
    VectorAssembler, Word2Vec,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import stable_bucket
from millrace.operators import grams
from millrace.operators.decompose import project, singular_directions
from millrace.operators.features import folds
from millrace.operators.perceptron import Perceptron
from millrace.operators.terms import TOKEN, ngrams
from millrace.session import pin, unpin


# --- text features ------------------------------------------------------------


def fit_text_features(
    train: DataFrame, text: str = "text", output: str = "features", ngram_range: tuple[int, int] = (1, 3),
    max_features: int = 5000, min_df: float = 2, max_df: float = 0.95, stop_words: Sequence[str] = (),
    dense: Sequence[str] = (),
) -> PipelineModel:
    """Fitted transformer from text (and dense columns) to one feature vector.

    Weights are (1 + ln((1+n)/(1+df))) per term with unit-length rows. Terms go by total, ties by term.
    """
    low, high = ngram_range
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=TOKEN, gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tokens", outputCol="_kept", stopWords=list(stop_words)),
    ]
    fitted = PipelineModel(stages=stages).transform(train).select(F.col("_kept").alias("_tokens"))
    terms, weights = _vocabulary(fitted, ngram_range, max_features, min_df, max_df)
    made = ["_tokens", "_kept", "_counts", "_weights", "_unit"]
    if grams.held(terms):
        stages.append(grams.TermCounts(vocabulary=terms, inputCol="_kept", outputCol="_counts"))
    else:
        sizes = [f"_g{n}" for n in range(low, high + 1)]
        stages += [NGram(n=n, inputCol="_kept", outputCol=f"_g{n}") for n in range(low, high + 1)]
        stages.append(SQLTransformer(statement=f"SELECT *, concat({', '.join(sizes)}) AS _grams FROM __THIS__"))
        stages.append(CountVectorizerModel.from_vocabulary(terms, "_grams", "_counts"))
        made += [*sizes, "_grams"]
    scaled = ElementwiseProduct(inputCol="_counts", outputCol="_weights", scalingVec=Vectors.dense(weights))
    unit = Normalizer(inputCol="_weights", outputCol="_unit", p=2.0)
    joined = VectorAssembler(inputCols=["_unit", *dense], outputCol=output)
    tidy = SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(made)}) FROM __THIS__")
    return PipelineModel(stages=[*stages, scaled, unit, joined, tidy])


def _vocabulary(
    listed: DataFrame, ngram_range: tuple[int, int], max_features: int, min_df: float, max_df: float
) -> tuple[list[str], list[float]]:
    """The most frequent terms in enough and not too many rows of ``_tokens``, and their weights."""
    listed = pin(listed)
    n = listed.count()
    fewest, most = (v if v >= 1 else v * n for v in (min_df, max_df))
    found = grams.candidates(listed, ngram_range, max_features, fewest, most)
    if found is None:  # too many for a task to hold
        each = listed.select(ngrams(F.col("_tokens"), *ngram_range).alias("_g"))
        totals = each.select(F.explode("_g").alias("term")).groupBy("term").agg(F.count("*").alias("total"))
        rows = each.select(F.explode(F.array_distinct("_g")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        stats = totals.join(rows, "term")
    else:
        stats = grams.known_totals(listed, found).groupBy("term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))
    fit = stats.where((F.col("df") >= fewest) & (F.col("df") <= most))
    best = fit.orderBy(F.desc("total"), "term").limit(max_features).collect()
    unpin(listed)
    if not best:
        raise ValueError("no term is in enough and not too many rows")
    return [r.term for r in best], [math.log((n + 1.0) / (r.df + 1.0)) + 1.0 for r in best]


def fit_word2vec(
    train: DataFrame, tokens: str, output: str = "features", size: int = 100, window: int = 5, min_count: int = 2,
    iterations: int = 10, seed: int = 42, rows_per_task: int = 10_000,
):
    """Word vectors; a document is the mean of its words' vectors, zeros for none.

    Every task trains on its own share of the documents, ``rows_per_task`` of them, and the
    vectors are averaged after each iteration.
    """
    tasks = max(1, math.ceil(train.count() / rows_per_task))
    return Word2Vec(
        inputCol=tokens, outputCol=output, vectorSize=size, windowSize=window, minCount=min_count,
        maxIter=iterations, seed=seed, numPartitions=tasks,
    ).fit(train)


def truncated_svd(df: DataFrame, features: str, key: str, dimensions: int = 100) -> DataFrame:
    """Rows projected on the leading singular directions (no centring); NULL for a NULL vector."""
    basis, values = singular_directions(df, features, dimensions)
    reduced = project(df, features, basis, len(values), key)
    return reduced.withColumn("reduced", F.when(F.col("reduced").isNotNull(), array_to_vector("reduced")))


# --- models ----------------------------------------------------------------------


def classifier(name: str, features: str = "features", label: str = "label", weight: str | None = None, width: int | None = None, **params):
    """A named estimator. Boosted trees stand for all boosting variants and the
    linear machine for the kernel one."""
    common = {"featuresCol": features, "labelCol": label, **params}
    if weight and name not in ("mlp",):
        common["weightCol"] = weight
    if name == "nb":
        return mc.NaiveBayes(**common)
    if name == "lr":
        return mc.LogisticRegression(**{"maxIter": 100, **common})
    if name == "svc":
        return mc.LinearSVC(**{"maxIter": 50, **common})
    if name == "rf":
        return mc.RandomForestClassifier(**{"numTrees": 100, "seed": 42, **common})
    if name == "gbt":
        return mc.GBTClassifier(**{"maxIter": 20, "seed": 42, **common})
    if name == "mlp":
        if width is None:
            raise ValueError("mlp needs the number of features (width)")
        return Perceptron(**{"layers": [width, 16, 2], "maxIter": 50, "seed": 42, **common})
    raise ValueError(f"no classifier is called {name}")


# Values searched per model. A strength of C is a penalty of 1 / C, and 30 is
# the deepest tree there is.
GRIDS = {
    "nb": {"smoothing": [0.1, 0.5, 1.0, 2.0]},
    "lr": {"regParam": [10.0, 1.0, 0.1]},
    "svc": {"regParam": [10.0, 1.0, 0.1]},
    "rf": {"numTrees": [50, 100, 200], "maxDepth": [10, 20, 30]},
    "gbt": {"maxIter": [50, 100], "stepSize": [0.05, 0.1, 0.2]},
}


def random_settings(grid: dict[str, Sequence], n: int, seed: int = 42) -> list[dict]:
    """``n`` different settings drawn from a grid, the same ones for a seed."""
    names = sorted(grid)
    every = [dict(zip(names, values)) for values in itertools.product(*(grid[name] for name in names))]
    return random.Random(seed).sample(every, min(n, len(every)))


def cross_validate(
    train: DataFrame, estimator, key: Sequence[str] | str, grid: dict[str, Sequence] | None = None, k: int = 5,
    metric: str = "accuracy", label: str = "label", parallelism: int = 2, settings: Sequence[dict] | None = None,
):
    """Fitted cross-validator over a grid, or over given ``settings``; folds follow from the key."""
    builder = ParamGridBuilder()
    for param, values in (grid or {}).items():
        builder = builder.addGrid(estimator.getParam(param), list(values))
    maps = builder.build()
    if settings is not None:
        maps = [{estimator.getParam(name): value for name, value in s.items()} for s in settings]
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, numFolds=k, foldCol="fold", parallelism=parallelism,
        evaluator=MulticlassClassificationEvaluator(labelCol=label, metricName=metric),
    )
    return cv.fit(folds(train, key, k))


def grid_settings(names: Sequence[str]) -> list[tuple[str, dict]]:
    """Every setting of every named model's grid."""
    return [
        (name, dict(zip(GRIDS[name], values))) for name in names for values in itertools.product(*GRIDS[name].values())
    ]


def successive_halving(
    train: DataFrame, candidates: Sequence[tuple[str, dict]], key: Sequence[str] | str, shares: Sequence[float] = (0.1, 0.3, 1.0),
    keep: float = 1 / 3, metric: str = "f1", label: str = "label", seed: int = 42, parallelism: int = 4, **common,
):
    """Search over models and settings with rungs of growing shares of the rows.

    A fifth of the rows, by hash of the key, is held out and scores every fit. On each rung all candidates
    left are fitted on that share of the other rows, also by hash, so that a larger share
    holds the smaller, ``parallelism`` of them at a time; the best ``keep`` of them, ties by place, go on. The last rung sees
    all of those rows, and its winner is fitted once more on every row. Returns that model, and a list of
    (rung, model, setting, rows, score, survives).
    """
    if list(shares) != sorted(shares) or shares[-1] != 1.0:
        raise ValueError("shares grow up to 1.0")
    keys = [key] if isinstance(key, str) else list(key)
    place = stable_bucket([F.lit(f"halving-{seed}"), *keys], 1_000_000)
    held = train.where(place % 5 == 0)
    rest = train.where(place % 5 != 0)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    left, rows = list(range(len(candidates))), []
    for rung, share in enumerate(shares):
        part = pin(rest.where(F.floor(place / 5) < F.lit(round(share * 200_000))))
        n = part.count()

        def scored(i: int) -> float:
            name, setting = candidates[i]
            return evaluator.evaluate(classifier(name, label=label, **common, **setting).fit(part).transform(held)) if n else 0.0

        # Fits are many short jobs: one after the other, most cores would wait.
        with ThreadPoolExecutor(parallelism) as pool:
            scores = dict(zip(left, pool.map(inheritable_thread_target(train.sparkSession)(scored), left)))
        unpin(part)
        ranked = sorted(left, key=lambda i: (-scores[i], i))
        going = ranked[:1] if rung == len(shares) - 1 else ranked[: max(1, math.ceil(len(ranked) * keep))]
        rows += [(rung, candidates[i][0], candidates[i][1], n, scores[i], i in going) for i in left]
        left = sorted(going)
    name, setting = candidates[left[0]]
    return classifier(name, label=label, **common, **setting).fit(train), rows


def cv_table(spark, fitted, name: str) -> DataFrame:
    """Mean and spread of the score per parameter setting."""
    rows = [
        (name, ", ".join(f"{p.name}={v}" for p, v in m.items()) or "default", float(avg), float(std))
        for m, avg, std in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics)
    ]
    return spark.createDataFrame(rows, "model string, parameters string, mean_score double, std_score double")


def probability(features_model, column: str = "probability") -> Column:
    return vector_to_array(column)


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Prediction and confidence (largest class probability) per row."""
    out = model.transform(df)
    if "probability" in out.columns:
        confidence = F.array_max(vector_to_array("probability"))
        positive = vector_to_array("probability")[1]
    else:  # a margin classifier: squash the margin
        margin = vector_to_array("rawPrediction")[1]
        positive = 1 / (1 + F.exp(-margin))
        confidence = F.greatest(positive, 1 - positive)
    return out.select(*keep, "prediction", positive.alias("score"), confidence.alias("confidence"))


def score_with_errors(features: PipelineModel, model, df: DataFrame, text: str, valid: Column, keep: Sequence[str]) -> DataFrame:
    """Score the valid rows; the others get an error text instead of a failure."""
    good = score(model, features.transform(df.filter(valid)), keep).withColumn("error", F.lit(None).cast("string"))
    bad = df.filter(~valid).select(
        *keep, *[F.lit(None).cast("double").alias(c) for c in ("prediction", "score", "confidence")],
        F.lit("invalid input").alias("error"),
    )
    return good.unionByName(bad)


def soft_vote(scored: Sequence[DataFrame], key: Sequence[str], weights: Sequence[float] | None = None) -> DataFrame:
    """Weighted mean of the models' positive scores, and the class it gives."""
    weights = list(weights or [1.0] * len(scored))
    key = list(key)
    rows = None
    for df, w in zip(scored, weights):
        part = df.select(*key, (F.col("score") * w).alias("_s"), F.lit(w).alias("_w"))
        rows = part if rows is None else rows.unionByName(part)
    out = rows.groupBy(*key).agg((F.sum("_s") / F.sum("_w")).alias("score"))
    return out.withColumn("prediction", (F.col("score") > 0.5).cast("double"))


def feature_importance(spark, model, names: Sequence[str]) -> DataFrame:
    """Importance per feature, largest first."""
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else abs(model.coefficients.toArray())
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def recursive_elimination(
    df: DataFrame, features: Sequence[str], label: str, k: int, step: int = 1, trees: int = 100
) -> list[str]:
    """Drop the ``step`` least important features and refit until ``k`` are left."""
    left = list(features)
    # Every forest reads the rows several times.
    rows = pin(df.select(label, *left))
    while len(left) > k:
        vector = VectorAssembler(inputCols=left, outputCol="features")
        fitted = classifier("rf", label=label, numTrees=trees).fit(vector.transform(rows))
        ranked = sorted(zip(fitted.featureImportances.toArray(), left), key=lambda p: (-p[0], p[1]))
        size = max(k, len(left) - step)
        keep = {n for _, n in ranked[:size]}
        left = [n for n in left if n in keep]
    unpin(rows)
    return left


def kmeans_anchors(df: DataFrame, width: str, height: str, k: int = 9, seed: int = 42) -> DataFrame:
    """Typical box sizes, narrowest first."""
    vectors = VectorAssembler(inputCols=[width, height], outputCol="features").transform(df)
    centers = KMeans(k=k, seed=seed).fit(vectors).clusterCenters()
    rows = sorted((float(c[0]), float(c[1])) for c in centers)
    return df.sparkSession.createDataFrame(rows, "width double, height double")
