"""Evaluation of predictions as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running


def _zero_if_none(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class (1)."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns(
        {
            "accuracy": F.try_divide(tp + F.col("tn"), F.col("n")),
            "precision": _zero_if_none(tp, tp + fp),
            "recall": _zero_if_none(tp, tp + fn),
            "f1": _zero_if_none(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class."""
    cells = confusion_matrix(df, label, prediction)
    sides = cells.select(
        F.explode(
            F.array(
                F.struct(F.col("label").cast("double").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                         F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit")),
                F.struct(F.col("prediction").cast("double").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                         F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("class").agg(F.sum("actual").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    return sums.select(
        "class",
        _zero_if_none(F.col("hit"), F.col("predicted")).alias("precision"),
        _zero_if_none(F.col("hit"), F.col("support")).alias("recall"),
        _zero_if_none(2 * F.col("hit"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def _cumulative(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives at or above every distinct score."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running(counts, [F.desc("threshold")], {"tp": ("pos", "sum"), "fp": ("neg", "sum")})


def _class_sizes(df: DataFrame, label: str) -> Column:
    return df.agg(
        F.struct(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) != 1).alias("n")).alias("s")
    ).scalar()


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """False and true positive rate at every threshold."""
    sizes = _class_sizes(df, label)
    return _cumulative(df, label, score).select(
        "threshold", F.try_divide("fp", sizes["n"]).alias("fpr"), F.try_divide("tp", sizes["p"]).alias("tpr")
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    ahead = F.col("tp") - F.col("pos") / 2
    area = F.sum(F.col("neg") * ahead)
    return _cumulative(df, label, score).agg(
        F.try_divide(area, F.sum("pos") * F.sum("neg")).alias("auc"), F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def precision_recall_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall at every threshold."""
    sizes = _class_sizes(df, label)
    return _cumulative(df, label, score).select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", sizes["p"]).alias("recall"),
    )


def compare_models(df: DataFrame, model: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Metrics per model, the most accurate first."""
    return classification_metrics(df, label, prediction, [model]).orderBy(F.desc("accuracy"), model)


def error_analysis(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts and rates of the two kinds of error."""
    m = classification_metrics(df, label, prediction)
    return m.select(
        (F.col("fp") + F.col("fn")).alias("misclassified"),
        F.try_divide(F.col("fp") + F.col("fn"), F.col("n")).alias("error_rate"),
        F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives"),
        _zero_if_none(F.col("fp"), F.col("fp") + F.col("tn")).alias("false_positive_rate"),
        _zero_if_none(F.col("fn"), F.col("fn") + F.col("tp")).alias("false_negative_rate"),
    )


def misclassified(df: DataFrame, key: str, n: int, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """First ``n`` wrong rows by key."""
    return df.filter(F.col(label) != F.col(prediction)).orderBy(key).limit(n)


def report_rows(df: DataFrame, model: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(model, metric, value) rows for a written report."""
    m = classification_metrics(df, label, prediction, [model])
    names = ["accuracy", "precision", "recall", "f1"]
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    return m.select(model, F.explode(cells).alias("c")).select(model, "c.*")
