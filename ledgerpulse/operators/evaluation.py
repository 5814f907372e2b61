"""Scores of predictions against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import safe_divide

METRICS = {"Precision": "precision", "Recall": "recall", "F1-Score": "f1"}


def confusion_counts(df: DataFrame, *by: str, actual: str = "y_true", predicted: str = "y_pred", copies: str | None = None) -> DataFrame:
    """Rows by actual and predicted value; `copies` names a column with the number of equal rows that a row stands for."""
    y, p = F.col(actual), F.col(predicted)

    def number(condition: Column) -> Column:
        return F.count_if(condition) if copies is None else F.coalesce(F.sum(F.when(condition, F.col(copies))), F.lit(0))
    return df.groupBy(*by).agg(
        number((p == 1) & (y == 1)).alias("tp"), number((p == 1) & (y == 0)).alias("fp"),
        number((p == 0) & (y == 1)).alias("fn"), number((p == 0) & (y == 0)).alias("tn"))


def confusion_matrix(counts: DataFrame, *by: str) -> DataFrame:
    """`[[TN, FP], [FN, TP]]` as an array column."""
    return counts.select(*by, F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("matrix"))


def precision_recall_f1(counts: DataFrame) -> DataFrame:
    """Adds precision, recall and F1; an empty denominator gives 0."""
    return (counts
            .withColumn("precision", safe_divide("tp", F.col("tp") + F.col("fp")))
            .withColumn("recall", safe_divide("tp", F.col("tp") + F.col("fn")))
            .withColumn("f1", safe_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))))


def metrics_long(scores: DataFrame, model: str = "model") -> DataFrame:
    renamed = scores.select(F.col(model).alias("model"), *[F.col(c).alias(m) for m, c in METRICS.items()])
    return renamed.unpivot("model", list(METRICS), "metric", "score")


def metrics_pivot(long: DataFrame) -> DataFrame:
    return long.groupBy("model").pivot("metric", list(METRICS)).agg(F.first("score"))


def best_model(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.desc("f1"), "model").limit(1)
