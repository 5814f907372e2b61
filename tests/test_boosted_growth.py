"""Boosted trees are grown on bins of all rows, equal ones merged; a comparison judges equal rows once."""

from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from ledgerpulse.operators import evaluation
from ledgerpulse.operators.models import MOST_BINS, FraudDetector, bin_splits


def test_trees_grow_on_merged_bins_and_miss_no_rare_value(spark, monkeypatch):
    rows = spark.range(100_000).select(
        (F.col("id") % 997 + 0.25).alias("amount"), F.when(F.col("id") == 77_777, 401.0).when(F.col("id") % 3 == 0, 200.0).otherwise(500.0).alias("status"),
        (F.col("id") == 77_777).cast("int").alias("bad"))
    seen = []
    real = GBTClassifier._fit
    monkeypatch.setattr(GBTClassifier, "_fit", lambda self, df: (seen.append(df.count()), real(self, df))[1])
    out = FraudDetector("supervised").train(rows, "bad", max_iter=2).predict(rows)
    assert out.filter("fraud_prediction <> bad").isEmpty() and out.columns == ["amount", "status", "bad", "fraud_prediction"]
    assert seen[0] <= 2 * MOST_BINS * 3


def test_missing_and_infinite_features(spark):
    odd = [None, float("nan"), float("inf"), float("-inf"), 1.0]
    rows = spark.createDataFrame([(odd[i % 5], float(i), int(i % 5 < 2)) for i in range(100)], "a double, b double, bad int")
    out = FraudDetector("supervised").train(rows, "bad", max_iter=2).predict(rows)
    assert out.filter("fraud_prediction <> bad").isEmpty()


def test_few_values_are_all_told_apart(spark):
    rows = spark.range(1000).select((F.col("id") % 4 * 1.0).alias("a"), (F.col("id") * 1.0).alias("b"), F.lit(7.0).alias("c"))
    assert bin_splits(rows, "a")[1:-1] == [0.5, 1.5, 2.5]
    cuts = bin_splits(rows, "b")[1:-1]
    assert len(cuts) == MOST_BINS - 1
    sizes = [rows.filter((F.col("b") >= low) & (F.col("b") < high)).count() for low, high in zip(cuts, cuts[1:])]
    assert min(sizes) >= 31 and max(sizes) <= 32
    assert len(bin_splits(rows, "c")) == 3


def test_counts_of_merged_rows(spark):
    rows = spark.createDataFrame([("a", 1, 1)] * 3 + [("a", 0, 1)] * 2 + [("a", 0, 0)] * 4 + [("b", 1, 0)], "model string, y_true int, y_pred int")
    plain = evaluation.confusion_counts(rows, "model")
    merged = evaluation.confusion_counts(rows.groupBy("model", "y_true", "y_pred").agg(F.count("*").alias("n")), "model", copies="n")
    assert sorted(plain.collect()) == sorted(merged.collect()) and plain.schema.names == merged.schema.names
