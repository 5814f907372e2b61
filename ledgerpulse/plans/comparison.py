"""Comparison of five unsupervised models on labelled deliveries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.functions.expressions import ground_truth, to_number
from ledgerpulse.operators import evaluation
from ledgerpulse.operators.iforest import IsolationForest
from ledgerpulse.operators.joins import transactions_with_logs
from ledgerpulse.operators.outliers import (
    Scaler, fit_elliptic_envelope, fit_linear_autoencoder, fit_local_outlier_factor, fit_one_class_svm,
)
from ledgerpulse.schemas import COMPARISON_FEATURES
from ledgerpulse.session import cut_lineage

MODEL_NAMES = ("IsolationForest", "OneClassSVM", "LocalOutlierFactor", "EllipticEnvelope", "AutoEncoder")


def labelled_features(transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Transaction with its log as model features plus the 0/1 ground truth."""
    return transactions_with_logs(transactions, logs).select(
        "transaction_id", *[to_number(c).alias(c) for c in COMPARISON_FEATURES], ground_truth().alias("y_true"))


def standardised(labelled: DataFrame) -> DataFrame:
    """Features scaled on all rows, normal and anomalous."""
    return Scaler.fit(labelled, COMPARISON_FEATURES).transform(labelled)


def predictions(scaled: DataFrame, contamination: float = 0.2, seed: int = 42) -> DataFrame:
    """Every model fitted on the normal rows and applied to all: model, y_true, y_pred, copies.

    Equal rows get equal predictions, so they are one row with their number.
    """
    points = cut_lineage(scaled.groupBy(*COMPARISON_FEATURES, "y_true").agg(F.count("*").alias("copies")))
    normal = scaled.filter(F.col("y_true") == 0)
    features = list(COMPARISON_FEATURES)
    models = {
        "IsolationForest": IsolationForest(COMPARISON_FEATURES, n_trees=50, contamination=contamination,
                                           seed=seed, key=("transaction_id",)).fit(normal),
        "OneClassSVM": fit_one_class_svm(normal, features, nu=contamination),
        "LocalOutlierFactor": fit_local_outlier_factor(normal, features, k=2, contamination=contamination),
        "EllipticEnvelope": fit_elliptic_envelope(normal, features, contamination),
        "AutoEncoder": fit_linear_autoencoder(normal, features, contamination),
    }
    return reduce(DataFrame.unionAll, [
        model.transform(points).select(F.lit(name).alias("model"), "y_true", F.col("prediction").alias("y_pred"), "copies")
        for name, model in models.items()])


def comparison(transactions: DataFrame, logs: DataFrame, contamination: float = 0.2) -> DataFrame:
    """Confusion counts, precision, recall and F1 per model."""
    scaled = cut_lineage(standardised(cut_lineage(labelled_features(transactions, logs))))
    counts = evaluation.confusion_counts(predictions(scaled, contamination), "model", copies="copies")
    return evaluation.precision_recall_f1(counts)
