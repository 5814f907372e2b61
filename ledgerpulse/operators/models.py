"""Merchant-health monitor and fraud detector."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.operators.alerts import window_alerts
from ledgerpulse.operators.iforest import IsolationForest, IsolationForestModel
from ledgerpulse.operators.quantiles import weighted_order_statistics
from ledgerpulse.schemas import LIVE_FEATURES, REDUCED_FEATURES, WINDOW_FEATURES, numeric_columns, require_columns
from ledgerpulse.session import cut_lineage

#: Bins of a feature that boosted trees tell apart, besides one for missing values.
MOST_BINS = 32


class MerchantHealthMonitor:
    """Flags unusual (merchant, window) rows without labels."""

    def __init__(self, contamination: float = 0.05, random_state: int = 42) -> None:
        self.contamination, self.random_state = contamination, random_state
        self.model: IsolationForestModel | None = None

    @property
    def is_trained(self) -> bool:
        return self.model is not None

    def train_and_predict(self, features: DataFrame) -> DataFrame:
        """Feature rows with anomaly_score, decision, prediction (1/0) and label (-1/1).

        The features are stored once: fitting reads them several times, and
        each reading would otherwise aggregate the raw transactions again.
        """
        require_columns(features, WINDOW_FEATURES, "features_df")
        features = cut_lineage(features)
        key = tuple(c for c in ("merchant_id", "timestamp") if c in features.columns)
        forest = IsolationForest(WINDOW_FEATURES, contamination=self.contamination, seed=self.random_state,
                                 key=key if len(key) == 2 else ())
        self.model, labelled = forest.fit_predict(features)
        return labelled

    def generate_alerts(self, labelled: DataFrame) -> DataFrame:
        require_columns(labelled, ("prediction",), "labelled features")
        return window_alerts(labelled)


def detect_anomalies(features: DataFrame, contamination: float = 0.1, random_state: int = 42,
                     key: tuple[str, ...] = ()) -> DataFrame:
    """Features of the reduced variant with `prediction` 1 for anomalies."""
    require_columns(features, REDUCED_FEATURES, "features_df")
    forest = IsolationForest(REDUCED_FEATURES, contamination=contamination, seed=random_state, key=key)
    return forest.fit_predict(cut_lineage(features))[1].drop("label")


def train_live_model(live_features: DataFrame, contamination: float = 0.05, random_state: int = 42,
                     n_trees: int = 200, key: tuple[str, ...] = ()) -> IsolationForestModel:
    """The model of the event scorer: six features, 200 trees."""
    return _live_forest(contamination, random_state, n_trees, key).fit(live_features)


def label_live_events(live_features: DataFrame, contamination: float = 0.05, random_state: int = 42, n_trees: int = 200,
                      key: tuple[str, ...] = ()) -> tuple[IsolationForestModel, DataFrame]:
    """The same model and the training rows with its labels; every row is scored once."""
    return _live_forest(contamination, random_state, n_trees, key).fit_predict(live_features)


def _live_forest(contamination: float, seed: int, n_trees: int, key: tuple[str, ...]) -> IsolationForest:
    return IsolationForest(LIVE_FEATURES, n_trees=n_trees, contamination=contamination, seed=seed, key=key)


def bin_splits(rows: DataFrame, column: str) -> list[float]:
    """Bounds of at most `MOST_BINS` bins: between all values if they are few, else at shares of the rows.

    The values of all rows count, not those of a sample.
    """
    values = rows.filter(~F.isnan(column)).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n")).persist()
    few = sorted(r["v"] for r in values.limit(MOST_BINS + 1).collect())
    if len(few) <= MOST_BINS:
        cuts = [low / 2 + high / 2 for low, high in zip(few, few[1:])]
    else:
        total = values.agg(F.sum("n")).first()[0]
        # a bin begins behind such a value
        found = weighted_order_statistics(values, "v", "n", [total * i // MOST_BINS for i in range(1, MOST_BINS)])
        cuts = [math.nextafter(v, math.inf) for v in found]
    values.unpersist()
    inner = sorted({c for c in cuts if math.isfinite(c)}) or [0.0]  # a bucketizer wants a cut
    return [-math.inf, *inner, math.inf]


class FraudDetector:
    """`anomaly`: isolation forest, -1/1. `supervised`: boosted trees, 0/1."""

    MODES = ("anomaly", "supervised")

    def __init__(self, mode: str = "anomaly") -> None:
        if mode not in self.MODES:
            raise ValueError(f"Unknown mode '{mode}'. Choose 'anomaly' or 'supervised'.")
        self.mode = mode
        self.features: list[str] = []
        self.model: IsolationForestModel | PipelineModel | None = None

    @property
    def is_trained(self) -> bool:
        return self.model is not None

    def train(self, rows: DataFrame, label: str | None = None, max_iter: int = 100, key: tuple[str, ...] = ()) -> "FraudDetector":
        """Fit on the numeric columns other than label and key; the rows are stored once, as fitting reads them several times."""
        self.features = [c for c in numeric_columns(rows) if c != label and c not in key]
        if self.mode == "anomaly":
            stored = cut_lineage(rows.select(*key, *self.features))
            self.model = IsolationForest(tuple(self.features), contamination=0.05, seed=42, key=key).fit(stored)
            return self
        if label is None:
            raise ValueError("Labels are required for supervised mode.")
        trees = GBTClassifier(featuresCol="_features", labelCol="_label", predictionCol="_prediction", weightCol="_weight",
                              maxIter=max_iter, maxDepth=4, stepSize=0.1, maxBins=MOST_BINS + 1, seed=42)
        trees = trees.setProbabilityCol("_probability").setRawPredictionCol("_raw")
        bins = [f"_bin_{c}" for c in self.features]
        assembler = VectorAssembler(inputCols=bins, outputCol="_features")
        stored = cut_lineage(self._inputs(rows).select(F.col(label).cast("double").alias("_label"), *[f"_in_{c}" for c in self.features]))
        binner = Bucketizer(splitsArray=[bin_splits(stored, f"_in_{c}") for c in self.features],
                            inputCols=[f"_in_{c}" for c in self.features], outputCols=bins, handleInvalid="keep")
        # trees see a feature by its bin only, so rows with equal bins and label are one row with a weight
        ordered = [F.col(b).alias(b, metadata={}) for b in bins]  # numbers, not the categories the bucketizer calls them
        training = binner.transform(stored).select("_label", *ordered).groupBy("_label", *bins).agg(F.count("*").cast("double").alias("_weight"))
        fitted = Pipeline(stages=[assembler, trees]).fit(cut_lineage(training.sortWithinPartitions("_label", *bins)))
        self.model = PipelineModel(stages=[binner, *fitted.stages])
        return self

    def _inputs(self, rows: DataFrame) -> DataFrame:
        """The features as doubles in columns of their own; null counts as NaN, which has a bin of its own."""
        return rows.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.features})

    def predict(self, rows: DataFrame) -> DataFrame:
        """Rows with an integer `fraud_prediction` column."""
        if not self.is_trained:
            raise RuntimeError("Model must be trained before calling predict().")
        if self.mode == "anomaly":
            return (self.model.transform(rows).withColumnRenamed("label", "fraud_prediction")
                    .drop("prediction"))
        own = [f"{kind}_{c}" for kind in ("_in", "_bin") for c in self.features]
        return (self.model.transform(self._inputs(rows)).withColumn("fraud_prediction", F.col("_prediction").cast("int"))
                .drop("_features", "_raw", "_prediction", "_probability", *own))
