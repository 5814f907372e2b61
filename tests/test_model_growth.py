"""Work of the fitted models on tables with many copies of a point."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerpulse.operators import outliers, quantiles
from ledgerpulse.operators.outliers import fit_elliptic_envelope, fit_one_class_svm


@pytest.fixture(scope="module")
def copied(spark):
    """120 different points, each 1 to 30 times."""
    rng = np.random.default_rng(8)
    points = np.vstack([rng.normal(size=(110, 2)), rng.uniform(-7, 7, (10, 2))]).round(3)
    times = rng.integers(1, 31, 120)
    rows = np.repeat(points, times, axis=0)
    return rows, spark.createDataFrame(pd.DataFrame(rows, columns=["a", "b"])).cache()


@pytest.mark.parametrize("values", [[1.0], [2.0, 2.0, 5.0], [float(i * 37 % 101) for i in range(500)], [1e300, -1e300, 0.0, 3.0], [10.0 ** k for k in range(-9, 10)]])
def test_weighted_quantiles_equal_those_of_all_copies(spark, monkeypatch, values):
    monkeypatch.setattr(quantiles, "SMALL", 3)
    weights = [1 + i % 4 for i in range(len(values))]
    df = spark.createDataFrame(list(zip(values, weights)), "x double, w long")
    every = np.repeat(values, weights)
    shares = [0.0, 0.1, 0.5, 0.8, 1.0]
    assert quantiles.weighted_quantiles(df, "x", "w", shares) == pytest.approx([float(np.quantile(every, p)) for p in shares], rel=1e-12)
    ranks = sorted({0, len(every) // 3, len(every) - 1})
    assert quantiles.weighted_order_statistics(df, "x", "w", ranks) == [float(np.sort(every)[r]) for r in ranks]


@pytest.mark.parametrize("fit", [lambda d: fit_one_class_svm(d, ["a", "b"], 0.2), lambda d: fit_elliptic_envelope(d, ["a", "b"], 0.2)])
def test_fitting_reads_different_points_once(copied, monkeypatch, fit):
    rows, frame = copied
    stored = []

    def cut(df):
        stored.append(df.count())
        return df.cache()
    monkeypatch.setattr(outliers, "cut_lineage", cut)
    model = fit(frame)
    assert stored == [120]
    found = model.transform(frame).toPandas()
    assert model.threshold == pytest.approx(float(np.quantile(found.outlier_score, 0.8)), rel=1e-9)


def test_one_class_svm_is_the_same_each_time(spark):
    rng = np.random.default_rng(3)
    rows = [(float(a), float(b)) for a, b in rng.normal(size=(400, 2))]
    weights = [fit_one_class_svm(spark.createDataFrame(rows, "a double, b double").repartition(n), ["a", "b"], 0.1).weights for n in (3, 3, 3)]
    np.testing.assert_allclose(weights[0], weights[1])
    np.testing.assert_allclose(weights[0], weights[2])


def test_gaussian_of_copies_equals_that_of_rows(copied):
    rows, frame = copied
    found = outliers.Gaussian.fit_merged(outliers.merged(frame, ["a", "b"]), ["a", "b"], [0.3, -0.2])
    assert np.allclose(found.mean, rows.mean(axis=0)) and np.allclose(found.covariance, np.cov(rows.T, bias=True))
    flat = outliers.merged(frame.withColumn("b", F.lit(0.1)), ["a", "b"])
    assert outliers.Gaussian.fit_merged(flat, ["a", "b"], [0.0, 0.0]).covariance[1].tolist() == [0.0, 0.0]
