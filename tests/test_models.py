import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import make_txns
from ledgerpulse.operators import neighbours, outliers, quantiles
from ledgerpulse.operators.features import window_features
from ledgerpulse.operators.iforest import IsolationForest, IsolationForestModel, average_path, fixed_forest, grow_tree
from ledgerpulse.operators.models import FraudDetector, MerchantHealthMonitor, detect_anomalies, train_live_model
from ledgerpulse.operators.outliers import (
    Gaussian, Scaler, fit_elliptic_envelope, fit_linear_autoencoder, fit_local_outlier_factor, fit_one_class_svm,
)
from ledgerpulse.plans import comparison
from ledgerpulse.schemas import LIVE_FEATURES, WINDOW_FEATURES


@pytest.fixture(scope="module")
def feature_rows(spark):
    rng = np.random.default_rng(1)
    total = rng.integers(50, 200, 200)
    declined = rng.integers(0, 10, 200)
    return spark.createDataFrame(pd.DataFrame({
        "merchant_id": [f"m{i}" for i in range(200)], "timestamp": pd.date_range("2026-03-07", periods=200, freq="10min"),
        "total_transactions": total, "decline_count": declined, "decline_ratio": declined / total,
        "avg_amount": rng.uniform(50, 500, 200), "risk_block_count": rng.integers(0, 3, 200)}))


# ---- quantiles

@pytest.mark.parametrize("small", [10, 20_000])
@settings(max_examples=6, deadline=None)
@given(values=st.lists(st.sampled_from([0.0, 1.0, 1.0, 2.5, -7.0, 1e9]) | st.floats(-1e6, 1e6), min_size=1, max_size=120))
def test_exact_quantiles(spark, small, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    before, quantiles.SMALL = quantiles.SMALL, small
    try:
        probabilities = [0.0, 0.05, 0.5, 0.9, 1.0]
        assert quantiles.exact_quantiles(df, "x", probabilities) == pytest.approx(np.quantile(values, probabilities), rel=1e-9, abs=1e-9)
        assert quantiles.order_statistics(df, "x", [0, len(values) - 1]) == [min(values), max(values)]
    finally:
        quantiles.SMALL = before


def test_quantiles_of_a_skewed_column(spark):
    """A third of the rows share one value; more rows than are ever collected."""
    df = spark.range(90_000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 7.0).alias("x"))
    values = df.toPandas()["x"]
    probabilities = [0.001, 0.2, 1 / 3, 0.5, 0.95]
    assert quantiles.exact_quantiles(df, "x", probabilities) == pytest.approx(np.quantile(values, probabilities))
    assert quantiles.exact_quantiles(df.limit(0), "x", [0.5]) == [None]
    with pytest.raises(ValueError):
        quantiles.order_statistics(df, "x", [90_000])


# ---- isolation forest

def test_average_path_values():
    assert average_path([0, 1, 2]).tolist() == [0.0, 0.0, 1.0]
    assert average_path([256])[0] == pytest.approx(10.2448, abs=1e-3)


def test_trees_separate_the_rows():
    nodes = grow_tree(np.arange(16.0).reshape(-1, 1), 20, np.random.default_rng(0))
    assert sum(n[6] for n in nodes if n[1] < 0) == 16 and all(n[6] == 1 for n in nodes if n[1] < 0)
    assert all(r == l + 1 for _, f, _, l, r, _, _ in nodes if f >= 0)
    constant = grow_tree(np.ones((5, 2)), 8, np.random.default_rng(0))
    assert len(constant) == 1 and constant[0][6] == 5


def test_contamination_share_and_labels(feature_rows):
    monitor = MerchantHealthMonitor(contamination=0.1)
    assert not monitor.is_trained
    out = monitor.train_and_predict(feature_rows).toPandas()
    assert monitor.is_trained and len(out) == 200 and set(out.label) == {1, -1}
    assert abs((out.prediction == 1).mean() - 0.10) <= 0.02
    assert ((out.label == -1) == (out.prediction == 1)).all() and ((out.decision < 0) == (out.prediction == 1)).all()


def test_result_does_not_depend_on_partitioning(feature_rows):
    a = MerchantHealthMonitor().train_and_predict(feature_rows.repartition(1)).toPandas()
    b = MerchantHealthMonitor().train_and_predict(feature_rows.repartition(7)).toPandas()
    a, b = (x.sort_values("merchant_id")["anomaly_score"].to_numpy() for x in (a, b))
    assert np.allclose(a, b)


def test_extreme_merchant_is_flagged(spark):
    rng = np.random.default_rng(42)
    total, declined = rng.integers(50, 200, 19), rng.integers(0, 10, 19)
    rows = pd.DataFrame({"merchant_id": [f"merchant_id_{i + 10}" for i in range(19)], "total_transactions": total,
                         "decline_count": declined, "decline_ratio": rng.uniform(0, 0.1, 19), "avg_amount": rng.uniform(50, 500, 19)})
    rows.loc[19] = ["merchant_id_2", 150, 148, 148 / 150, 2.5]
    out = detect_anomalies(spark.createDataFrame(rows), 0.1, key=("merchant_id",)).toPandas()
    assert out[out.merchant_id == "merchant_id_2"].prediction.item() == 1
    assert set(out.prediction) <= {0, 1}


def test_hot_copies_do_not_break_the_fit(spark):
    """A third of the rows are one and the same."""
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 97 + 0.0).alias("a"), (F.col("id") % 11 + 0.0).alias("b"))
    model, out = IsolationForest(("a", "b"), contamination=0.05, key=("id",)).fit_predict(df)
    assert len(model.nodes) <= 100 * 511 and out.count() == 9000
    assert out.agg(F.avg("prediction")).first()[0] <= 0.06


def test_errors(feature_rows):
    with pytest.raises(ValueError, match="empty"):
        MerchantHealthMonitor().train_and_predict(feature_rows.limit(0))
    with pytest.raises(ValueError, match="risk_block_count"):
        MerchantHealthMonitor().train_and_predict(feature_rows.drop("risk_block_count"))
    with pytest.raises(ValueError):
        detect_anomalies(feature_rows.limit(0))


def test_save_and_load(spark, feature_rows, tmp_path):
    model = IsolationForest(WINDOW_FEATURES, n_trees=10, key=("merchant_id",)).fit(feature_rows)
    model.save(spark, str(tmp_path / "model"))
    again = IsolationForestModel.load(spark, str(tmp_path / "model"))
    a, b = (sorted(r.decision for r in m.transform(feature_rows).collect()) for m in (model, again))
    assert a == b
    with pytest.raises(FileNotFoundError):
        IsolationForestModel.load(spark, str(tmp_path / "none"))


def test_expression_equals_the_node_table(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame(rng.uniform(0, 24, (50, 6)) * [20, .05, .05, .05, .05, 1], columns=list(LIVE_FEATURES)))
    model = fixed_forest()
    a = [r.anomaly_score for r in model.with_score(df).collect()]
    b = [r.anomaly_score for r in model.with_expression_score(df).collect()]
    assert a == pytest.approx(b)
    assert len(set(np.round(a, 6))) > 3


def test_live_model_and_alerts(spark, txn_frame):
    df = spark.range(600).select(
        (F.col("id") % 50 + 0.0).alias("amount"), F.when(F.col("id") < 6, 1.0).otherwise(0.0).alias("is_declined"),
        F.when(F.col("id") < 6, 1.0).otherwise(0.0).alias("is_risk_block"), F.lit(0.0).alias("is_webhook_401"),
        F.lit(0.0).alias("is_webhook_error"), (F.col("id") % 24 + 0.0).alias("hour_of_day"), "id")
    model = train_live_model(df, contamination=0.02, key=("id",))
    assert model.nodes.tree.nunique() == 200
    flagged = {r.id for r in model.transform(df).filter("prediction = 1").collect()}
    assert flagged >= set(range(6))


def test_end_to_end_alerts(txn_frame):
    rows = (make_txns(200, "merchant_id_1", seconds=7200) + make_txns(50, "merchant_id_2", "DECLINED", "51_Insufficient_Funds", seconds=3600)
            + make_txns(100, "merchant_id_3", "DECLINED", "14_Invalid_Card_Number", 3.0, seconds=300))
    features = window_features(txn_frame(rows))
    monitor = MerchantHealthMonitor(contamination=0.1)
    labelled = monitor.train_and_predict(features)
    alerts = monitor.generate_alerts(labelled)
    assert alerts.count() == labelled.filter("prediction = 1").count() > 0
    assert {r.merchant_id for r in alerts.collect()} & {"merchant_id_3"}
    row = alerts.filter("merchant_id = 'merchant_id_3'").first()
    assert row.alert_type == "Elevated Decline Ratio" and row.metrics.total_transactions == 100 and row.metrics.decline_ratio == 1.0
    with pytest.raises(ValueError):
        monitor.generate_alerts(features)


# ---- fraud detector

@pytest.fixture(scope="module")
def fraud_rows(spark):
    return spark.range(60).select(
        (F.col("id") * 17 % 100 + 0.5).alias("amount"), (F.col("id") % 24).alias("hour_of_day"),
        (F.col("id") % 5).alias("tx_count_last_hour"), F.lit("x").alias("note"), (F.col("id") % 5 == 4).cast("int").alias("is_fraud"))


def test_fraud_modes(fraud_rows):
    with pytest.raises(ValueError, match="Unknown mode"):
        FraudDetector("other")
    with pytest.raises(RuntimeError):
        FraudDetector().predict(fraud_rows)
    with pytest.raises(ValueError, match="Labels"):
        FraudDetector("supervised").train(fraud_rows)
    anomaly = FraudDetector().train(fraud_rows.drop("is_fraud"))
    assert anomaly.is_trained and anomaly.features == ["amount", "hour_of_day", "tx_count_last_hour"]
    assert {r.fraud_prediction for r in anomaly.predict(fraud_rows).collect()} <= {1, -1}
    trees = FraudDetector("supervised").train(fraud_rows, "is_fraud", max_iter=5)
    out = trees.predict(fraud_rows)
    assert out.filter("fraud_prediction <> is_fraud").isEmpty() and out.columns[-1] == "fraud_prediction"


# ---- other outlier models

@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(0, 1, (400, 3)) * [1, 2, 0.5]
    points[:4] += 12
    return points, spark.createDataFrame(pd.DataFrame(points, columns=list("abc")).assign(id=range(400)))


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [tuple(r) for r in Scaler.fit(df, ["a", "b"]).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_gaussian_matches_numpy(cloud):
    points, df = cloud
    fitted = Gaussian.fit(df, list("abc"))
    assert np.allclose(fitted.covariance, np.cov(points.T, bias=True)) and np.allclose(fitted.mean, points.mean(axis=0))
    diff = points - points.mean(axis=0)
    expected = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(np.cov(points.T, bias=True)), diff)
    got = df.select("id", fitted.squared_distance().alias("d")).orderBy("id").toPandas()["d"]
    assert np.allclose(got, expected)
    axes = np.linalg.eigh(np.cov(points.T, bias=True))[1][:, -2:]
    error = ((diff - diff @ axes @ axes.T) ** 2).sum(axis=1)
    got = df.select("id", fitted.reconstruction_error(2).alias("d")).orderBy("id").toPandas()["d"]
    assert np.allclose(got, error, atol=1e-9)


@pytest.mark.parametrize("fit", [
    lambda df: fit_elliptic_envelope(df, list("abc"), 0.05), lambda df: fit_one_class_svm(df, list("abc"), 0.05),
    lambda df: fit_linear_autoencoder(df, list("abc"), 0.05, components=1)])
def test_models_flag_far_points(cloud, fit):
    _, df = cloud
    out = fit(df).transform(df).toPandas()
    assert out.prediction.mean() <= 0.07 and len(out) == 400
    assert out.loc[out.id < 4, "prediction"].sum() >= 3


def brute_neighbours(queries, reference, k):
    d2 = np.round(((queries[:, None, :] - reference[None, :, :]) ** 2).sum(axis=2), 12)
    order = [sorted(range(len(reference)), key=lambda j: (d2[i, j], tuple(reference[j])))[:k] for i in range(len(queries))]
    return [[(tuple(reference[j]), np.sqrt(d2[i, j])) for j in row] for i, row in enumerate(order)]


@pytest.mark.parametrize("cell_rows, per_task", [(2_000, 4_000), (20, 7)])
def test_nearest_equals_brute_force(spark, monkeypatch, cell_rows, per_task):
    monkeypatch.setattr(neighbours, "CELL_POINTS", cell_rows)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", per_task)
    rng = np.random.default_rng(9)
    reference = np.unique(np.round(np.column_stack([rng.exponential(5, 300), rng.integers(0, 3, 300)]), 2), axis=0)
    queries = np.unique(np.vstack([reference[:60], np.round(rng.uniform(-5, 60, (80, 2)), 1)]), axis=0)
    ref = spark.createDataFrame(pd.DataFrame(reference, columns=["a", "b"]).assign(w=1))
    ask = spark.createDataFrame(pd.DataFrame(queries, columns=["a", "b"]))
    got = {}
    for r in neighbours.nearest(ask, ref, ["a", "b"], 3).orderBy("rank").collect():
        got.setdefault((r.a, r.b), []).append(((r.n_a, r.n_b), r.dist))
    expected = {tuple(q): n for q, n in zip(queries, brute_neighbours(queries, reference, 3))}
    assert set(got) == set(expected)
    for q, found in expected.items():
        assert [p for p, _ in got[q]] == [p for p, _ in found]
        assert [d for _, d in got[q]] == pytest.approx([d for _, d in found])


def brute_lof(train, rows, k):
    """Straight from the definition, on all copies; ties by coordinates."""
    def neighbours_of(points, skip_self):
        out = []
        for i, p in enumerate(points):
            d2 = np.round(((train - p) ** 2).sum(axis=1), 12)
            order = [j for j in sorted(range(len(train)), key=lambda j: (d2[j], tuple(train[j]))) if not (skip_self and j == i)][:k]
            out.append((order, np.sqrt(d2[order])))
        return out
    own = neighbours_of(train, True)
    k_distance = np.array([d[-1] for _, d in own])
    density = lambda o, d: 1.0 / (np.maximum(k_distance[o], d).mean() + 1e-10)
    train_density = np.array([density(o, d) for o, d in own])
    return np.array([train_density[o].mean() / density(o, d) for o, d in neighbours_of(rows, False)])


@pytest.mark.parametrize("cell_rows", [2_000, 15])
def test_lof_equals_brute_force(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(neighbours, "CELL_POINTS", cell_rows)
    rng = np.random.default_rng(2)
    train = np.round(np.column_stack([rng.exponential(3, 80), rng.integers(0, 2, 80)]), 1)
    train[:25] = train[0]  # nearly a third are copies of one row
    rows = np.vstack([train, np.round(rng.uniform(0, 20, (20, 2)), 1)])
    frame = lambda a: spark.createDataFrame(pd.DataFrame(a, columns=["a", "b"]).assign(id=range(len(a))))
    model = fit_local_outlier_factor(frame(train), ["a", "b"], k=2, contamination=0.2)
    got = model.transform(frame(rows)).orderBy("id").toPandas()
    assert np.allclose(got["outlier_score"], brute_lof(train, rows, 2))
    assert set(got["prediction"]) <= {0, 1}


@pytest.mark.parametrize("p, degrees, value", [(0.5, 3, 2.365974), (0.975, 2, 7.377759), (0.975, 5, 12.832502), (0.5, 1, 0.454936)])
def test_chi2_quantile(p, degrees, value):
    assert outliers.chi2_quantile(p, degrees) == pytest.approx(value, abs=1e-5)


def test_robust_covariance_with_many_outliers(spark):
    rng = np.random.default_rng(4)
    clean = rng.normal(size=(600, 2)) @ np.array([[1.0, 0.6], [0.0, 0.8]])
    rows = np.vstack([clean, rng.normal(size=(400, 2)) * 0.3 + [9.0, -9.0]])  # 40 % are planted
    frame = spark.createDataFrame(pd.DataFrame(rows, columns=["a", "b"])).cache()
    half = outliers.minimum_covariance(frame, ["a", "b"])
    share = (1000 + 3) / 2 / 1000
    alone = outliers._concentrate(frame, Gaussian.fit(frame, ["a", "b"]), share)[1]  # as from the plain fit only
    assert outliers._volume(half) <= alone + 1e-9
    model = fit_elliptic_envelope(frame, ["a", "b"], 0.4)
    assert np.allclose(model.gaussian.mean, clean.mean(axis=0), atol=0.2)
    assert np.allclose(model.gaussian.covariance, np.cov(clean.T), atol=0.25)
    found = model.transform(frame).toPandas()
    assert set(found.index[found.prediction == 1]) == set(range(600, 1000))
    centred = rows - model.gaussian.mean
    assert np.allclose(found.outlier_score, ((centred @ np.linalg.inv(model.gaussian.covariance)) * centred).sum(axis=1))


def dense_one_class(kernel, nu, rounds=200_000):
    """The dual on the whole kernel matrix by pairwise steps: shares of at most 1 / (nu n)."""
    n = len(kernel)
    most = 1 / (nu * n)
    alpha = np.full(n, 1 / n)
    along = kernel @ alpha
    for _ in range(rounds):
        i = int(np.argmin(np.where(alpha < most - 1e-15, along, np.inf)))
        j = int(np.argmax(np.where(alpha > 1e-15, along, -np.inf)))
        if along[j] - along[i] < 1e-10:
            break
        step = min((along[j] - along[i]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12), most - alpha[i], alpha[j])
        alpha[i] += step
        alpha[j] -= step
        along += step * (kernel[i] - kernel[j])
    return along


def test_one_class_svm_equals_a_dense_solver(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(300, 2)), rng.normal(size=(180, 2)) * 0.4 + [3.0, 3.0], rng.uniform(-6, 6, (20, 2))])
    frame = spark.createDataFrame(pd.DataFrame(points, columns=["a", "b"]).assign(id=range(500))).cache()
    model = fit_one_class_svm(frame, ["a", "b"], nu=0.2, landmarks=500)
    gamma = 1 / (2 * points.var())
    kernel = np.exp(-gamma * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    dense = dense_one_class(kernel, 0.2)
    found = model.transform(frame).toPandas().sort_values("id")
    assert np.abs(-found.outlier_score.to_numpy() - dense).max() <= np.sqrt(max(model.gap, 0)) + 1e-6
    assert found.prediction.sum() == 100
    fewer = fit_one_class_svm(frame, ["a", "b"], nu=0.2, landmarks=60).transform(frame).toPandas().sort_values("id")
    apart = np.abs(fewer.outlier_score.to_numpy() - found.outlier_score.to_numpy())
    assert np.median(apart) < 0.002 and apart.max() < 0.1  # far points have no landmark beside them


def test_a_network_follows_a_curve_that_a_plane_cannot(spark):
    rng = np.random.default_rng(5)
    angle = rng.uniform(0.3, 2 * np.pi - 0.3, 600)
    arc = np.column_stack([np.cos(angle), np.sin(angle)]) + rng.normal(size=(600, 2)) * 0.02
    planted = np.column_stack([rng.uniform(-0.25, 0.25, 30), rng.uniform(-0.25, 0.25, 30)])  # inside the arc, near its mean
    frame = spark.createDataFrame(pd.DataFrame(np.vstack([arc, planted]), columns=["a", "b"]).assign(id=range(630))).cache()
    normal = frame.filter("id < 600")
    network = outliers.fit_autoencoder(normal, ["a", "b"], 0.05, width=1)
    found = network.transform(frame).toPandas()
    assert found[found.id >= 600].prediction.mean() > 0.9 and found[found.id < 600].prediction.mean() <= 0.051
    line = fit_linear_autoencoder(normal, ["a", "b"], 0.05, components=1).transform(frame).toPandas()
    assert line[line.id >= 600].prediction.mean() < 0.1
    x = rng.normal(size=(7, 2))
    _, gradient = network._network()
    loss = lambda w: float((network._network()[0](w, x)[-1] ** 2).sum())
    step = rng.normal(size=len(network.weights))
    assert (loss(network.weights + 1e-6 * step) - loss(network.weights - 1e-6 * step)) / 2e-6 == pytest.approx(gradient(network.weights, x) @ step, rel=1e-4)


def test_comparison_on_small_tables(comparison_tables):
    labelled = comparison.labelled_features(*comparison_tables)
    assert sorted(r.transaction_id for r in labelled.filter("y_true = 1").collect()) == ["TXN-004", "TXN-005"]
    report = comparison.comparison(*comparison_tables).toPandas()
    assert sorted(report.model) == sorted(comparison.MODEL_NAMES)
    assert ((report.tp + report.fp + report.fn + report.tn) == 6).all()
    assert report[["precision", "recall", "f1"]].map(lambda v: 0 <= v <= 1).all().all()


def test_missing_values_mean_the_same_in_both_forms(spark):
    model = fixed_forest()
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, 500.0]
    rows = [(i, *[odd[(i + 2 * k) % 6] if k == i % 6 or i > 30 else 1.0 for k in range(6)]) for i in range(60)]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} double" for c in model.features))
    plain = {r.i: round(r.anomaly_score, 9) for r in model.with_score(df).collect()}
    assert plain == {r.i: round(r.anomaly_score, 9) for r in model.with_expression_score(df).collect()}


@pytest.mark.parametrize("key", [("id",), ()])
def test_forest_does_not_depend_on_partitions(spark, key):
    df = spark.createDataFrame(
        [(i, float(i * 7919 % 1000) + i / 3000, float(i % 97)) for i in range(3000)], "id long, a double, b double")
    found = []
    for n in (2, 7):
        model, out = IsolationForest(("a", "b"), n_trees=20, sample_size=64, key=key).fit_predict(df.repartition(n))
        found.append(sorted((r.id, r.prediction) for r in out.collect()))
    assert found[0] == found[1]


def test_one_class_svm_stops_by_its_rule(spark, monkeypatch):
    from ledgerpulse.operators.outliers import OneClassSvm

    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in rng.normal(size=(200, 2))], "a double, b double")
    once = fit_one_class_svm(df, ["a", "b"], 0.1)
    monkeypatch.setattr(OneClassSvm, "MOST_STEPS", 400)
    again = fit_one_class_svm(df, ["a", "b"], 0.1)
    np.testing.assert_allclose(once.weights, again.weights)
    # a dense solution of the same problem, by many small steps
    points = once._map()(np.array(df.collect(), dtype=float))
    w, share = points.mean(axis=0), 20
    for step in range(1, 3000):
        low = points[np.argsort(points @ w)[:share]].mean(axis=0)
        w = w + (low - w) / (step + 1)
    assert once.weights @ once.weights <= 1.05 * (w @ w)


def test_forest_without_key_draws_rows_and_not_values(spark):
    rng = np.random.default_rng(3)
    values = np.vstack([rng.uniform(0, 1, (2000, 2)), np.full((1000, 2), 5.0)])
    df = spark.createDataFrame(pd.DataFrame(values, columns=["a", "b"]))
    forest = IsolationForest(("a", "b"), n_trees=20, sample_size=64)
    assert forest._hashed(df).distinct().count() == 3000
    model = forest.grow(df)
    copies = model.nodes[model.nodes["feature"] < 0].groupby("tree")["size"].max()  # only copies make large leaves
    assert len(copies) == 20 and copies.between(8, 36).all() and 17 < copies.mean() < 26  # a third of 64
    again = forest.grow(df.repartition(7))
    ordered = [m.nodes.sort_values(["tree", "node"]).reset_index(drop=True) for m in (model, again)]
    assert ordered[0].equals(ordered[1])
