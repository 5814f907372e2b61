"""Outlier models with one shape: fit on training rows, score any rows.

Each fitted model has `with_score` (adds `outlier_score`, larger is more
unusual) and a `threshold`, the quantile of the training scores that leaves
the share `contamination` above it. What is kept on the driver is a few
statistics per feature, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerpulse.operators.neighbours import PartitionTree, distinct_points
from ledgerpulse.operators.quantiles import exact_quantiles, weighted_order_statistics, weighted_quantiles
from ledgerpulse.session import cut_lineage

#: Number of equal rows that a row of a merged table stands for.
COPIES = "_copies"


def merged(train: DataFrame, features) -> DataFrame:
    """Each point once with its number of copies, stored; fitting then reads as many rows as there are different points."""
    points = distinct_points(train, list(features)).withColumnRenamed("w", COPIES)
    return cut_lineage(points.sortWithinPartitions(*features))


def _copies(df: DataFrame) -> Column:
    return F.col(COPIES) if COPIES in df.columns else F.lit(1)


def _quantile(df: DataFrame, column, probability: float) -> float | None:
    if COPIES in df.columns:
        return weighted_quantiles(df, column, COPIES, [probability])[0]
    return exact_quantiles(df, column, [probability])[0]


@dataclass
class Scaler:
    """Zero mean and unit population deviation; constant columns keep scale 1."""

    features: list[str]
    mean: list[float]
    scale: list[float]

    @staticmethod
    def fit(df: DataFrame, features) -> "Scaler":
        features = list(features)
        stats = df.agg(*[F.avg(c) for c in features], *[F.stddev_pop(c) for c in features]).first()
        n = len(features)
        return Scaler(features, [float(v or 0.0) for v in stats[:n]], [float(v or 0.0) or 1.0 for v in stats[n:]])

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
            for c, m, s in zip(self.features, self.mean, self.scale)})


@dataclass
class Gaussian:
    """Mean and population covariance, from one aggregate."""

    features: list[str]
    mean: np.ndarray
    covariance: np.ndarray

    @staticmethod
    def fit(df: DataFrame, features) -> "Gaussian":
        features = list(features)
        pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]
        row = df.agg(*[F.avg(c) for c in features],
                     *[F.covar_pop(F.col(features[i]).cast("double"), F.col(features[j]).cast("double"))
                       for i, j in pairs]).first()
        n = len(features)
        cov = np.zeros((n, n))
        for (i, j), value in zip(pairs, row[n:]):
            cov[i, j] = cov[j, i] = value or 0.0
        return Gaussian(features, np.array([v or 0.0 for v in row[:n]], dtype=float), cov)

    @staticmethod
    def fit_merged(points: DataFrame, features, near) -> "Gaussian":
        """The same of a merged table; `near`, some point near the mean, keeps the sums small."""
        features, w = list(features), F.col(COPIES)
        n = len(features)
        x = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(features, near)]
        pairs = [(i, j) for i in range(n) for j in range(i, n)]
        total, *found = points.agg(F.sum(w), *[F.min(c) for c in features], *[F.max(c) for c in features],
                                   *[F.sum(w * v) for v in x], *[F.sum(w * x[i] * x[j]) for i, j in pairs]).first()
        found = np.array([v or 0.0 for v in found], dtype=float)
        least, most, sums = found[:n], found[n:2 * n], found[2 * n:] / max(total or 0, 1)
        same = least == most  # a constant column varies by exactly nothing
        cov = np.zeros((n, n))
        for (i, j), value in zip(pairs, sums[n:]):
            cov[i, j] = cov[j, i] = 0.0 if same[i] or same[j] else value - sums[i] * sums[j]
        return Gaussian(features, np.where(same, least, np.array(near, dtype=float) + sums[:n]), cov)

    def centred(self) -> list[Column]:
        return [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(self.features, self.mean)]

    def squared_distance(self) -> Column:
        """Squared Mahalanobis distance as one expression."""
        precision = np.linalg.pinv(self.covariance, hermitian=True)
        x = self.centred()
        terms = [x[i] * x[j] * F.lit(float(precision[i, j] * (1 if i == j else 2)))
                 for i in range(len(x)) for j in range(i, len(x))]
        return sum(terms[1:], terms[0])

    def reconstruction_error(self, components: int) -> Column:
        """Squared error of the projection on the leading principal components."""
        _, vectors = np.linalg.eigh(self.covariance)
        x = self.centred()
        error = sum([v * v for v in x[1:]], x[0] * x[0])
        for k in range(1, components + 1):
            axis = vectors[:, -k]
            along = sum([F.lit(float(a)) * v for a, v in zip(axis[1:], x[1:])], F.lit(float(axis[0])) * x[0])
            error = error - along * along
        return F.greatest(error, F.lit(0.0))


class OutlierModel:
    threshold: float | None = None

    def with_score(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def set_threshold(self, train: DataFrame, contamination: float) -> "OutlierModel":
        kept = [COPIES] if COPIES in train.columns else []
        scored = self.with_score(train).select("outlier_score", *kept).persist()
        self.threshold = _quantile(scored, "outlier_score", 1.0 - contamination)
        scored.unpersist()
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.threshold is None:
            raise RuntimeError("Model must be trained before calling predict().")
        return self.with_score(df).withColumn(
            "prediction", (F.col("outlier_score") > F.lit(self.threshold)).cast("int"))


class _Expression(OutlierModel):
    def __init__(self, score: Column) -> None:
        self.score = score

    def with_score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("outlier_score", self.score)


# ---- robust covariance -------------------------------------------------------

#: Random starts, steps that all starts take together, starts that go on to the end.
STARTS, SHARED_STEPS, FINALISTS = 40, 2, 3
#: Bins per doubling of a squared distance, and the doublings told apart on both sides of 1.
_BINS, _DOUBLINGS = 8, 64


def chi2_quantile(p: float, degrees: int) -> float:
    """The value a chi-square variable exceeds with probability 1 - p, by bisection of the series of its distribution."""
    def below(x: float) -> float:
        a, half = degrees / 2, x / 2
        term = total = math.exp(a * math.log(half) - half - math.lgamma(a + 1)) if half > 0 else 0.0
        n = 1
        while term > total * 1e-16:
            term *= half / (a + n)
            total += term
            n += 1
        return total

    low, high = 0.0, 1.0
    while below(high) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return (low + high) / 2


def _start_points(train: DataFrame, features: list[str], starts: int) -> np.ndarray:
    """Points for the starts, `len(features)` + 1 each: different points with the smallest hashes; a bounded number."""
    wanted = starts * (len(features) + 1)
    rows = train.select(*features, F.xxhash64(*features).alias("_place")).distinct().orderBy("_place", *features).limit(wanted)
    points = rows.drop("_place").toPandas().to_numpy(dtype=float).reshape(-1, len(features))
    return points[: len(points) // (len(features) + 1) * (len(features) + 1)].reshape(-1, len(features) + 1, len(features))


def _shared_step(train: DataFrame, features: list[str], means: np.ndarray, precisions: np.ndarray, share: float) -> list[Gaussian]:
    """One concentration step of all starts in one pass: counts and moments by bin of the distance, summed before the shuffle.

    The bins up to the wanted share of the rows make the next mean and covariance.
    """
    n = len(features)
    bins, width = 2 * _DOUBLINGS * _BINS, 1 + n + n * n

    def sums(batches):
        total = np.zeros((len(means), bins, width))
        for batch in batches:
            x, w = batch[features].to_numpy(dtype=float), batch[COPIES].to_numpy(dtype=float)
            moments = np.hstack([np.ones((len(x), 1)), x, (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)]) * w[:, None]
            for i, (mean, precision) in enumerate(zip(means, precisions)):
                apart = x - mean
                d2 = np.maximum(((apart @ precision) * apart).sum(axis=1), 2.0 ** -_DOUBLINGS)
                place = np.clip(((np.log2(d2) + _DOUBLINGS) * _BINS).astype(int), 0, bins - 1)
                for j in range(width):
                    total[i, :, j] += np.bincount(place, moments[:, j], bins)
        used = np.argwhere(total[:, :, 0] > 0)
        yield pd.DataFrame({"start": used[:, 0].astype("int32"), "bin": used[:, 1].astype("int32"),
                            **{f"m{j}": total[used[:, 0], used[:, 1], j] for j in range(width)}})

    kinds = ", ".join(f"m{j} double" for j in range(width))
    # at most starts * bins rows come back, whatever the table holds
    found = (train.select(*features, _copies(train).alias(COPIES)).mapInPandas(sums, f"start int, bin int, {kinds}").groupBy("start", "bin")
             .agg(*[F.sum(f"m{j}").alias(f"m{j}") for j in range(width)]).toPandas().sort_values(["start", "bin"]))
    out = []
    for _, part in found.groupby("start"):
        m = part[[f"m{j}" for j in range(width)]].to_numpy()
        seen = np.cumsum(m[:, 0])
        upto = int(np.searchsorted(seen, share * seen[-1])) + 1
        whole = m[:upto].sum(axis=0)
        mean = whole[1:1 + n] / whole[0]
        out.append(Gaussian(features, mean, whole[1 + n:].reshape(n, n) / whole[0] - np.outer(mean, mean)))
    return out


def _volume(gaussian: Gaussian) -> float:
    sign, logdet = np.linalg.slogdet(gaussian.covariance)
    return logdet if sign > 0 else -math.inf


def _concentrate(train: DataFrame, gaussian: Gaussian, share: float) -> tuple[Gaussian, float]:
    """Repeated fits on the share of the rows nearest to the last fit, until the determinant stands still.

    Each step lowers the determinant or leaves it, and there are finitely many such sets of rows.
    """
    volume = math.inf
    while True:
        distance = gaussian.squared_distance()
        cut = _quantile(train, distance, share)
        inner = train.filter(distance <= F.lit(cut))
        if COPIES in train.columns:
            gaussian = Gaussian.fit_merged(inner, gaussian.features, gaussian.mean)
        else:
            gaussian = Gaussian.fit(inner, gaussian.features)
        now = _volume(gaussian)
        if not now < volume - 1e-9:
            return gaussian, now
        volume = now


def minimum_covariance(train: DataFrame, features) -> Gaussian:
    """The Gaussian of half of the rows with (nearly) the smallest determinant.

    The plain fit of all rows and many random starts, each through one point more than there are features, take
    `SHARED_STEPS` steps together; the best `FINALISTS` go on to the end.
    """
    features = list(features)
    n = len(features)
    if COPIES not in train.columns:
        train = merged(train, features)
    total, *means = train.agg(F.coalesce(F.sum(COPIES), F.lit(0)), *[F.avg(c) for c in features]).first()
    share = min(1.0, (total + n + 1) / 2 / max(total, 1))
    plain = Gaussian.fit_merged(train, features, [m or 0.0 for m in means])
    candidates = [plain]
    for points in _start_points(train, features, STARTS):
        spread = np.cov(points.T, bias=True).reshape(n, n)
        candidates.append(Gaussian(features, points.mean(axis=0), spread + 1e-9 * np.trace(spread) * np.eye(n)))
    for _ in range(SHARED_STEPS):
        usable = [c for c in candidates if np.isfinite(c.covariance).all()]
        precisions = np.array([np.linalg.pinv(c.covariance, hermitian=True) for c in usable])
        candidates = _shared_step(train, features, np.array([c.mean for c in usable]), precisions, share)
    found = [_concentrate(train, c, share) for c in [plain, *sorted(candidates, key=_volume)[:FINALISTS]]]
    return min(found, key=lambda f: f[1])[0]


def fit_elliptic_envelope(train: DataFrame, features, contamination: float = 0.1) -> OutlierModel:
    """Robust Gaussian: the half of the rows with the smallest covariance, made consistent and fitted again.

    The covariance is scaled so that the median squared distance is that of a Gaussian; rows nearer than its 0.975 quantile
    make the final mean and covariance.
    """
    features = list(features)
    train = merged(train, features)
    half = minimum_covariance(train, features)
    middle = _quantile(train, half.squared_distance(), 0.5) or 0.0
    if middle > 0:
        scaled = Gaussian(features, half.mean, half.covariance * (middle / chi2_quantile(0.5, len(features))))
        near = scaled.squared_distance() < F.lit(chi2_quantile(0.975, len(features)))
        half = Gaussian.fit_merged(train.filter(near), features, half.mean)
    model = _Expression(half.squared_distance()).set_threshold(train, contamination)
    model.gaussian = half
    return model


def fit_linear_autoencoder(train: DataFrame, features, contamination: float = 0.1,
                           components: int | None = None) -> OutlierModel:
    """Reconstruction error of a linear auto-encoder, whose optimum is the principal subspace."""
    features = list(features)
    width = components or max(1, len(features) - 1)
    return _Expression(Gaussian.fit(train, features).reconstruction_error(width)).set_threshold(train, contamination)


# ---- auto-encoder with hidden layers ---------------------------------------

class AutoEncoder(OutlierModel):
    """Reconstruction error of a network: features, hidden layer, narrow layer, hidden layer, features (tanh, linear ends).

    Loss and gradient of all rows are summed over the partitions in one pass; a few hundred numbers come back, and a limited-memory
    quasi-Newton step (L-BFGS) moves the weights. A tenth of the rows, by their hash, is held out: steps end when its
    loss has not fallen for `PATIENCE` steps, and the weights with its lowest loss stay. Features are standardised inside.
    """

    PATIENCE, MOST_STEPS, MEMORY = 10, 300, 12

    def __init__(self, features, hidden: int, width: int, seed: int) -> None:
        self.features, self.seed = list(features), seed
        n = len(self.features)
        self.shapes = [(n, hidden), (hidden,), (hidden, width), (width,), (width, hidden), (hidden,), (hidden, n), (n,)]
        self.mean, self.scale = np.zeros(n), np.ones(n)
        self.weights = np.zeros(sum(math.prod(s) for s in self.shapes))
        self.steps = 0

    def _network(self):
        shapes, mean, scale = self.shapes, self.mean, self.scale

        def layers(weights: np.ndarray) -> list[np.ndarray]:
            at, out = 0, []
            for shape in shapes:
                out.append(weights[at:at + math.prod(shape)].reshape(shape))
                at += math.prod(shape)
            return out

        def forward(weights: np.ndarray, rows: np.ndarray):
            w1, b1, w2, b2, w3, b3, w4, b4 = layers(weights)
            x = (rows - mean) / scale
            first = np.tanh(x @ w1 + b1)
            narrow = np.tanh(first @ w2 + b2)
            second = np.tanh(narrow @ w3 + b3)
            return x, first, narrow, second, second @ w4 + b4 - x

        def gradient(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
            _, _, w2, _, w3, _, w4, _ = layers(weights)
            x, first, narrow, second, error = forward(weights, rows)
            back = [2 * error]
            for output, w in ((second, w4), (narrow, w3), (first, w2)):
                back.append(back[-1] @ w.T * (1 - output * output))
            parts = []
            for given, delta in zip((x, first, narrow, second), reversed(back)):
                parts += [(given.T @ delta).ravel(), delta.sum(axis=0)]
            return np.concatenate(parts)

        return forward, gradient

    def _pass(self, rows: DataFrame, weights: np.ndarray) -> tuple[float, float, np.ndarray]:
        """Mean loss of the training rows and of the held-out ones, and the gradient of the former."""
        forward, gradient = self._network()
        features, size = self.features, len(weights)

        def sums(batches):
            total = np.zeros(size + 4)
            for batch in batches:
                x, held = batch[features].to_numpy(dtype=float), batch["_held"].to_numpy(dtype=bool)
                losses = (forward(weights, x)[-1] ** 2).sum(axis=1)
                total[:4] += [(~held).sum(), losses[~held].sum(), held.sum(), losses[held].sum()]
                total[4:] += gradient(weights, x[~held])
            yield pd.DataFrame({"slot": np.arange(size + 4), "part": total})

        found = rows.mapInPandas(sums, "slot int, part double").groupBy("slot").agg(F.sum("part").alias("v")).toPandas()
        total = np.zeros(size + 4)
        total[found["slot"]] = found["v"]
        seen = max(total[0], 1.0)
        return total[1] / seen, total[3] / total[2] if total[2] else total[1] / seen, total[4:] / seen

    def fit(self, train: DataFrame, contamination: float) -> "AutoEncoder":
        rows = train.select(*[F.col(c).cast("double").alias(c) for c in self.features])
        held = F.pmod(F.xxhash64(*self.features, F.lit(self.seed)), F.lit(10)) == 0
        rows = cut_lineage(rows.withColumn("_held", held))
        scaler = Scaler.fit(rows, self.features)
        self.mean, self.scale = np.array(scaler.mean), np.array(scaler.scale)
        rng = np.random.default_rng(self.seed)
        weights = np.concatenate([rng.normal(0, 1 / math.sqrt(s[0]), s).ravel() if len(s) == 2 else np.zeros(s) for s in self.shapes])
        loss, outside, slope = self._pass(rows, weights)
        best, self.weights, waited, pairs = outside, weights, 0, []
        while waited < self.PATIENCE and self.steps < self.MOST_STEPS:
            direction = -self._curved(slope, pairs)
            reach = float(direction @ slope)
            if reach >= 0:
                direction, pairs, reach = -slope, [], -float(slope @ slope)
            length = 1.0 if pairs else 1.0 / max(1.0, math.sqrt(-reach))
            while True:
                moved = self._pass(rows, weights + length * direction)
                if moved[0] <= loss + 1e-4 * length * reach or length < 1e-8:
                    break
                length /= 2
            self.steps += 1
            change, turn = length * direction, moved[2] - slope
            if change @ turn > 1e-12:
                pairs = [*pairs, (change, turn)][-self.MEMORY:]
            weights, (loss, outside, slope) = weights + change, moved
            waited = 0 if outside < best * (1 - 1e-3) else waited + 1
            if outside < best:
                best, self.weights = outside, weights
            if length < 1e-8:
                break
        return self.set_threshold(rows, contamination)

    @staticmethod
    def _curved(slope: np.ndarray, pairs: list) -> np.ndarray:
        """The slope times the inverse curvature that the last moves tell (two-loop recursion)."""
        q, used = slope.copy(), []
        for s, y in reversed(pairs):
            a = (s @ q) / (s @ y)
            used.append(a)
            q = q - a * y
        if pairs:
            s, y = pairs[-1]
            q = q * ((s @ y) / (y @ y))
        for (s, y), a in zip(pairs, reversed(used)):
            q = q + s * (a - (y @ q) / (s @ y))
        return q

    def with_score(self, df: DataFrame) -> DataFrame:
        (forward, _), weights = self._network(), self.weights

        @pandas_udf("double")
        def error(*columns: pd.Series) -> pd.Series:
            block = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series((forward(weights, block)[-1] ** 2).sum(axis=1))
        return df.withColumn("outlier_score", error(*[F.col(c).cast("double") for c in self.features]))


def fit_autoencoder(train: DataFrame, features, contamination: float = 0.1, hidden: int = 16, width: int | None = None, seed: int = 42) -> AutoEncoder:
    features = list(features)
    return AutoEncoder(features, hidden, width or max(1, len(features) - 1), seed).fit(train, contamination)


# ---- one-class SVM ---------------------------------------------------------

def nearest_to_origin(atoms: np.ndarray, rounds: int = 10_000, tolerance: float = 1e-12) -> np.ndarray:
    """Weights of the point of least norm in the convex hull of the rows of `atoms`: pairwise steps of exact length."""
    gram = atoms @ atoms.T
    weights = np.zeros(len(atoms))
    weights[int(np.argmin(np.diag(gram)))] = 1.0
    along = gram @ weights
    for _ in range(rounds):
        best = int(np.argmin(along))
        held = np.flatnonzero(weights > 0)
        worst = int(held[np.argmax(along[held])])
        gap = along[worst] - along[best]
        if gap <= tolerance * max(float(weights @ along), 1e-300):
            break
        curve = gram[best, best] + gram[worst, worst] - 2 * gram[best, worst]
        step = weights[worst] if curve <= 0 else min(weights[worst], gap / curve)
        weights[best] += step
        weights[worst] = 0.0 if step == weights[worst] else weights[worst] - step
        along += step * (gram[best] - gram[worst])
    return weights


class OneClassSvm(OutlierModel):
    """One-class SVM with an RBF kernel, on landmarks.

    The kernel is that of the projections on `landmarks` points (Nystroem): exact between landmarks, and with as many landmarks as
    different rows everywhere. The weights are the point of least norm among the means of a share `nu` of the rows, which
    is the dual of the SVM. Each step adds the mean of the rows with the lowest margins, found with an exact order
    statistic, to the means held so far, and takes the nearest point of their hull. The steps end when the duality gap
    is at most `TOLERANCE` of the squared norm; the margins are then within the root of the gap of the optimal ones. Weights
    and means have one number per landmark; no rows are held but the landmarks. Equal rows are one row with a count.
    """

    TOLERANCE, MOST_STEPS = 1e-4, 400

    def __init__(self, features, nu: float, landmarks: int) -> None:
        self.features, self.nu, self.landmarks = list(features), nu, landmarks
        self.points = self.lift = self.weights = None
        self.gamma = self.gap = 0.0

    def _kernel(self):
        """Kernel values of a block of rows with the landmarks."""
        points, gamma = self.points, self.gamma

        def kernel(block: np.ndarray) -> np.ndarray:
            apart = (block ** 2).sum(axis=1)[:, None] + (points ** 2).sum(axis=1)[None, :] - 2 * block @ points.T
            return np.exp(-gamma * np.maximum(apart, 0.0))
        return kernel

    def _map(self):
        kernel, lift = self._kernel(), self.lift
        return lambda block: kernel(block) @ lift

    def _image_sums(self, rows: DataFrame, group: Column) -> dict[int, tuple[float, np.ndarray]]:
        """Per group its number of rows, copies included, and the sum of their feature images.

        Kernel values are summed before the shuffle and go to feature space once. Sums of decimals do not depend on their order.
        """
        kernel, features, slots = self._kernel(), self.features, len(self.points) + 1

        def sums(batches):
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                of, w = batch["_group"].to_numpy(), batch[COPIES].to_numpy(dtype=float)
                values = np.column_stack([kernel(batch[features].to_numpy(dtype=float)), np.ones(len(batch))])
                for g in np.unique(of):
                    total[int(g)] = total.get(int(g), np.zeros(slots)) + w[of == g] @ values[of == g]
            for g, part in total.items():
                yield pd.DataFrame({"of": g, "slot": np.arange(slots), "part": part})

        table = (rows.select(*features, COPIES, group.cast("int").alias("_group")).mapInPandas(sums, "of int, slot int, part double")
                 .groupBy("of", "slot").agg(F.sum(F.col("part").cast("decimal(38,16)")).cast("double").alias("total")).toPandas())
        found = {}
        for g, part in table.sort_values("slot").groupby("of"):
            whole = part["total"].to_numpy(dtype=float)
            found[int(g)] = (whole[-1], whole[:-1] @ self.lift)
        return found

    def _margin(self) -> Column:
        kernel, weights = self._kernel(), self.lift @ self.weights

        @pandas_udf("double")
        def margin(*columns: pd.Series) -> pd.Series:
            block = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            return pd.Series(kernel(block) @ weights)
        return margin(*[F.col(c).cast("double") for c in self.features])

    def fit(self, train: DataFrame) -> "OneClassSvm":
        train = merged(train, self.features)
        w = F.col(COPIES)
        total, *moments = train.agg(F.sum(w), *[F.sum(w * F.col(c)) for c in self.features],
                                    *[F.sum(w * F.col(c) * F.col(c)) for c in self.features]).first()
        n = len(self.features)
        mean, square = np.array(moments[:n], dtype=float) / total, np.array(moments[n:], dtype=float) / total
        variance = square.mean() - mean.mean() ** 2  # over all entries of the matrix
        self.gamma = 1.0 / (n * variance) if variance > 0 else 1.0 / n
        # different points with the smallest hashes: at most `landmarks` of them
        chosen = train.select(*self.features, F.xxhash64(*self.features).alias("_place")).orderBy("_place", *self.features).limit(self.landmarks)
        self.points = chosen.drop("_place").toPandas().to_numpy(dtype=float).reshape(-1, n)
        values, vectors = np.linalg.eigh(self._kernel()(self.points))
        kept = values > 1e-12 * values.max()
        self.lift = vectors[:, kept] / np.sqrt(values[kept])
        place = max(0, math.ceil(self.nu * total) - 1)
        size, image = self._image_sums(train, F.lit(0))[0]
        atoms = [image / size]
        self.weights = atoms[0]
        for _ in range(self.MOST_STEPS):
            scored = train.withColumn("_margin", self._margin()).persist()
            edge = weighted_order_statistics(scored, "_margin", COPIES, [place])[0]
            # of the rows on the edge as many as fill the share, all alike
            parts = self._image_sums(scored.filter(F.col("_margin") <= edge), F.col("_margin") == edge)
            scored.unpersist()
            wanted = self.nu * total
            (below, inner), (on, outer) = parts.get(0, (0, 0.0)), parts[1]
            pull = outer / on if not below else (inner + (wanted - below) * (outer / on)) / wanted
            self.gap = float(self.weights @ (self.weights - pull))
            if self.gap <= self.TOLERANCE * float(self.weights @ self.weights):
                break
            atoms.append(pull)
            shares = nearest_to_origin(np.array(atoms))
            self.weights = shares @ np.array(atoms)
            atoms = [a for a, s in zip(atoms, shares) if s > 0]
        self.set_threshold(train, self.nu)
        return self

    def with_score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("outlier_score", -self._margin())


def fit_one_class_svm(train: DataFrame, features, nu: float = 0.2, landmarks: int = 256) -> OneClassSvm:
    return OneClassSvm(features, nu, landmarks).fit(train)


# ---- local outlier factor --------------------------------------------------

class LocalOutlierFactor(OutlierModel):
    """Local density against that of the neighbours (Breunig et al. 2000), exact.

    Copies of a point count as neighbours at distance 0. New points are
    compared with the training points; a training point leaves itself out.
    """

    def __init__(self, features, k: int) -> None:
        self.features, self.k = list(features), k
        self.tree: PartitionTree | None = None
        self.density: DataFrame | None = None

    def _fill(self, found: DataFrame) -> DataFrame:
        """Neighbours with `take`, how many of the k places each one fills."""
        before = (Window.partitionBy(*self.features).orderBy("rank")
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        room = F.lit(self.k) - (F.sum("w").over(before) - F.col("w"))
        return found.withColumn("take", F.greatest(F.lit(0), F.least(F.col("w"), room))).filter(F.col("take") > 0)

    def _joined(self, table: DataFrame, values: DataFrame, name: str) -> DataFrame:
        """Adds a value of the neighbour point."""
        renamed = values.select(*[F.col(c).alias(f"n_{c}") for c in self.features], F.col(name).alias(f"n_{name}"))
        return table.join(renamed, [f"n_{c}" for c in self.features])

    def _density(self, table: DataFrame, reach: DataFrame) -> DataFrame:
        joined = self._joined(table, reach, "k_distance")
        mean = F.sum(F.col("take") * F.greatest("n_k_distance", "dist")) / F.sum("take")
        return joined.groupBy(*self.features).agg((1.0 / (mean + 1e-10)).alias("density"))

    def _factor(self, table: DataFrame, own: DataFrame) -> DataFrame:
        joined = self._joined(table, self.density, "density").join(own, self.features)
        mean = F.sum(F.col("take") * F.col("n_density")) / F.sum("take")
        return joined.groupBy(*self.features).agg((mean / F.first("density")).alias("outlier_score"))

    def fit(self, train: DataFrame, contamination: float) -> "LocalOutlierFactor":
        total = train.count()
        if total < 2:
            raise ValueError("local outlier factor needs at least two training rows")
        self.k = min(self.k, total - 1)
        # every step is stored once, so the plan of the next one stays small
        self.tree = PartitionTree(distinct_points(train, self.features), self.features)
        self.found = cut_lineage(self.tree.nearest_of_own(self.k + 1))
        table = cut_lineage(self._fill(self.found.withColumn("w", F.when(F.col("dist") == 0, F.col("w") - 1).otherwise(F.col("w")))))
        self.reach = cut_lineage(table.groupBy(*self.features).agg(F.max("dist").alias("k_distance")))
        self.density = cut_lineage(self._density(table, self.reach))
        factors = self._factor(table, self.density)
        rows = train.select(*[F.col(c).cast("double").alias(c) for c in self.features])
        scored = cut_lineage(rows.join(factors, self.features).select("outlier_score"))
        self.threshold = exact_quantiles(scored, "outlier_score", [1.0 - contamination])[0]
        return self

    def with_score(self, df: DataFrame) -> DataFrame:
        points = distinct_points(df, self.features).select(*self.features)
        # the neighbours of training points are known: each is its own first
        known = self.found.join(points, self.features, "left_semi")
        new = self.tree.nearest(points.join(self.tree.placed, self.features, "left_anti"), self.k)
        table = cut_lineage(self._fill(known.unionByName(new)))
        factors = self._factor(table, self._density(table, self.reach))
        return df.withColumns({c: F.col(c).cast("double") for c in self.features}).join(factors, self.features)


def fit_local_outlier_factor(train: DataFrame, features, k: int = 2, contamination: float = 0.2) -> LocalOutlierFactor:
    return LocalOutlierFactor(features, k).fit(train, contamination)
