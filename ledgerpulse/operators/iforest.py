"""Isolation forest (Liu, Ting, Zhou 2008) fitted and scored on Spark.

Fitting: one pass keeps a bounded random pool of rows, every tree draws its
own sub-sample from the pool, and each tree is grown in its own task. The node
table has at most `n_trees * (2 * sample_size - 1)` rows, a bound that does not
depend on the data, so it is collected and sent to executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerpulse.operators.quantiles import exact_quantiles, weighted_quantiles
from ledgerpulse.schemas import require_columns
from ledgerpulse.session import cut_lineage

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "depth int, size long")
META_SCHEMA = "features array<string>, sample_size int, contamination double, offset double"
_HASH_RANGE = 1 << 40
_COPIES = 1024


def average_path(n) -> np.ndarray:
    """Expected path length of an unsuccessful search among n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    value = 2.0 * (np.log(big - 1.0) + 0.5772156649015329) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def grow_tree(rows: np.ndarray, height: int, rng: np.random.Generator) -> list[tuple]:
    """Node tuples (node, feature, threshold, left, right, depth, size) of one tree."""
    nodes: list[tuple] = []
    pending = [(0, rows, 0)]
    following = 1
    while pending:
        node, part, depth = pending.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= height or len(part) <= 1 or not len(usable):
            nodes.append((node, -1, 0.0, -1, -1, depth, len(part)))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        if cut >= high[feature]:  # neighbouring doubles can round up
            cut = float(low[feature])
        goes_left = part[:, feature] <= cut
        nodes.append((node, feature, cut, following, following + 1, depth, len(part)))
        pending += [(following, part[goes_left], depth + 1), (following + 1, part[~goes_left], depth + 1)]
        following += 2
    return nodes


def _present(column: Column) -> Column:
    """A feature as a double; null and NaN count as 0, infinities stay beyond every threshold."""
    return F.coalesce(F.nanvl(column.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


@dataclass
class IsolationForestModel:
    features: list[str]
    nodes: pd.DataFrame
    sample_size: int
    contamination: float
    offset: float | None = None
    _packed: tuple | None = field(default=None, repr=False)

    def _arrays(self) -> tuple:
        """All trees as flat arrays; a leaf points to itself, a right child follows the left one."""
        if self._packed is None:
            table = self.nodes.sort_values(["tree", "node"]).reset_index(drop=True)
            start = table.groupby("tree")["node"].transform("size").groupby(table["tree"]).first().cumsum()
            base = dict(zip(start.index, [0, *start.tolist()[:-1]]))
            first = table["tree"].map(base).to_numpy()
            position = np.arange(len(table))
            leaf = table["feature"].to_numpy() < 0
            self._packed = (
                np.where(leaf, 0, table["feature"]).astype(np.intp),
                np.where(leaf, np.inf, table["threshold"]),
                np.where(leaf, position, first + table["left"]).astype(np.intp),
                table["depth"].to_numpy() + average_path(table["size"]),
                np.array(sorted(base.values()), dtype=np.intp),
                int(table["depth"].max()),
            )
        return self._packed

    def _score_column(self) -> Column:
        feature, cut, left, length, roots, height = self._arrays()
        norm = float(average_path(self.sample_size)) or 1.0

        def score_block(block: np.ndarray) -> np.ndarray:
            at = np.tile(roots, (len(block), 1))
            start = (np.arange(len(block)) * block.shape[1])[:, None]
            flat = np.nan_to_num(block).ravel()
            for _ in range(height):
                at = left.take(at) + (flat.take(start + feature.take(at)) > cut.take(at))
            return np.exp2(-length.take(at).mean(axis=1) / norm)

        @pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            block = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            parts = [score_block(block[i:i + 1024]) for i in range(0, len(block), 1024)]
            return pd.Series(np.concatenate(parts) if parts else np.empty(0))

        return score(*[_present(F.col(c)) for c in self.features])

    def with_score(self, df: DataFrame) -> DataFrame:
        """Adds `anomaly_score` in (0, 1]; larger is more anomalous."""
        require_columns(df, self.features, "input")
        return df.withColumn("anomaly_score", self._score_column())

    def with_labels(self, scored: DataFrame) -> DataFrame:
        """Adds decision (negative is anomalous), prediction (1/0) and label (-1/1)."""
        if self.offset is None:
            raise RuntimeError("Model must be trained before calling predict().")
        decision = -F.col("anomaly_score") - F.lit(self.offset)
        return (scored.withColumn("decision", decision)
                .withColumn("prediction", F.when(F.col("decision") < 0, 1).otherwise(0))
                .withColumn("label", F.when(F.col("decision") < 0, -1).otherwise(1)))

    def transform(self, df: DataFrame) -> DataFrame:
        return self.with_labels(self.with_score(df))

    def expression(self, column=lambda name: name) -> str:
        """The mean path length as one SQL expression. For small forests only."""
        trees = []
        for _, tree in self.nodes.groupby("tree"):
            by_id = {int(r.node): r for r in tree.itertuples()}

            def text(node: int) -> str:
                r = by_id[node]
                if r.feature < 0:
                    return repr(float(r.depth + average_path(r.size)))
                return (f"case when coalesce(nanvl(cast({column(self.features[r.feature])} as double), null), 0D) <= {float(r.threshold)!r}D "
                        f"then {text(int(r.left))} else {text(int(r.right))} end")
            trees.append(f"({text(0)})")
        return f"({' + '.join(trees)}) / {float(len(trees))!r}"

    def with_expression_score(self, df: DataFrame) -> DataFrame:
        """Same score as a generated expression, without Python workers; for small forests."""
        norm = float(average_path(self.sample_size)) or 1.0
        return df.withColumn("anomaly_score", F.pow(F.lit(2.0), -F.expr(self.expression()) / F.lit(norm)))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        meta = [(self.features, self.sample_size, self.contamination, self.offset)]
        spark.createDataFrame(meta, META_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IsolationForestModel":
        from ledgerpulse.sources.files import path_exists

        if not path_exists(spark, f"{path}/nodes"):
            raise FileNotFoundError(f"Pre-trained model not found at '{path}'.")
        meta = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta").first()
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/nodes").toPandas()
        return IsolationForestModel(list(meta["features"]), nodes, meta["sample_size"],
                                    meta["contamination"], meta["offset"])


@dataclass
class IsolationForest:
    """`key` names columns that identify a row.

    Every tree takes the `sample_size` rows with the smallest hash of (key, tree), at any size of the table; without
    a key equal rows are counted and numbered, and each copy has a hash of its own.
    """

    features: tuple[str, ...]
    n_trees: int = 100
    sample_size: int = 256
    contamination: float = 0.05
    seed: int = 42
    key: tuple[str, ...] = ()

    def _hashed(self, df: DataFrame) -> DataFrame:
        """The features with one hash per row, of its key or else of its values and number among its copies."""
        values = [_present(F.col(c)).alias(c) for c in self.features]
        draw = lambda *of: F.pmod(F.xxhash64(F.lit(self.seed), *of), F.lit(_HASH_RANGE)).alias("_draw")
        if self.key:
            return df.select(draw(*self.key), *values)
        counted = df.select(*values).groupBy(*self.features).agg((F.count("*") - 1).alias("_last"))
        # a value of very many rows is dealt out in parts
        parts = (counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_last") / _COPIES))).alias("_part"))
                 .repartition(*self.features, "_part"))
        first = F.col("_part") * _COPIES
        copies = parts.select(*self.features, F.explode(F.sequence(first, F.least(first + (_COPIES - 1), "_last"))).alias("_copy"))
        return copies.select(draw(*self.features, "_copy"), *self.features)

    def grow(self, df: DataFrame) -> IsolationForestModel:
        """Fit the trees; the threshold is still open."""
        require_columns(df, self.features, "features_df")
        total = df.count()
        if not total:
            raise ValueError("features_df is empty: nothing to train on.")
        psi = min(self.sample_size, total)
        height = max(1, math.ceil(math.log2(max(psi, 2))))
        # (row, tree) pairs that may be among the psi smallest hashes of a tree
        limit = int(_HASH_RANGE * min(1.0, 1.5 * psi / total + 20.0 / total))
        mix = lambda t: F.pmod(F.xxhash64(F.lit(self.seed), F.col("_draw"), t), F.lit(_HASH_RANGE))
        trees = F.explode(F.sequence(F.lit(0), F.lit(self.n_trees - 1))).alias("tree")  # compiled, unlike a filter of an array
        tasks = min(self.n_trees, df.sparkSession.sparkContext.defaultParallelism)
        # one group per tree: few bytes, so the number of tasks is set by hand
        pairs = self._hashed(df).select("*", trees).filter(mix(F.col("tree")) < limit).repartition(tasks, "tree")
        ranked = F.row_number().over(Window.partitionBy("tree").orderBy(mix(F.col("tree")), "_draw"))
        drawn = pairs.withColumn("_rank", ranked).filter(F.col("_rank") <= psi)
        features, seed = list(self.features), self.seed

        def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            tree = int(key[0])
            matrix = np.nan_to_num(rows.sort_values("_rank")[features].to_numpy(dtype=float))
            grown = grow_tree(matrix, height, np.random.default_rng([seed, tree]))
            out = pd.DataFrame(grown, columns=["node", "feature", "threshold", "left", "right", "depth", "size"])
            out.insert(0, "tree", tree)
            return out

        nodes = drawn.groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
        return IsolationForestModel(features, nodes, psi, self.contamination)

    def fit(self, df: DataFrame) -> IsolationForestModel:
        """Equal rows are scored once, for the threshold."""
        model = self.grow(df)
        points = df.select(*[_present(F.col(c)).alias(c) for c in self.features]).groupBy(*self.features).agg(F.count("*").alias("_copies"))
        scored = model.with_score(points).select("anomaly_score", "_copies").persist()
        model.offset = weighted_quantiles(scored, -F.col("anomaly_score"), "_copies", [self.contamination])[0]
        scored.unpersist()
        return model

    def fit_predict(self, df: DataFrame) -> tuple[IsolationForestModel, DataFrame]:
        """Fit on df and label its rows; scores are computed once and stored."""
        model = self.grow(df)
        scored = cut_lineage(model.with_score(df))
        # the share `contamination` of training rows lies below the threshold
        model.offset = exact_quantiles(scored, -F.col("anomaly_score"), [self.contamination])[0]
        return model, model.with_labels(scored)


def fixed_forest() -> IsolationForestModel:
    """A small frozen forest on the live-event features."""
    # Tree, node, feature, threshold, left, right, depth, size.
    rows = [
        (0, 0, 3, 0.5, 1, 2, 0, 256), (0, 1, 2, 0.5, 3, 4, 1, 240), (0, 2, -1, 0.0, -1, -1, 1, 16),
        (0, 3, -1, 0.0, -1, -1, 2, 228), (0, 4, -1, 0.0, -1, -1, 2, 12),
        (1, 0, 0, 150.0, 1, 2, 0, 256), (1, 1, 4, 0.5, 3, 4, 1, 236), (1, 2, 1, 0.5, 5, 6, 1, 20),
        (1, 3, -1, 0.0, -1, -1, 2, 190), (1, 4, -1, 0.0, -1, -1, 2, 46),
        (1, 5, -1, 0.0, -1, -1, 2, 15), (1, 6, -1, 0.0, -1, -1, 2, 5),
        (2, 0, 2, 0.5, 1, 2, 0, 256), (2, 1, 5, 3.5, 3, 4, 1, 244), (2, 2, -1, 0.0, -1, -1, 1, 12),
        (2, 3, -1, 0.0, -1, -1, 2, 40), (2, 4, -1, 0.0, -1, -1, 2, 204),
    ]
    from ledgerpulse.schemas import LIVE_FEATURES

    columns = ["tree", "node", "feature", "threshold", "left", "right", "depth", "size"]
    return IsolationForestModel(list(LIVE_FEATURES), pd.DataFrame(rows, columns=columns), 256, 0.05, -0.5)
