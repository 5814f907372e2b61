"""Work of the isolation forest: rows drawn and rows scored."""

import numpy as np
import pytest
from helpers import utc
from pyspark.sql import functions as F

from ledgerpulse.operators import iforest
from ledgerpulse.operators.iforest import IsolationForest, IsolationForestModel


def test_a_forest_scores_equal_rows_once(spark, monkeypatch):
    frame = spark.range(1200).select((F.col("id") % 120 * 37 % 50).cast("double").alias("a"), (F.col("id") % 120).cast("double").alias("b"))
    asked = []
    real = IsolationForestModel.with_score

    def with_score(self, df):
        asked.append(df.count())
        return real(self, df)
    monkeypatch.setattr(IsolationForestModel, "with_score", with_score)
    keyed = frame.withColumn("id", F.monotonically_increasing_id()).cache()
    model = IsolationForest(("a", "b"), n_trees=10, sample_size=64, contamination=0.2, key=("id",)).fit(keyed)
    assert asked == [120]
    scores = real(model, keyed).toPandas().anomaly_score
    assert model.offset == pytest.approx(float(np.quantile(-scores, 0.2)), rel=1e-12)


def test_live_events_are_scored_once(spark, monkeypatch, tmp_path):
    from ledgerpulse.plans.catalog import QUERIES

    events = [(i, utc(f"2025-06-01T{i % 24:02d}:00:00"), i % 7, "error" if i % 9 == 0 else "view", float(i % 40), '{"k": %d}' % (i % 10)) for i in range(300)]
    spark.createDataFrame(events, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(str(tmp_path / "events.parquet"))
    asked = []
    real = IsolationForestModel.with_score
    monkeypatch.setattr(IsolationForestModel, "with_score", lambda self, df: (asked.append(1), real(self, df))[1])
    out = QUERIES["iforest_live_model"](spark, str(tmp_path))
    assert out.count() == 300 and len(asked) == 1


def test_rows_of_a_tree_are_those_with_the_smallest_hashes(spark):
    df = spark.range(4000).select("id", (F.col("id") * 7919 % 1009).cast("double").alias("a"))
    forest = IsolationForest(("a",), n_trees=6, sample_size=32, key=("id",))
    found = forest.grow(df).nodes
    mix = lambda t: F.pmod(F.xxhash64(F.lit(42), "_draw", F.lit(t)), F.lit(iforest._HASH_RANGE))
    for t in range(6):
        drawn = forest._hashed(df).orderBy(mix(t), "_draw").limit(32).toPandas()[["a"]].to_numpy()
        grown = iforest.grow_tree(drawn, 5, np.random.default_rng([42, t]))
        part = found[found.tree == t].sort_values("node")
        assert [(n[0], n[2], n[6]) for n in sorted(grown)] == list(zip(part.node, part.threshold, part["size"]))
