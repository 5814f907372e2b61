"""Unions and key-set comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Rows of all feeds; a column a feed lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def key_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every non-null key once, with `in_left` and `in_right`.

    Both directions come from one shuffle of keys that are combined on the map side.
    """
    def marked(df, in_left):
        return df.select(key, F.lit(in_left).alias("in_left"), F.lit(not in_left).alias("in_right"))
    return (marked(left, True).unionAll(marked(right, False)).filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.bool_or("in_left").alias("in_left"), F.bool_or("in_right").alias("in_right")))


def key_set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only, with the side. Empty means equal sets."""
    sides = key_sides(left, right, key).filter(F.col("in_left") != F.col("in_right"))
    return sides.select(key, F.when(F.col("in_left"), "left").otherwise("right").alias("only_in"))


def is_subset(left: DataFrame, right: DataFrame, key: str) -> bool:
    keys = left.select(key).filter(F.col(key).isNotNull()).distinct()
    return keys.join(right.select(key).distinct(), key, "left_anti").isEmpty()
