"""Exact order statistics without sorting or gathering the column.

Spark's exact percentile keeps every distinct value of a group in one task.
Here each round brackets the wanted ranks with an approximate percentile,
whose sketches merge across tasks, and counts exactly what lies on either
side. What remains between the brackets is a few thousandths of the rows, so
two or three rounds leave few enough values to look at.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = 20_000
ACCURACY = 10_000
#: Bins of equal width into which a round deals values that have weights.
BINS = 4096


def _select(values: DataFrame, ranks: list[int], count: int) -> dict[int, float]:
    """Value at each 0-based rank among the `count` values."""
    if not ranks:
        return {}
    if count <= SMALL:
        ordered = sorted(row[0] for row in values.collect())
        return {r: ordered[r] for r in ranks}
    margin = 2.0 / ACCURACY
    low, high = values.agg(F.percentile_approx("v", [
        max(0.0, min(ranks) / count - margin), min(1.0, max(ranks) / count + margin)], ACCURACY)).first()[0]
    v = F.col("v")
    # the pieces below, at and between the brackets, in rising order
    pieces = [v < low, v == low, (v > low) & (v < high), (v == high) & F.lit(high > low), v > high]
    sizes = values.agg(*[F.count_if(p) for p in pieces]).first()
    found: dict[int, float] = {}
    start = 0
    for piece, size, same in zip(pieces, sizes, (None, low, None, high, None)):
        inside = [r for r in ranks if start <= r < start + size]
        if same is not None:
            found.update(dict.fromkeys(inside, same))
        else:
            part = _select(values.filter(piece), [r - start for r in inside], size)
            found.update({r + start: x for r, x in part.items()})
        start += size
    return found


def _column(df: DataFrame, column) -> DataFrame:
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    return df.select(value.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))


def order_statistics(df: DataFrame, column, ranks: list[int]) -> list[float]:
    """Values at the given 0-based ranks. Reads `df` a few times: persist it if it is costly."""
    values = _column(df, column)
    count = values.count()
    if ranks and (max(ranks) >= count or min(ranks) < 0):
        raise ValueError("rank outside the data")
    found = _select(values, sorted(set(ranks)), count)
    return [found[r] for r in ranks]


def exact_quantiles(df: DataFrame, column, probabilities: list[float]) -> list[float | None]:
    """Linearly interpolated quantiles; None for an empty column."""
    values = _column(df, column)
    count = values.count()
    if not count:
        return [None] * len(probabilities)
    result = []
    for p in probabilities:
        position = (count - 1) * p
        below = math.floor(position)
        weight = position - below
        found = _select(values, [below] if weight == 0 else [below, below + 1], count)
        low = found[below]
        result.append(low if weight == 0 else low + (found[below + 1] - low) * weight)
    return result


def _weighted_select(values: DataFrame, ranks: list[int], count: int, low: float, high: float) -> dict[int, float]:
    """Value at each 0-based rank where every one of the `count` rows (v, n) between low and high stands for n equal values."""
    if low == high:
        return dict.fromkeys(ranks, low)
    if count <= SMALL:
        pairs = sorted(tuple(row) for row in values.select("v", "n").collect())
        ends = list(accumulate(n for _, n in pairs))
        return {r: pairs[bisect_right(ends, r)][0] for r in ranks}
    v = F.col("v")
    if math.isinf(low) or math.isinf(high):
        place = F.when(v == -math.inf, 0).when(v == math.inf, 2).otherwise(1)
    else:
        place = F.floor((v / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2) * BINS)  # halves, as the width may exceed a double
    dealt = values.withColumn("_bin", F.least(place, F.lit(BINS - 1)))
    sizes = dealt.groupBy("_bin").agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.min("v").alias("low"), F.max("v").alias("high"))
    found: dict[int, float] = {}
    start = 0
    for part in sorted(sizes.collect(), key=lambda r: r["_bin"]):  # at most BINS rows
        inside = [r - start for r in ranks if start <= r < start + part["n"]]
        if inside:
            rows = dealt.filter(F.col("_bin") == part["_bin"]).select("v", "n")
            deeper = _weighted_select(rows, inside, part["rows"], part["low"], part["high"])
            found.update({r + start: x for r, x in deeper.items()})
        start += part["n"]
    return found


def _weighted(df: DataFrame, column, weight: str) -> tuple[DataFrame, tuple]:
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    values = df.select(value.alias("v"), F.col(weight).alias("n")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return values, tuple(values.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.min("v"), F.max("v")).first())


def weighted_order_statistics(df: DataFrame, column, weight: str, ranks: list[int]) -> list[float]:
    """Values at the given 0-based ranks where a row stands for as many equal values as the whole number `weight` says.

    Reads `df` three times as a rule.
    """
    values, (total, count, low, high) = _weighted(df, column, weight)
    if ranks and (max(ranks) >= total or min(ranks) < 0):
        raise ValueError("rank outside the data")
    found = _weighted_select(values, sorted(set(ranks)), count, low, high)
    return [found[r] for r in ranks]


def weighted_quantiles(df: DataFrame, column, weight: str, probabilities: list[float]) -> list[float | None]:
    """Linearly interpolated quantiles of the same values; None for an empty column."""
    values, (total, count, low, high) = _weighted(df, column, weight)
    if not total:
        return [None] * len(probabilities)
    places = [(total - 1) * p for p in probabilities]
    ranks = sorted({r for place in places for r in (math.floor(place), math.ceil(place))})
    found = _weighted_select(values, ranks, count, low, high)
    return [found[math.floor(p)] + (found[math.ceil(p)] - found[math.floor(p)]) * (p - math.floor(p)) for p in places]
