"""Exact nearest neighbours in few dimensions by a partition tree.

Equal points are merged first, so copies cost one row. A level of the tree cuts every cell that is not yet small, at
quantiles of the axis that tells its points apart best; the quantiles of all cells of a level come from one aggregation of
mergeable sketches. Cells, their boxes and their cuts are rows of tables, so a tree may have any number of them.

A query first meets the points of its own cell. The distance of the last of its k candidates is the radius of a ball, which
goes down the tree from the root to the other small cells whose boxes it touches. In a cell, points meet
queries in blocks; a cell that very many queries ask for is dealt to several tasks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.operators.ranking import top_n_per_key
from ledgerpulse.session import cut_lineage

#: Points of a small cell, cells that one cell is cut into at most, queries that meet a cell in one task.
CELL_POINTS, FAN_OUT, BLOCK_QUERIES = 1_000, 64, 2_000
#: Pairs of a query and a point that a task works on, on average, and at a time.
TASK_PAIRS, STEP_PAIRS = 20_000_000, 1_000_000
_ROOT = "r"


def distinct_points(df: DataFrame, features: list[str]) -> DataFrame:
    """Each point once, with its number of copies `w`."""
    values = [F.col(c).cast("double").alias(c) for c in features]
    return df.select(*values).groupBy(*features).agg(F.count("*").alias("w"))


class PartitionTree:
    """Small cells of the distinct points `reference` (features and `w`).

    `levels` has a table per level of the tree: parent, cell, box (least, most), n, and for cells that were cut
    the axis and the cuts. `placed` holds the points with their small cells.
    """

    def __init__(self, reference: DataFrame, features: list[str]) -> None:
        self.features = list(features)
        self.levels: list[DataFrame] = []
        parts: list[DataFrame] = []
        rows = reference.select(*features, "w", F.lit("").alias("parent"), F.lit(_ROOT).alias("cell"))
        while True:
            rows = cut_lineage(rows)
            level = cut_lineage(self._describe(rows))
            self.levels.append(level)
            cut = level.filter("cuts is not null")
            if cut.isEmpty():
                parts.append(rows)
                break
            if len(self.levels) > 1:
                parts.append(rows.join(cut.select("cell"), "cell", "left_anti"))
            rows = self._below(rows.drop("parent"), cut)
        self.placed = parts[0].select(*features, "w", "cell")
        for part in parts[1:]:
            self.placed = self.placed.unionByName(part.select(*features, "w", "cell"))

    def _describe(self, rows: DataFrame) -> DataFrame:
        """Box, size and, unless it is small, axis and cuts of each cell."""
        shares = [i / FAN_OUT for i in range(1, FAN_OUT)]
        stats = rows.groupBy("parent", "cell").agg(
            F.count("*").alias("n"), F.array(*[F.min(c) for c in self.features]).alias("least"), F.array(*[F.max(c) for c in self.features]).alias("most"),
            *[F.percentile_approx(c, shares, 20 * FAN_OUT).alias(f"_q{i}") for i, c in enumerate(self.features)])

        def option(i: int) -> Column:
            # a cut separates values up to it from greater ones; the least value is one if the quantiles give none
            cuts = F.array_distinct(F.filter(F.array_append(f"_q{i}", F.col("least")[i]), lambda q: q < F.col("most")[i]))
            # no more of them than small cells need
            step = F.greatest(F.lit(1), F.floor(F.size(cuts) * CELL_POINTS / (2 * F.col("n"))))
            few = F.filter(cuts, lambda _, place: place % step == step - 1)
            return F.struct(F.size(cuts).alias("size"), F.lit(-i).alias("before"), F.lit(i).alias("axis"), few.alias("cuts"))

        best = F.array_max(F.array(*[option(i) for i in range(len(self.features))]))
        large = (F.col("n") > CELL_POINTS) & (best["size"] > 0)
        return stats.select("parent", "cell", "n", "least", "most", F.when(large, best["axis"]).alias("axis"), F.when(large, best["cuts"]).alias("cuts"))

    def _below(self, rows: DataFrame, cut: DataFrame) -> DataFrame:
        """The rows in cells that were cut, one level lower."""
        value = F.element_at(F.array(*[F.col(c) for c in self.features]), F.col("axis") + 1)
        child = F.concat_ws(".", "cell", F.size(F.filter("cuts", lambda c: c < value)))
        joined = rows.join(cut.select("cell", "axis", "cuts"), "cell")
        return joined.withColumns({"parent": F.col("cell"), "cell": child}).drop("axis", "cuts")

    def _home(self, queries: DataFrame) -> DataFrame:
        """Adds the small cell a point lies in."""
        rows = queries.withColumn("cell", F.lit(_ROOT))
        value = F.element_at(F.array(*[F.col(c) for c in self.features]), F.col("axis") + 1)
        child = F.when(F.col("cuts").isNull(), F.col("cell")).otherwise(F.concat_ws(".", "cell", F.size(F.filter("cuts", lambda c: c < value))))
        for level in self.levels[:-1]:
            cut = level.filter("cuts is not null").select("cell", "axis", "cuts")
            rows = rows.join(cut, "cell", "left").withColumn("cell", child).drop("axis", "cuts")
        return rows

    def _touched(self, queries: DataFrame) -> DataFrame:
        """(features, radius, cell): small cells other than `home` that the ball of a query touches."""
        point = [F.col(c) for c in self.features]
        gaps = [F.greatest(F.col("least")[i] - x, x - F.col("most")[i], F.lit(0.0)) for i, x in enumerate(point)]
        apart = F.sqrt(sum([g * g for g in gaps[1:]], gaps[0] * gaps[0]))
        rows, found = queries.withColumn("at", F.lit("")), None
        for level in self.levels:
            met = (rows.join(level.select(F.col("parent").alias("at"), "cell", "least", "most", F.col("cuts").isNotNull().alias("inner")), "at")
                   .filter(F.col("radius").isNull() | (apart <= F.col("radius") + 1e-6)))
            small = met.filter(~F.col("inner") & (F.col("cell") != F.col("home"))).select(*self.features, "radius", "cell")
            found = small if found is None else found.unionByName(small)
            rows = met.filter("inner").select(*self.features, "home", "radius", F.col("cell").alias("at"))
        return found

    def nearest(self, queries: DataFrame, k: int) -> DataFrame:
        """The k nearest distinct points of every distinct query point (features).

        Result: the query's features, `n_<feature>`, `w`, `dist` and `rank` from 1. Ties in distance (to 12 decimals of its
        square) go by coordinates.
        """
        asked, total, load = self._loaded(self._home(queries.select(*self.features)))
        return self._with_others(self._search(asked, total, self._copies(load), k), k)

    def nearest_of_own(self, k: int) -> DataFrame:
        """The same for the points of the tree themselves; each is its own first neighbour. No cell asks for more than its points."""
        asked = self.placed.select(*self.features, "cell", F.lit(0).alias("part"))
        return self._with_others(self._search(asked, self.placed.count(), self.placed.withColumn("part", F.lit(0)), k), k)

    def _with_others(self, first: DataFrame, k: int) -> DataFrame:
        """The candidates of the queries' own cells, and those of the other cells their balls touch."""
        first = cut_lineage(first)
        # radius of the k-th candidate; null if the cell holds fewer than k points
        worst = first.groupBy(*self.features, F.col("cell").alias("home")).agg(F.when(F.count("*") >= k, F.max("dist")).alias("radius"))
        asked, total, load = self._loaded(self._touched(worst))
        both = first.unionByName(self._search(asked, total, self._copies(load), k)).drop("cell")
        return top_n_per_key(both, self.features, [F.asc("d2"), *[F.asc(f"n_{c}") for c in self.features]], k).drop("d2")

    def _loaded(self, queries: DataFrame) -> tuple[DataFrame, int, DataFrame]:
        """Queries dealt to parts of `BLOCK_QUERIES` on average, their number, and the number of parts by cell."""
        queries = cut_lineage(queries)
        load = cut_lineage(queries.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("parts"), F.count("*").alias("asked")))
        dealt = queries.join(load.select("cell", "parts"), "cell").withColumn("part", F.pmod(F.xxhash64(*self.features), F.col("parts")).cast("int"))
        return dealt.drop("parts"), load.agg(F.sum("asked")).first()[0] or 0, load

    def _copies(self, load: DataFrame) -> DataFrame:
        """The points of the asked cells, once for every part."""
        return self.placed.join(load, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def _search(self, asked: DataFrame, total: int, held: DataFrame, k: int) -> DataFrame:
        """k nearest points, no farther than the radius, within the cell and part of each of the `total` query rows."""
        features, neighbour = self.features, [f"n_{c}" for c in self.features]
        # few bytes but much arithmetic: the number of tasks follows the work
        tasks = max(1, math.ceil(total * CELL_POINTS / TASK_PAIRS), min(total // 100, self._parallelism()))
        radius = F.col("radius") if "radius" in asked.columns else F.lit(None).cast("double").alias("radius")
        asked = asked.select(*features, radius, "cell", "part")
        held = held.select(*[F.col(c).alias(f"n_{c}") for c in features], "w", F.concat("cell").alias("cell"), (F.col("part") + 0).alias("part"))
        fields = ", ".join([f"{c} double" for c in features + neighbour])
        columns = [*features, *neighbour, "cell", "w", "d2", "dist"]

        def search(key: tuple, q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
            if not len(q) or not len(r):
                return pd.DataFrame(columns=columns)
            points, weight = r[neighbour].to_numpy(dtype=float), r["w"].to_numpy()
            order = np.lexsort(points.T[::-1])  # column order is coordinate order
            points, weight = points[order], weight[order]
            whole, reach = q[features].to_numpy(dtype=float), q["radius"].fillna(np.inf).to_numpy(dtype=float)
            step, found = max(1, STEP_PAIRS // len(points)), []
            for start in range(0, len(whole), step):
                block, limit = whole[start:start + step], (reach[start:start + step, None] + 1e-6) ** 2
                d2 = np.zeros((len(block), len(points)))
                for axis in range(len(features)):
                    d2 += (block[:, axis, None] - points[None, :, axis]) ** 2
                if len(points) > k:
                    limit = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1:k] + 1e-12)
                row, col = np.nonzero(d2 <= limit)
                apart = d2[row, col]
                near = np.round(apart, 12)
                rank = np.lexsort((col, near, row))
                row, col, near, apart = row[rank], col[rank], near[rank], apart[rank]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, col = row[keep], col[keep]
                found.append(np.column_stack([block[row], points[col], weight[col], near[keep], np.sqrt(apart[keep])]))
            out = pd.DataFrame(np.vstack(found), columns=[*features, *neighbour, "w", "d2", "dist"])
            return out.assign(cell=key[0], w=out["w"].astype("int64"))[columns]

        asked, held = (side.repartition(tasks, "cell", "part") for side in (asked, held))
        return (asked.groupBy("cell", "part").cogroup(held.groupBy("cell", "part"))
                .applyInPandas(search, f"{fields}, cell string, w long, d2 double, dist double"))

    def _parallelism(self) -> int:
        return self.placed.sparkSession.sparkContext.defaultParallelism


def nearest(queries: DataFrame, reference: DataFrame, features: list[str], k: int) -> DataFrame:
    """`PartitionTree.nearest` on a tree of its own."""
    return PartitionTree(reference, features).nearest(queries, k)
