"""Exact search for the largest inner products by ball trees over shards.

Equal vectors are merged first, so a vector that very many rows share is one point with the few rows that
can win a tie. Points are dealt to cells by the signs of random projections, large cells to several shards. Every
shard becomes one row of an index: a ball tree whose leaves hold its points. A ball with centre c and radius r holds
no inner product with q above q.c + |q| r.

A query first descends into the shard with the highest bound. The score of its last place then goes with
it to the other shards, and only to those whose bound reaches it. Inside a shard queries descend together, each
into the child with the higher bound first, and leave out balls that cannot reach their current last place.

Components are floor(256 x), so scores are integers: products of doubles while these are exact, of 64-bit integers otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import stored, table
from ledgerpulse.operators.ranking import top_n_per_key

UNIT = 256
K = 5
#: Points of a shard, of a leaf; queries of a task; shards whose bounds a task computes at a time.
SHARD_POINTS, LEAF_POINTS, TASK_QUERIES, BOUND_SHARDS = 8192, 128, 4096, 1024
_LAST = np.iinfo(np.int64).max  # place of a null id among ties
_FOUND = "q long, score long, vec_id long, row long"
_NODE = np.dtype([("low", "<i4"), ("high", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8")])


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, vec) of `vectors` (vec_id, embedding): floor(256 x) as packed 32-bit integers.

    A null vector and one with a null or non-finite component are left out, and so is one
    longer than 2^31, whose scores would not fit 64 bits.
    """
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(UNIT * lists.flatten().cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False))
                packed = []
                for valid, a, b in zip(lists.is_valid().to_pylist(), ends - sizes, ends):
                    part = x[a:b]
                    packed.append(part.astype("<i4").tobytes() if valid and part @ part < 2.0 ** 62 else None)  # false for nan
            keep = pa.array([p is not None for p in packed])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], schema=schema).filter(keep)

    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), "embedding")
    return rows.mapInArrow(run, "row long, vec_id long, vec binary")


def _unpack(packed, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i4").reshape(len(packed), dims)


def _by_length(packed: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(components, places) of the vectors of each length."""
    sizes = np.array([len(p) // 4 for p in packed], np.int64)
    for dims in np.unique(sizes):
        yield int(dims), np.flatnonzero(sizes == dims)


# ---- the tree of a shard ----------------------------------------------------

class BallTree:
    """Points in the order of the leaves, and nodes (first and last place, children, radius) with their centres."""

    def __init__(self, points: np.ndarray, order: np.ndarray, nodes: np.ndarray, centres: np.ndarray) -> None:
        self.points, self.order, self.nodes, self.centres = points, order, nodes, centres

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF_POINTS) -> "BallTree":
        """Halves a ball at the middle between two points far from each other, until `leaf` points are left."""
        x, order = points.astype(np.float64), np.arange(len(points))
        nodes, centres, todo = [], [], [(0, len(points), -1)]
        while todo:
            low, high, parent = todo.pop()
            at = len(nodes)
            if parent >= 0:
                nodes[parent][2 if nodes[parent][2] < 0 else 3] = at
            own = x[order[low:high]]
            centre = own.mean(axis=0) if len(own) else np.zeros(x.shape[1])
            apart = own - centre
            nodes.append([low, high, -1, -1, math.sqrt(float((apart * apart).sum(axis=1).max())) if len(own) else 0.0])
            centres.append(centre)
            if high - low <= leaf:
                continue
            one = own[np.argmax((apart * apart).sum(axis=1))]
            other = own[np.argmax(((own - one) ** 2).sum(axis=1))]
            order[low:high] = order[low:high][np.argsort(own @ (other - one), kind="stable")]
            todo += [(low, (low + high) // 2, at), ((low + high) // 2, high, at)]
        return cls(points[order], order, np.array([tuple(n) for n in nodes], _NODE), np.array(centres).reshape(len(nodes), x.shape[1]))

    def search(self, queries: np.ndarray, floor: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, point, score) of the k best points of each query; equal scores go by `places` of the points.

        Points below `floor` of a query may be left out.
        """
        longest = [math.sqrt(float((m.astype(np.float64) ** 2).sum(axis=1).max())) if len(m) else 0.0 for m in (queries, self.points)]
        exact = np.float64 if longest[0] * longest[1] < 2.0 ** 53 else np.int64
        q, points, real = queries.astype(exact), self.points.astype(exact), queries.astype(np.float64)
        length = np.sqrt((real * real).sum(axis=1))
        last = floor.astype(np.float64)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, exact))

        def bound(node: int, who: np.ndarray) -> np.ndarray:
            # a little more than the bound, for what doubles round
            far = real[who] @ self.centres[node] + length[who] * self.nodes["radius"][node]
            return far + 1e-9 * length[who] * longest[1] + 1e-3

        def scan(node: int, who: np.ndarray) -> None:
            nonlocal held
            low, high = self.nodes["low"][node], self.nodes["high"][node]
            scores = q[who] @ points[low:high].T
            least = last[who]
            if high - low >= k:
                least = np.maximum(least, np.partition(scores, high - low - k, axis=1)[:, high - low - k])
            row, col = np.nonzero(scores >= least[:, None])
            if not len(row):
                return
            touched = np.isin(held[0], who[row])
            asked = np.concatenate([held[0][touched], who[row]])
            point = np.concatenate([held[1][touched], col + low])
            score = np.concatenate([held[2][touched], scores[row, col]])
            rank = np.lexsort((places[point], -score, asked))
            asked, point, score = asked[rank], point[rank], score[rank]
            first = np.searchsorted(asked, asked)
            nth = np.arange(len(asked)) - first
            keep = nth < k
            kth = nth == k - 1
            last[asked[kth]] = np.maximum(last[asked[kth]], score[kth].astype(np.float64))
            held = tuple(np.concatenate([h[~touched], new[keep]]) for h, new in zip(held, (asked, point, score)))

        def visit(node: int, who: np.ndarray) -> None:
            left, right = self.nodes["left"][node], self.nodes["right"][node]
            if left < 0:
                scan(node, who)
                return
            of_left, of_right = bound(left, who), bound(right, who)
            nearer = of_left >= of_right
            for first, second, chosen, before, after in ((left, right, nearer, of_left, of_right), (right, left, ~nearer, of_right, of_left)):
                for child, reach in ((first, before), (second, after)):
                    going = chosen & (reach >= last[who])
                    if going.any():
                        visit(child, who[going])

        everyone = np.arange(len(queries))
        if len(self.points) and len(everyone):
            going = bound(0, everyone) >= last
            if going.any():
                visit(0, everyone[going])
        return held


# ---- the index ----------------------------------------------------------------

_INDEX = ("shard string, dims int, centre binary, radius double, longest double, points binary, nodes binary, centres binary, "
          "places binary, members array<struct<vec_id: long, row: long>>, counts binary")


def _cells(points: DataFrame, bits: int) -> DataFrame:
    """Adds the cell of a point: its length and the signs of `bits` random projections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("vec").to_pylist()
            cells = np.empty(len(packed), object)
            for dims, at in _by_length(packed):
                planes = np.random.default_rng(dims).normal(size=(dims, bits))
                signs = _unpack([packed[i] for i in at], dims).astype(np.float64) @ planes > 0
                for i, row in zip(at, signs):
                    cells[i] = f"{dims}-" + "".join("1" if s else "0" for s in row)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.tolist(), pa.string())], names=[*batch.schema.names, "cell"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema)
    return points.mapInArrow(run, f"{kinds}, cell string")


def build_index(vectors: DataFrame, k: int = K) -> DataFrame:
    """One row per shard with its ball tree, from `integer_vectors`, stored; good for searches of up to `k` places.

    Every point keeps the k + 1 rows with the smallest ids: only these can stand among the k best of any row.
    """
    place = F.struct(F.coalesce("vec_id", F.lit(int(_LAST))).alias("place"), F.col("row"))
    chosen = top_n_per_key(vectors, "vec", [F.asc(place)], k + 1)
    points = stored(chosen.groupBy("vec").agg(F.array_sort(F.collect_list(F.struct(
        F.coalesce("vec_id", F.lit(int(_LAST))).alias("place"), "row", "vec_id"))).alias("rows")), "ball-points")
    bits = max(0, math.ceil(math.log2(max(1, points.count()) / SHARD_POINTS)))
    placed = stored(_cells(points, bits), "ball-cells")
    shards = placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_POINTS).alias("parts"))
    dealt = placed.join(shards, "cell").select("vec", "rows", F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec"), F.col("parts"))).alias("shard"))

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec", kind="stable")
        packed, rows = part["vec"].tolist(), part["rows"].tolist()
        dims = len(packed[0]) // 4
        tree = BallTree.build(_unpack(packed, dims))
        rows = [rows[i] for i in tree.order]
        # the order among equal scores as one number per point: by first id, then by row
        first = sorted(range(len(rows)), key=lambda i: (rows[i][0]["place"], rows[i][0]["row"]))
        places = np.empty(len(rows), "<i8")
        places[first] = np.arange(len(rows))
        longest = math.sqrt(float((tree.points.astype(np.float64) ** 2).sum(axis=1).max()))
        return pd.DataFrame([{
            "shard": part["shard"].iloc[0], "dims": dims, "centre": tree.centres[0].tobytes(), "radius": float(tree.nodes["radius"][0]),
            "longest": longest, "points": tree.points.astype("<i4").tobytes(), "nodes": tree.nodes.tobytes(), "centres": tree.centres.tobytes(),
            "places": places.tobytes(), "members": [{"vec_id": m["vec_id"], "row": m["row"]} for r in rows for m in r],
            "counts": np.array([len(r) for r in rows], "<i4").tobytes()}])

    return stored(dealt.groupBy("shard").applyInPandas(grow, _INDEX), "ball-index")


# ---- the search -----------------------------------------------------------------

def _bounds(queries: DataFrame, index: DataFrame) -> DataFrame:
    """(q, shard, bound) of every query and shard of its length, in blocks of both."""
    asked = max(1, math.ceil(queries.count() / TASK_QUERIES))
    held = max(1, math.ceil(index.count() / BOUND_SHARDS))
    left = queries.select("q", "vec", F.pmod(F.xxhash64("q"), F.lit(asked)).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(held - 1))).alias("b"))
    right = index.select("shard", "dims", "centre", "radius", "longest", F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("a"),
                         F.pmod(F.xxhash64("shard"), F.lit(held)).alias("b"))

    def reach(some: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"q": np.zeros(0, np.int64), "shard": np.zeros(0, object), "bound": np.zeros(0)})]
        packed = some["vec"].tolist()
        for dims, at in _by_length(packed):
            fit = shards[shards["dims"] == dims]
            if not len(fit):
                continue
            x = _unpack([packed[i] for i in at], dims).astype(np.float64)
            length = np.sqrt((x * x).sum(axis=1))[:, None]
            centres = np.frombuffer(b"".join(fit["centre"]), "<f8").reshape(len(fit), dims)
            far = x @ centres.T + length * fit["radius"].to_numpy() + 1e-9 * length * fit["longest"].to_numpy() + 1e-3
            parts.append(pd.DataFrame({"q": np.repeat(some["q"].to_numpy()[at], len(fit)), "shard": np.tile(fit["shard"].to_numpy(), len(at)), "bound": far.ravel()}))
        return pd.concat(parts)

    return left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(reach, "q long, shard string, bound double")


def _search_shards(visits: DataFrame, queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """The k + 1 best rows of each visit (q, shard, last: the score to reach or null), found in the shard's tree."""
    chunks = max(1, math.ceil(queries.count() / TASK_QUERIES))
    asked = visits.join(queries.select("q", "vec"), "q").withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)))
    wanted = asked.groupBy("shard", (F.col("chunk") + 0).alias("part")).agg(F.count("*").alias("n")).select("shard", F.col("part").alias("chunk"))
    held = index.join(wanted, "shard")

    def search(some: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(shard):
            return pd.DataFrame({"q": [], "score": [], "vec_id": [], "row": []})
        s = shard.iloc[0]
        dims, counts = int(s["dims"]), np.frombuffer(s["counts"], "<i4")
        nodes = np.frombuffer(s["nodes"], _NODE)
        points = np.frombuffer(s["points"], "<i4").reshape(len(counts), dims)
        tree = BallTree(points, np.arange(len(points)), nodes, np.frombuffer(s["centres"], "<f8").reshape(len(nodes), dims))
        asked, point, score = tree.search(_unpack(some["vec"].tolist(), dims), some["last"].fillna(-np.inf).to_numpy(np.float64),
                                          np.frombuffer(s["places"], "<i8"), k + 1)
        begin, ids, members = np.cumsum(counts) - counts, some["q"].to_numpy(), s["members"]
        out = [(int(ids[a]), int(v), members[m]["vec_id"], members[m]["row"])
               for a, p, v in zip(asked, point, score) for m in range(begin[p], begin[p] + counts[p])]
        found = pd.DataFrame(out, columns=["q", "score", "vec_id", "row"])
        return found.astype({"vec_id": "Int64"})

    return asked.groupBy("shard", "chunk").cogroup(held.groupBy("shard", "chunk")).applyInPandas(search, _FOUND)


def top_products(queries: DataFrame, index: DataFrame, k: int = K) -> DataFrame:
    """(query_row, query_id, rank, vec_id, row, score): the k best rows of `index` for each row of `queries`.

    `queries` are rows (row, vec_id, vec) of `integer_vectors`; a row is never its own answer. Highest score first, ties to the
    smaller vec_id, a null one last, then to the smaller row. Vectors are compared with those of their own length.
    """
    order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
    asked = stored(queries.groupBy("vec").agg(F.min("row").alias("q")), "ball-queries")
    bounds = stored(_bounds(asked, index), "ball-bounds")
    nearest = bounds.groupBy("q").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    first = stored(top_n_per_key(_search_shards(nearest.withColumn("last", F.lit(None).cast("double")), asked, index, k), "q", order, k + 1), "ball-first")
    last = first.groupBy("q").agg(F.when(F.count("*") > k, F.min("score").cast("double")).alias("last"))
    others = (bounds.join(nearest, ["q", "shard"], "left_anti").join(last, "q", "left")
              .filter("last is null or bound >= last").select("q", "shard", "last"))
    found = first.drop("rank").unionByName(_search_shards(others, asked, index, k))
    lists = (top_n_per_key(found, "q", order, k + 1).groupBy("q")
             .agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "row", "score"))).alias("found")))
    # one short list per different vector; a vector that very many rows ask for is split by adaptive execution
    answers = asked.join(lists, "q").select("vec", "found")
    own = F.col("query_row")
    return (queries.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "vec").join(answers, "vec")
            .select("query_row", "query_id", F.posexplode(F.slice(F.filter("found", lambda x: x["row"] != own), 1, k)).alias("place", "hit"))
            .select("query_row", "query_id", (F.col("place") + 1).alias("rank"), "hit.vec_id", "hit.row", "hit.score"))


def op11_ball_tree_search(spark, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every row whose vec_id is divisible by 50 with all other rows."""
    vectors = stored(integer_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")), "ball-vectors")
    found = top_products(vectors.filter("vec_id % 50 = 0"), build_index(vectors))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
