import numpy as np
import pytest

from cases import tables
from ledgerpulse.llm import ball_search
from ledgerpulse.llm.ball_search import BallTree, build_index, integer_vectors, op11_ball_tree_search, top_products

SCHEMA = "vec_id long, embedding array<float>, score string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], SCHEMA)


def brute(rows, chosen, k):
    """query_id -> ranking, every pair of rows compared."""
    whole = [(i, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, v in rows
             if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (qi, q) in enumerate(whole):
        if qi is not None and chosen(qi):
            found = [(-sum(x * y for x, y in zip(q, v)), i is None, i or 0) for b, (i, v) in enumerate(whole) if a != b and len(v) == len(q)]
            out += [(qi, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("n,dims,leaf,big", [(0, 3, 4, 1), (1, 3, 4, 1), (700, 5, 8, 1), (700, 2, 300, 1), (300, 4, 8, 1 << 27)])
def test_tree_finds_the_best_points(n, dims, leaf, big):
    draw = np.random.default_rng(n + dims)
    points = np.vstack([draw.integers(-9, 9, (n, dims)), np.zeros((0, dims), int)]) * big
    queries = draw.integers(-9, 9, (40, dims)) * big
    tree = BallTree.build(points, leaf)
    assert sorted(tree.order) == list(range(n))
    asked, point, score = tree.search(queries, np.full(40, -np.inf), tree.order, 4)
    for i, q in enumerate(queries):
        best = sorted((-int(sum(int(x) * int(y) for x, y in zip(q, p))), j) for j, p in enumerate(points))[:4]
        mine = sorted((-int(s), int(tree.order[p])) for a, p, s in zip(asked, point, score) if a == i)
        assert mine == best


def test_a_query_leaves_balls_out():
    points = np.vstack([np.full((500, 3), 100) + np.arange(500)[:, None] % 7, np.full((500, 3), -100) - np.arange(500)[:, None] % 7])
    tree = BallTree.build(points, 16)
    far = tree.points[:, 0] < 0
    tree.points[far] = 10_000  # would win, were its ball looked into
    _, point, score = tree.search(np.array([[1, 1, 1]]), np.array([-np.inf]), tree.order, 3)
    assert score.tolist() == [318, 318, 318] and not far[point].any()


def test_equal_to_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ball_search, "SHARD_POINTS", 40)
    monkeypatch.setattr(ball_search, "LEAF_POINTS", 4)
    monkeypatch.setattr(ball_search, "TASK_QUERIES", 7)
    monkeypatch.setattr(ball_search, "BOUND_SHARDS", 3)
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(60, 4)).astype(np.float32)
    rows = [(i, vectors[i % 60 if i % 3 else 0].tolist()) for i in range(300)]  # a third are copies of one vector
    rows += [(50, [0.5, 0.5, 0.1, 0.0]), (50, [0.5, 0.5, 0.1, 0.0]), (None, vectors[0].tolist()), (None, vectors[1].tolist()),
             (7, None), (8, [None, 1.0, 2.0, 3.0]), (9, [float("nan"), 1.0, 2.0, 3.0]), (10, [float("inf"), 0.0, 0.0, 0.0]),
             (100, [0.1, 0.2]), (101, [0.3, 0.4]), (150, []), (151, []), (200, [1e20, 0.0, 0.0, 0.0])]
    held = ball_search.stored(integer_vectors(frame(spark, rows)), "vectors")
    found = top_products(held.filter("vec_id % 25 = 0"), build_index(held))
    mine = sorted([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()], key=str)
    assert mine == brute([r for r in rows if r[1] is None or 1e20 not in r[1]], lambda i: i % 25 == 0, 5)


def test_fewer_rows_than_places_and_empty_table(spark, tmp_path):
    few = tables(tmp_path / "few", embeddings=frame(spark, [(0, [1.0, 0.0]), (50, [0.5, 0.25])]))
    assert sorted(map(tuple, op11_ball_tree_search(spark, few).collect())) == [(0, 1, 50, 32768), (50, 1, 0, 32768)]
    none = tables(tmp_path / "none", embeddings=frame(spark, [(1, [1.0])]).limit(0))
    assert op11_ball_tree_search(spark, none).collect() == []
    assert op11_ball_tree_search(spark, none).columns == ["query_id", "rank", "vec_id", "score"]
