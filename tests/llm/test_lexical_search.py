import math
import random
import re

import numpy as np
import pytest

from cases import ROWS, documents, tables
from ledgerpulse.llm import lexical_search
from ledgerpulse.llm.lexical_search import Block, op13_ranked_lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(items, docs, k=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, ts) for d, ts in held if ts]
    count, length = len(held), sum(len(ts) for _, ts in held)
    out = []
    for item, text in items:
        scores = []
        for d, ts in held:
            m = 10 + 90 * len(ts) * count // length
            score = 0
            for t in set(terms(text)):
                df = sum(t in set(other) for _, other in held) if t in ts else 0
                if df:
                    score += math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) * (1_000_000_000 * ts.count(t) // (1000 * ts.count(t) + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def write(spark, folder, items, docs):
    asked = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, score string")
    return tables(folder, benchmark=asked, documents=documents(spark, [(d, t, "en") for d, t in docs]))


@pytest.mark.parametrize("bits", [1 << 26, 64])
def test_equal_to_brute_force(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical_search, "TASK_ITEMS", 2)
    monkeypatch.setattr(lexical_search, "KEPT_TERMS", 20)
    monkeypatch.setattr(lexical_search, "FILTER_BITS", bits)  # few bits let other terms through: the join is exact
    draw = random.Random(4)
    some = [f"W{i}é" for i in range(40)]
    docs = [(i, " the ".join(draw.choices(some, weights=range(1, 41), k=draw.randint(1, 40)))) for i in range(80)]
    docs += [(i, "Same words in every copy, w1é w2é") for i in range(90, 120)] + [(d, t) for d, t, _ in ROWS if not t or len(t) < 500]
    items = [(1, "w1é w2é THE same"), (2, " ".join(some)), (2, "w3é"), (3, None), (4, ""), (5, "never seen"), (None, "w39é, w40é-w38é"), (6, "cat mat the " * 50)]
    found = op13_ranked_lexical_search(spark, write(spark, tmp_path, items, docs))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(items, docs)


def test_empty_tables(spark, tmp_path):
    for name, items, docs in (("a", [(1, "x")], [(1, None)]), ("b", [(1, None)], [(1, "x")]), ("c", [(1, "y")], [(1, "x")])):
        assert op13_ranked_lexical_search(spark, write(spark, tmp_path / name, items, docs)).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_a_block_with_a_floor_keeps_what_reaches_it(seed):
    draw = np.random.default_rng(seed)
    ts = [draw.choice(60, draw.integers(1, 30), replace=False) for _ in range(200)]
    values = [draw.integers(1, 1000, len(t)) for t in ts]
    squares = np.array([float((v * v).sum()) for v in values])
    block = Block(ts, values, squares, np.arange(200), np.arange(200))
    for _ in range(20):
        wanted = draw.choice(80, 12, replace=False)
        scores = np.array([v[np.isin(t, wanted)].sum() for t, v in zip(ts, values)])
        best = sorted((-s, d) for d, s in enumerate(scores) if s > 0)[:10]
        for last in (0.0, float(-best[-1][0]), float(-best[3][0])):
            docs, found = block.best(wanted, last, 10)
            mine = list(zip((-found).tolist(), docs.tolist()))
            assert mine == best[:len(mine)] and len(mine) >= sum(-s >= last for s, _ in best)
