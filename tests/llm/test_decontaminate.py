import random

import pytest
from pyspark.sql import functions as F

from cases import documents
from ledgerpulse.llm import decontaminate
from ledgerpulse.llm.common import plain_words
from ledgerpulse.llm.decontaminate import SuffixAutomaton, contaminated, cut_spans, hit_words, match_benchmark


def brute_force(words, items, window):
    hit, named = set(), set()
    for name, item in items:
        width = min(window, len(item))
        runs = {tuple(item[i:i + width]) for i in range(len(item) - width + 1)} if item else set()
        for i in range(len(words) - width + 1):
            if width and tuple(words[i:i + width]) in runs:
                hit |= set(range(i, i + width))
                named.add(name)
    return hit, named


@pytest.mark.parametrize("seed", range(30))
def test_automaton_against_brute_force(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice([b"a", b"b", b"c"])
    items = [(str(k), [word() for _ in range(draw.randint(0, 9))]) for k in range(5)]
    automaton = SuffixAutomaton(items, 4)
    for _ in range(20):
        words = [draw.choice([b"a", b"b", b"c", b"z"]) for _ in range(draw.randint(0, 40))]
        spans, named = automaton.matches(words)
        assert ({i for a, b in spans for i in range(a, b + 1)}, named) == brute_force(words, items, 4)


def _benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


ITEMS = [(1, "The CAT sat, on the mat"), (1, "The CAT sat, on the mat"), (2, None), (3, ""), (None, "der hund"), (4, "über ñandú")]


def test_cases(spark):
    rows = match_benchmark(documents(spark), _benchmark(spark, ITEMS), clean=True)
    assert rows.filter("doc_id = 4").first()["kept"] == "clash"  # other columns are handed on
    got = {(r["doc_id"]): r for r in rows.select("doc_id", hit_words().alias("hits"), "found", contaminated().alias("bad")).collect()}
    assert (got[0]["found"]["n_words"], got[0]["hits"], got[0]["bad"]) == (0, 0, False)
    assert got[7]["hits"] == 6 and got[7]["bad"] and got[7]["found"]["cleaned"] == " today"
    assert got[9]["found"]["items"] == ["4"] and got[3]["hits"] == 0 and not got[None]["bad"]


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    one = match_benchmark(documents(spark), _benchmark(spark, ITEMS), clean=True)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 3)
    many = match_benchmark(documents(spark), _benchmark(spark, ITEMS), clean=True)
    assert many.columns == one.columns
    key = lambda df: sorted(map(str, df.select("doc_id", "found").collect()))
    assert key(one) == key(many)


def test_empty_tables(spark):
    assert match_benchmark(documents(spark, []), _benchmark(spark, ITEMS)).count() == 0
    assert match_benchmark(documents(spark), _benchmark(spark, [])).filter(F.size("found.hits") > 0).count() == 0


def test_cut_spans_keeps_the_rest():
    text = "Eins, ZWEI drei -- vier."
    assert plain_words(text) == [b"eins", b"zwei", b"drei", b"vier"]
    assert cut_spans(text, [[1, 2]]) == "Eins,  -- vier."
    assert cut_spans(text, [[0, 3]]) == "."
