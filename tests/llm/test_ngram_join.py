import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents
from ledgerpulse.llm import ngram_join
from ledgerpulse.llm.common import blank_words, components, likely_in
from ledgerpulse.llm.ngram_join import GlobalOrder, needed, shingles, similarity_components, sketch_of


def brute_force(rows, percent=80):
    sets = []
    for _, text, _ in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if rows[i][0] is not None and rows[j][0] is not None and a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(group) if doc is not None else None))
    return sorted(map(str, out))


def _result(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def test_cases(spark):
    assert _result(similarity_components(documents(spark))) == brute_force(ROWS)


def test_empty_table(spark):
    assert similarity_components(documents(spark, [])).count() == 0


def near_copies(seed, groups=6, members=12):
    draw = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{draw.randint(0, 300)}" for _ in range(draw.randint(20, 150))]
        for _ in range(members):
            words = list(base)
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                words[draw.randrange(len(words))] = f"e{draw.randint(0, 9999)}"
            if draw.random() < 0.3:
                words = words[draw.randint(0, 5):]
            rows.append((None, " ".join(words), "en"))
    draw.shuffle(rows)
    common = "these very many words stand at the end of each and every text here"
    return [(3 * i, f"{t} {common}", lang) for i, (_, t, lang) in enumerate(rows)]


@pytest.mark.parametrize("seed,leaders", [(1, 8), (2, 1)])
def test_near_copies_against_brute_force(spark, seed, leaders, monkeypatch):
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    monkeypatch.setattr(ngram_join, "ROUNDS", 1)
    rows = near_copies(seed)
    expected = brute_force(rows)
    assert len({e.rsplit(",", 1)[1] for e in expected}) < len(rows)
    assert _result(similarity_components(documents(spark, rows))) == expected


def test_chains_are_followed(spark):
    words = [f"w{i}" for i in range(120)]
    rows = [(k, " ".join(words[4 * k:4 * k + 60]), "en") for k in range(12)]
    assert _result(similarity_components(documents(spark, rows))) == brute_force(rows)


def test_sketch_never_exceeds_the_difference():
    draw = np.random.default_rng(4)
    for _ in range(50):
        a = np.unique(draw.integers(0, 2 ** 63, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[:draw.integers(0, 300)], draw.integers(0, 2 ** 63, 40).astype(np.uint64)]))
        apart = sum(int(x).bit_count() for x in (sketch_of(a) ^ sketch_of(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_order_is_cut_into_even_fragments():
    counts = np.random.default_rng(2).integers(0, 50, 1 << 10)
    order = GlobalOrder(counts, 4)
    grams = np.arange(1 << 10, dtype=np.uint64)
    found, fragment = order.sort(grams)
    assert (np.diff(counts[found.astype(int)]) >= 0).all() and (np.diff(fragment) >= 0).all()
    weight = np.bincount(fragment, weights=counts[found.astype(int)])
    assert len(weight) == 4 and weight.max() < 1.2 * weight.min()


def test_shingles():
    assert len(shingles("a b c")) == 1 and len(shingles("a b c d e f")) == 2 and len(shingles(" \n")) == 0
    assert (shingles("A b") == shingles("a  B\n")).all() and shingles("a b")[0] != shingles("b a")[0]
    assert blank_words("X y Z") == ["x y".encode(), b"z"]
    assert [needed(n) for n in (1, 4, 5, 6)] == [1, 4, 4, 5]


def test_components(spark):
    draw = random.Random(7)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(500, 500 + i) for i in range(1, 50)] + [(i, i + 1) for i in range(900, 940)]
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {v for a, b in edges if a != b for v in (a, b)}
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {v: find(v) for v in linked}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_filter_of_ids_lets_all_through(spark):
    ids = spark.range(0, 2000, 7).select(F.col("id").alias("k"))
    test = likely_in(ids, "k")
    kept = {r[0] for r in spark.range(2000).filter(test(F.col("id"))).collect()}
    assert {*range(0, 2000, 7)} <= kept and len(kept) < 600


def test_rows_that_share_a_doc_id_are_told_apart(spark):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words[:39]), "quite another text of some words", "", "quite another text of some words here"]
    rows = [(5, texts[0], "en"), (5, texts[2], "en"), (5, texts[2], "en"), (2, texts[1], "en"), (9, texts[4], "en"), (9, texts[4], "en"), (9, texts[3], "en"), (7, texts[0], "en")]
    assert _result(similarity_components(documents(spark, rows))) == brute_force(rows)


def test_packed_grams():
    grams = np.random.default_rng(1).integers(0, 2 ** 63, 100).astype(np.uint64)
    assert (ngram_join._unpacked(ngram_join._packed(grams)) == np.sort(grams >> np.uint64(16))).all()
    assert len(ngram_join._unpacked(b"")) == 0


def test_a_common_passage_of_texts_of_many_lengths(spark):
    """The n-grams of the passage are in nearly all prefixes, and only texts of like length are similar."""
    draw = random.Random(11)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(passage + [f"t{draw.randint(0, 10 ** 6)}" for _ in range(i % 40)]), "en") for i in range(60)]
    assert _result(similarity_components(documents(spark, rows))) == brute_force(rows)


@pytest.mark.parametrize("percent", [60, 100])
def test_other_thresholds(spark, percent):
    rows = near_copies(5, groups=3, members=5)
    assert _result(similarity_components(documents(spark, rows), percent=percent)) == brute_force(rows, percent)


def test_the_filter_of_grams_lets_all_through(spark):
    grams = shingles(" ".join(f"w{i}" for i in range(3000))).view(np.int64)
    wanted = spark.createDataFrame([(int(g),) for g in grams[::9]], "gram long")
    kept = ngram_join.GramFilter(wanted, "gram").holds_grams(grams)
    assert kept[::9].all() and kept.mean() < 0.3


def test_long_texts_with_wide_sketches(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "WIDE_FROM", 1300)
    draw = random.Random(3)
    rows = []
    for k in range(4):
        base = [f"w{draw.randint(0, 5000)}" for _ in range(1200 + 100 * k)]
        for m in range(4):
            words = list(base)
            for _ in range(12 * m):
                words[draw.randrange(len(words))] = f"e{draw.randint(0, 9999)}"
            rows.append((len(rows), " ".join(words + ["a", "shared", "end", "of", "every", "text"]), "en"))
    expected = brute_force(rows)
    assert _result(similarity_components(documents(spark, rows))) == expected
