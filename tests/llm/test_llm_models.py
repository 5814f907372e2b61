import random
from collections import Counter
from itertools import product
from math import log10

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cases import ROWS, documents
from ledgerpulse.llm import hmm, langid, quality
from ledgerpulse.llm.common import held_out
from ledgerpulse.llm.hmm import HiddenMarkovModel, score_documents
from ledgerpulse.llm.langid import LanguageModels, fit_language, letter_words


# ---- language identification ------------------------------------------------

def kneser_ney(counts, order, alphabet):
    """Textbook recursion over dictionaries."""
    tables = {order: {g: n for g, n in counts.items() if len(g) == order}}
    for k in range(order - 1, 0, -1):
        kinds = Counter(g[1:] for g in tables[k + 1])
        kinds.update({g: n for g, n in counts.items() if len(g) == k})
        tables[k] = {g: n for g, n in kinds.items() if g != "\x02"}

    def p(context, char):
        k = len(context) + 1
        t = tables[k]
        ones, twos = sum(n == 1 for n in t.values()), sum(n == 2 for n in t.values())
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        lower = p(context[1:], char) if k > 1 else 1 / (alphabet + 1)
        after = {g: n for g, n in t.items() if g[:-1] == context}
        total = sum(after.values())
        return max(t.get(context + char, 0) - d, 0) / total + d * len(after) / total * lower if total else lower

    return p


def test_probabilities_against_the_textbook():
    words = Counter("der die das und der hund die katze und der wald".split())
    counts = langid._grams(words, 3)
    models = LanguageModels({"de": fit_language(dict(counts), 3)}, 3)
    letters = {c for w in words for c in w} | {"\x03"}
    p = kneser_ney(counts, 3, len(letters))
    for word in ["der", "hut", "x", "katzeund"]:
        marked = "\x02" + word + "\x03"
        expected = sum(np.log2(p(marked[max(0, i - 2):i], marked[i])) for i in range(1, len(marked)))
        assert models._log2([word, "a"])[0, 0] == pytest.approx(expected)


def test_probabilities_sum_to_one():
    counts = langid._grams(Counter("abba baba aab".split()), 3)
    p = kneser_ney(counts, 3, 3)
    assert sum(p("\x02a", c) for c in "ab\x03") + p("\x02a", "?") == pytest.approx(1.0)


LANGS = {"en": "the cat sat on the mat and looked at the dog with great care", "de": "der hund lief durch den tiefen wald und bellte sehr laut",
         "fr": "le chat mange une souris dans la cuisine avec appétit"}


def _corpus(seed, n=40):
    draw = random.Random(seed)
    return [(100 + i, " ".join(draw.choices(LANGS[lang].split(), k=15)), lang) for i, lang in enumerate(draw.choices(list(LANGS), k=n))]


def test_languages_and_cases(spark):
    docs = documents(spark, _corpus(1) + [(1, None, "en"), (2, "", "de"), (3, "123 !?", "en"), (4, "②½ ", None), (5, "zzz qqq", None)]).drop("lang_pred", "score")
    docs = docs.withColumn("train", held_out(3, 1) == F.lit(False))
    models = langid.fit(docs.filter("train"))
    rows = {r["doc_id"]: r for r in langid.identify(docs, models, F.col("train")).collect()}
    assert all(rows[i]["lang_pred"] == lang and rows[i]["score"] > 0.5 for i, _, lang in _corpus(1))
    assert all((rows[i]["lang_pred"], rows[i]["score"], rows[i]["accepted"]) == ("und", 0.0, False) for i in (1, 2, 3, 4))
    assert rows[5]["lang_pred"] in LANGS and not rows[5]["accepted"]


def test_language_models_without_training_rows(spark):
    docs = documents(spark, ROWS).drop("lang_pred", "score")
    models = langid.fit(docs.filter("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, models, F.lit(True)).collect()} == {"und"}
    models = langid.fit(docs)
    assert langid.identify(docs.filter("false"), models, F.lit(True)).count() == 0


def test_fit_counts_all_grams_and_returns_what_it_cuts(spark):
    docs = documents(spark, _corpus(2) + [(1, "a i", "xx")]).drop("lang_pred", "score")
    grams = langid.count_grams(docs)
    counts = {}
    for r in grams.collect():
        counts.setdefault(r["lang"], {})[r["gram"]] = r["n"]
    whole = {(lang, k, g): (a, c) for lang, own in counts.items() for k, f in enumerate(fit_language(own, 4)) for g, a, c in f.itertuples(index=False)}
    got = {(r["lang"], r["k"], r["gram"]): (r["a"], r["gamma"]) for r in langid.fit_grams(grams, 4).collect()}
    assert got.keys() == whole.keys() and all(got[x] == pytest.approx(whole[x]) for x in whole)
    cut = {(r["lang"], r["k"], r["gram"]): (r["a"], r["gamma"]) for r in langid.fit_grams(grams, 4, 5).collect()}
    assert len(cut) < len(whole) and {x[0] for x in cut} == {*LANGS, "xx"}
    assert all(cut[x][0] in (0.0, pytest.approx(whole[x][0])) for x in cut)
    sums = Counter()
    for (lang, k, gram), (a, _) in cut.items():
        if k:
            sums[lang, k - 1, gram[:-1]] += a
    assert all(sums[x] + gamma == pytest.approx(1.0) for x, (_, gamma) in cut.items() if x in sums)


def test_letter_words():
    assert letter_words("Ab1cd ②e_F É") == ["ab", "cd", "e", "f", "é"]


# ---- hidden Markov model ----------------------------------------------------

def _model(states=3, symbols=5, seed=0):
    draw = np.random.default_rng(seed)
    unit = lambda a: a / a.sum(-1, keepdims=True)
    return HiddenMarkovModel(unit(draw.random(states)), unit(draw.random((states, states))), unit(draw.random((states, symbols))).T)


def _paths(model, ids):
    for path in product(range(len(model.start)), repeat=len(ids)):
        p = model.start[path[0]] * model.emit[ids[0], path[0]]
        for a, b, k in zip(path, path[1:], ids[1:]):
            p *= model.move[a, b] * model.emit[k, b]
        yield path, p


@pytest.mark.parametrize("segment", [2, 3, 64])
def test_likelihood_and_expected_counts_against_all_paths(monkeypatch, segment):
    monkeypatch.setattr(hmm, "SEGMENT", segment)
    monkeypatch.setattr(hmm, "BATCH", 2)
    model = _model()
    texts = [np.array(x) for x in ([0], [1, 2], [3, 3, 0, 4, 1], [2, 0, 1, 4, 4, 2])]
    starts, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for ids, found in zip(texts, model.log10(texts)):
        total = sum(p for _, p in _paths(model, ids))
        assert found == pytest.approx(log10(total))
        for path, p in _paths(model, ids):
            starts[path[0]] += p / total
            for a, b in zip(path, path[1:]):
                moves[a, b] += p / total
            for k, s in zip(ids, path):
                emits[k, s] += p / total
    for got, expected in zip(model.expected(texts), (starts, moves, emits)):
        np.testing.assert_allclose(got, expected, atol=1e-9)


def test_long_text_does_not_underflow():
    assert np.isfinite(_model().log10([np.arange(50_000) % 5])).all()


def test_baum_welch_raises_the_likelihood():
    draw = np.random.default_rng(5)
    texts = [np.concatenate([draw.integers(0, 2, 30), draw.integers(2, 5, 30)]) for _ in range(20)]
    model, before = _model(2), -np.inf
    for _ in range(6):
        now = model.log10(texts).sum()
        assert now > before
        before = now
        s, m, e = model.expected(texts)
        model = HiddenMarkovModel(s / s.sum(), m / m.sum(1, keepdims=True), e / e.sum(0))


@pytest.mark.parametrize("vocabulary", [3, 1000])
def test_base_score_and_counts(spark, vocabulary):
    rows = ROWS + _corpus(3)
    docs = documents(spark, rows).drop("score", "row").withColumn("held_out", held_out(7, 2))
    flags = {(r[0], r[1]): r[2] for r in docs.select("doc_id", "text", "held_out").collect()}
    words = lambda t: (t or "").encode().lower().split()
    train = Counter(w for i, t, _ in rows if not flags[i, t] for w in words(t))
    ends = sum(not flags[i, t] for i, t, _ in rows)
    n, v = sum(train.values()) + ends, len(train) + 1
    share = lambda c: log10((c + 1) / (n + v + 1))
    expected = sorted((str(i), flags[i, t], len(words(t)) + 1, sum(train[w] > 0 for w in words(t)) + 1, n,
                       round(sum(share(train[w]) for w in words(t)) + share(ends), 5)) for i, t, _ in rows)
    got = score_documents(docs, vocabulary=vocabulary, rounds=1).collect()
    assert sorted((str(r[0]), *r[1:5], round(r["base_score"], 5)) for r in got) == expected
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_are_probabilities(spark):
    """All texts of one word over the vocabulary, one unseen word and the empty text: shares below one."""
    rows = [(i, t, "en") for i, t in enumerate(["a b a", "b", "a a", "c"])] + [(10, "", "en"), (11, "a", "en"), (12, "b", "en"), (13, "c", "en"), (14, "new", "en")]
    docs = documents(spark, rows).drop("score", "row").withColumn("held_out", F.col("doc_id") >= 10)
    got = {r["doc_id"]: r["score"] for r in score_documents(docs, vocabulary=2, states=2).collect()}
    assert sum(10 ** got[i] for i in range(10, 15)) < 1


def test_without_training_texts(spark):
    docs = documents(spark).drop("score", "row").withColumn("held_out", F.lit(True))
    got = score_documents(docs).collect()
    assert {r["train_tokens"] for r in got} == {0} and {r["n_known"] for r in got} == {0} and {r["base_score"] for r in got} == {0.0}
    assert score_documents(docs.filter("false")).count() == 0


# ---- quality classifier -------------------------------------------------------

def _quality_rows(seed, n=200):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        good = draw.random() < 0.7
        words = draw.choices(LANGS["en"].split(), k=30)
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), int(good)))
    return rows


def test_classifier_separates_held_out_rows(spark):
    rows = _quality_rows(1)
    docs = documents(spark, [(i, t, "en") for i, t, _ in rows] + [(1000, None, "en"), (1001, "", "en"), (None, "x", "en")]).drop("score")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 150] + [(3, None), (None, 1), (5000, 1), (4, 7)], "doc_id long, quality int")
    model = quality.fit(quality.training_rows(docs, labels, "quality"))
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality.quality_score(spark, model).alias("s")).collect()}
    assert all((got[i] >= 0.5) == bool(q) for i, _, q in rows)
    assert got[1000] == got[1001] and all(0 <= s <= 1 for s in got.values())


def test_fit_is_repeatable_and_bounded(spark):
    rows = _quality_rows(2, 60)
    docs = documents(spark, [(i, t, "en") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] * 2, "doc_id long, quality int")
    once = quality.fit(quality.training_rows(docs, labels, "quality"))
    again = quality.fit(quality.training_rows(docs.repartition(7), labels.repartition(3), "quality"))
    np.testing.assert_allclose(once.w, again.w)
    assert quality.training_rows(docs, labels, "quality", rows=10).count() == 10


def test_no_training_rows_score_one_half(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(quality.training_rows(documents(spark), labels, "quality"))
    assert model.score(pd.Series(["a b", None])).tolist() == [0.5, 0.5]


def test_every_character_of_a_long_word_counts():
    clean = "語" * 300
    noise = clean[:100] + "#@9Z" * 50
    for text in (clean, noise):
        slots, values = quality.features(text)
        assert len(slots) == len(values)
    last = [quality.features(clean[:-1] + c)[0] for c in "字#"]
    assert not np.array_equal(*last) and len(np.intersect1d(*last)) > 1  # the last one tells, the rest is shared
    assert set(quality.features(noise)[0]) - set(quality.features(clean)[0])
    a, b = (set(quality.features("x" * 70 + end)[0]) for end in ("9", "#"))
    assert len(a ^ b) > 4


def test_hidden_states_tell_two_kinds_of_texts_apart(spark):
    draw = np.random.default_rng(2)
    kinds = [[f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]]
    rows = [(i, " ".join(draw.choice(kinds[i % 2], 60)), i % 7 == 2) for i in range(210)]
    scored = score_documents(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).filter("held_out").toPandas()
    # a text draws from half of the words: the model should find nearly all of that bit per word
    gain = (scored.score - scored.base_score).sum() / scored.n_tokens.sum()
    assert gain > 0.8 * np.log10(2)
