"""Language identification by interpolated Kneser-Ney character models.

A text counts as its words (runs of letters, lower case), each read from a start mark to an end
mark. Per language, n-grams up to `ORDER` characters give interpolated Kneser-Ney
probabilities: raw counts at the top and for n-grams that begin at the start mark, continuation
counts below. The models of all languages share one sorted array of n-gram hashes per
order. The language with the lowest cross-entropy per character wins; the temperature of the
score and the limit of acceptance per language are calibrated on the training documents.

Counts, continuation counts, discounts and context weights cover all n-grams of all training documents; they are
Spark aggregations. Behind them a language keeps the probabilities of at most `MAX_GRAMS` n-grams of each order,
the most frequent ones by steps of count, and all single characters: a bound on the size of the model. What the others held goes to the
lower order after their context, so probabilities still sum to one.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import Sent, held_out, stored, table

ORDER = 4
MAX_GRAMS = 200_000
KEPT_WORDS = 100_000
#: A document is accepted while its cross-entropy is within so many deviations of its language's mean.
DEVIATIONS = 4.0
TEMPERATURES = (1.0, 2.0, 4.0, 8.0, 16.0, 32.0, 64.0)
UNKNOWN = "und"
_START, _END = "\x02", "\x03"
_RUN = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Lower-case runs of letters."""
    words = _RUN.findall(text.lower()) if text else []
    if all(map(str.isalpha, words)):
        return words
    parts = ("".join(c if c.isalpha() else " " for c in w).split() for w in words)  # numerals that are no digits
    return [w for ws in parts for w in ws]


def _grams(words: Counter, order: int) -> Counter:
    """Top-order n-grams, and shorter ones that begin at the start mark."""
    out: Counter = Counter()
    for word, n in words.items():
        marked = _START + word + _END
        for k in range(2, min(order, len(marked) + 1)):
            out[marked[:k]] += n
        for i in range(len(marked) - order + 1):
            out[marked[i:i + order]] += n
    return out


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of documents with lang and text, summed on the map side first."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.string()), ("n", pa.int64())])

    def flush(words: dict[str, Counter]):
        for lang, counts in words.items():
            grams = _grams(counts, order)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(list(grams), pa.string()),
                                              pa.array(list(grams.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                words[lang.as_py()].update(letter_words(text.as_py()))
                if sum(map(len, words.values())) > KEPT_WORDS:
                    yield from flush(words)
                    words.clear()
        yield from flush(words)

    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    return rows.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_grams(grams: DataFrame, order: int, most: int = MAX_GRAMS) -> DataFrame:
    """(lang, k, gram, a, gamma) as `fit_language` gives them, of all n-grams (lang, gram, n); then bounded."""
    tables = {order: grams.filter(F.length("gram") == order).select("lang", "gram", "n")}
    for k in range(order - 1, 0, -1):
        # kinds of characters before it, and counts of those that begin at the start mark
        kinds = tables[k + 1].groupBy("lang", F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n"))
        tables[k] = (kinds.unionByName(grams.filter(F.length("gram") == k).select("lang", "gram", "n"))
                     .filter(F.col("gram") != _START).groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    every = reduce(DataFrame.unionByName, [t.withColumn("k", F.lit(k)) for k, t in sorted(tables.items())])
    every = stored(every.withColumn("context", F.expr("substring(gram, 1, k - 1)")), "language-tables")

    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = every.groupBy("lang", "k", step.alias("step")).agg(
        F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("ones"), F.count_if(F.col("n") == 2).alias("twos"))
    found: dict[tuple[str, int], list] = defaultdict(list)
    for r in sizes.collect():  # some hundred steps per language and order
        found[r["lang"], r["k"]].append(r)
    plan = []
    for (lang, k), steps in found.items():
        ones, twos = sum(r["ones"] for r in steps), sum(r["twos"] for r in steps)
        held, least = 0, 0
        for r in sorted(steps, key=lambda r: -r["step"]):
            if held and held + r["kinds"] > most and k > 1:
                break
            held, least = held + r["kinds"], r["step"]
        plan.append((lang, k, ones / (ones + 2 * twos) if ones and twos else 0.5, least))
    plan = grams.sparkSession.createDataFrame(plan, "lang string, k int, discount double, least int")
    planned = every.join(F.broadcast(plan), ["lang", "k"])  # a row per language and order
    contexts = planned.groupBy("lang", "k", "context").agg(
        F.sum("n").alias("total"), F.count("*").alias("kinds"), F.first("discount").alias("discount"),
        F.sum(F.when(step < F.col("least"), F.greatest(F.col("n") - F.col("discount"), F.lit(0.0))).otherwise(0.0)).alias("cut"),
        F.count_if(step >= F.col("least")).alias("held"))
    contexts = stored(contexts.select(
        "lang", "k", "context", "total", "held", ((F.col("discount") * F.col("kinds") + F.col("cut")) / F.col("total")).alias("gamma")), "language-contexts")
    a = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
    seen = (planned.filter(step >= F.col("least")).join(contexts.select("lang", "k", "context", "total"), ["lang", "k", "context"])
            .select("lang", "k", "gram", a.alias("a"), F.lit(None).cast("double").alias("gamma")))
    # a context without any kept n-gram leaves all to the lower order, as one never seen does
    after = contexts.filter("held > 0").select("lang", (F.col("k") - 1).alias("k"), F.col("context").alias("gram"),
                                               F.lit(None).cast("double").alias("a"), "gamma")
    return seen.unionByName(after).groupBy("lang", "k", "gram").agg(
        F.coalesce(F.max("a"), F.lit(0.0)).alias("a"), F.coalesce(F.max("gamma"), F.lit(1.0)).alias("gamma"))


def _codes(grams: list[str], k: int) -> np.ndarray:
    return np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(-1, k)


def hash_columns(columns) -> np.ndarray:
    """64-bit hash of n-grams given character by character."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ (c.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
    return h


def fit_language(counts: dict[str, int], order: int) -> list[pd.DataFrame]:
    """Per order 1..n: gram, a (discounted probability) and gamma (weight left to the lower order after it as a context)."""
    tables = {order: {g: n for g, n in counts.items() if len(g) == order}}
    for k in range(order - 1, 0, -1):
        lower: Counter = Counter(g[1:] for g in tables[k + 1])  # kinds of characters before it
        lower.update({g: n for g, n in counts.items() if len(g) == k})
        lower.pop(_START, None)
        tables[k] = dict(lower)
    out = []
    gammas: dict[str, float] = {}
    for k in range(1, order + 1):
        grams = pd.Series(tables[k], dtype="float64")
        if grams.empty:
            out.append(pd.DataFrame({"gram": [], "a": []}))
            continue
        ones, twos = (grams == 1).sum(), (grams == 2).sum()
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        context = grams.index.str[:-1] if k > 1 else pd.Index([""] * len(grams))
        total = grams.groupby(context).sum()
        kinds = grams.groupby(context).size()
        gammas |= (discount * kinds / total).to_dict()
        out.append(pd.DataFrame({"gram": grams.index, "a": ((grams - discount).clip(lower=0) / total[context].to_numpy()).to_numpy()}))
    contexts: list[dict[str, float]] = [{} for _ in range(order)]
    for c, g in gammas.items():
        contexts[len(c)][c] = g
    frames = []
    for k in range(0, order + 1):
        seen = dict(zip(out[k - 1]["gram"], out[k - 1]["a"])) if k else {}
        after = contexts[k] if k < order else {}
        names = list(seen.keys() | after.keys())
        frames.append(pd.DataFrame({"gram": names, "a": [seen.get(g, 0.0) for g in names], "gamma": [after.get(g, 1.0) for g in names]}))
    return frames


class LanguageModels:
    """Sorted hashes per order with the values of all languages."""

    def __init__(self, fitted: dict[str, list[pd.DataFrame]], order: int):
        self.langs, self.order = sorted(fitted), order
        self.hashes, self.a, self.gamma = [], [], []
        letters = set()
        for k in range(order + 1):
            keys = sorted({g for lang in self.langs for g in fitted[lang][k]["gram"]})
            if k == 1:
                letters = set(keys) - {_START}
            hashed = hash_columns(_codes(keys, k).T) if k else np.zeros(len(keys), np.uint64)
            order_of = np.argsort(hashed, kind="stable")
            a, gamma = np.zeros((len(keys) + 1, len(self.langs))), np.ones((len(keys) + 1, len(self.langs)))
            at = {g: i for i, g in enumerate(keys)}
            for j, lang in enumerate(self.langs):
                f = fitted[lang][k]
                i = np.array([at[g] for g in f["gram"]], np.int64)
                a[i, j], gamma[i, j] = f["a"], f["gamma"]
            order_of = np.append(order_of, len(keys))  # the last row stands for n-grams never seen
            self.hashes.append(hashed[order_of[:-1]])
            self.a.append(a[order_of])
            self.gamma.append(gamma[order_of])
        self.floor = 1.0 / (len(letters) + 1)
        self.known: dict[str, int] = {}  # row of a word in `bits`
        self.bits = np.zeros((0, len(self.langs)))

    def _find(self, k: int, hashed: np.ndarray) -> np.ndarray:
        keys = self.hashes[k]
        if not len(keys):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
        return np.where(keys[at] == hashed, at, len(keys))

    def _log2(self, words: list[str]) -> np.ndarray:
        """Sum of log2 probabilities of the characters and the end mark of each word, by language."""
        joined = "".join(_START + w + _END for w in words)
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        lengths = np.array([len(w) + 2 for w in words])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        depth = np.arange(len(codes)) - np.repeat(starts, lengths)
        p = np.full((len(codes), len(self.langs)), self.floor)
        before = None  # row of the context in its own table
        for k in range(1, self.order + 1):
            at = np.flatnonzero(depth >= k - 1)
            rows = np.full(len(codes), len(self.hashes[k]))
            rows[at] = self._find(k, hash_columns([codes[at - k + 1 + i] for i in range(k)]))
            gamma = self.gamma[0][:1] if k == 1 else self.gamma[k - 1][before[at - 1]]
            p[at] = self.a[k][rows[at]] + gamma * p[at]
            before = rows
        p[depth == 0] = 1.0
        return np.add.reduceat(np.log2(np.maximum(p, 1e-12)), starts, axis=0)

    def entropies(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character of each text under each language, and its number of characters."""
        if not self.langs:
            return np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)
        out, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for begin in range(0, len(texts), 200):
            words = [letter_words(t) for t in texts[begin:begin + 200]]
            new = list(set().union(*words).difference(self.known)) if words else []
            if len(self.known) + len(new) > KEPT_WORDS:
                self.known, self.bits = {}, self.bits[:0]
                new = list(set().union(*words))
            found = [self._log2(new[at:at + 5000]) for at in range(0, len(new), 5000)]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.bits = np.concatenate([self.bits, *found])
            for i, ws in enumerate(words, begin):
                if ws:
                    sizes[i] = sum(map(len, ws)) + len(ws)
                    rows = np.fromiter(map(self.known.__getitem__, ws), np.int64, len(ws))
                    out[i] = -self.bits[rows].sum(axis=0) / sizes[i]
        return out, sizes


def fit(docs: DataFrame, order: int = ORDER, max_grams: int = MAX_GRAMS) -> LanguageModels:
    """Models of every lang of the documents (lang, text); rows without lang or text are left out."""
    found = fit_grams(stored(count_grams(docs, order), "language-grams"), order, max_grams).toPandas()
    return LanguageModels({lang: [f[f["k"] == k] for k in range(order + 1)] for lang, f in found.groupby("lang")}, order)


def identify(docs: DataFrame, models: LanguageModels, training) -> DataFrame:
    """The rows of `docs` without text, with lang_pred, score and accepted.

    `training` (a condition) marks the documents whose lang calibrates the score. A null text and
    one without letters are `und` with score 0. Equal entropies go to the first language by name.
    Columns named like the new ones are replaced.
    """
    sent = Sent(docs.sparkSession, models)
    names = [c for c in docs.columns if c not in ("text", "lang_pred", "score", "accepted", "_e")]

    @F.pandas_udf("bits array<double>, chars long")
    def entropies(texts: pd.Series) -> pd.DataFrame:
        bits, sizes = sent.value.entropies(texts.tolist())
        return pd.DataFrame({"bits": list(bits), "chars": sizes})

    rows = stored(docs.select(*names, F.coalesce(training, F.lit(False)).alias("_train"), entropies("text").alias("_e")), "language-entropies")
    langs = F.array(*[F.lit(x) for x in models.langs]) if models.langs else F.array().cast("array<string>")
    bits, least = F.col("_e.bits"), F.array_min("_e.bits")
    readable = (F.col("_e.chars") > 0) & (F.size(bits) > 0)
    best = F.element_at(langs, F.array_position(bits, least).cast("int"))

    def share(t: float, of):
        """Share of the language with `of` bits, at temperature t per character."""
        return F.pow(F.lit(2.0), -(of - least) * t) / F.aggregate(bits, F.lit(0.0), lambda s, b: s + F.pow(F.lit(2.0), -(b - least) * t))

    own = F.element_at(bits, F.array_position(langs, F.col("lang")).cast("int"))
    fitting = rows.filter(F.col("_train") & readable & F.array_contains(langs, F.col("lang")))
    losses = fitting.agg(*[F.avg(-F.log(F.greatest(share(t, own), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]).first()
    temperature = min(zip([x if x is not None else 0.0 for x in losses], TEMPERATURES))[1]
    limits = {r["lang"]: r["m"] + DEVIATIONS * (r["s"] or 0.0) for r in
              fitting.groupBy("lang").agg(F.avg(own).alias("m"), F.stddev_samp(own).alias("s")).collect()}  # a row per language
    limit = F.create_map(*[x for lang, v in sorted(limits.items()) for x in (F.lit(lang), F.lit(v))]) if limits else F.lit(None).cast("map<string,double>")
    return rows.select(
        *names, F.when(readable, best).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(readable, share(temperature, least)).otherwise(0.0).alias("score"),
        F.coalesce(readable & (least <= limit[best]), F.lit(False)).alias("accepted"))


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    # a tenth of the training documents is kept out of the counts: on it the score and its limits are calibrated
    slice_of = F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text", held_out(3, 1).alias("held_out"), slice_of.alias("calibrates"))
    models = fit(docs.filter("not held_out and not calibrates"))
    return identify(docs, models, F.expr("not held_out and calibrates")).select("doc_id", "held_out", "lang_pred", "score", "accepted")
