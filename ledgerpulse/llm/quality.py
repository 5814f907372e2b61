"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Words, their shapes (runs of upper case, lower case, digits and each other sign) and pairs
of both are hashed to a fixed number of slots. A long word, such as a text without blanks, counts
besides as its n-grams of characters, over its full length. Workers run FTRL over disjoint shards of
the training rows; after each round their states are averaged and sent out again. A score is
one sparse dot product and a logistic function.

The model is fitted on at most `MAX_ROWS` labelled rows: those with the smallest hash of
doc_id. The bound keeps the fit the same at any size; every text is scored.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import Sent, held_out, stored, table, worker_memory

MAX_ROWS = 20_000
SLOTS = 1 << 18
SHARDS = 8
ROUNDS = 3
#: A word of more characters also counts as n-grams of `LONG_GRAM` characters.
LONG_WORD, LONG_GRAM = 64, 3
#: Short words whose hashes a worker remembers.
KEPT_WORDS = 40_000
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-3
_RUNS = re.compile(r"([A-ZÀ-ÖØ-Þ]+)|([^\W\d_]+)|(\d+)|(\W|_)\4*")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FAMILY_MIX = np.array([0x9E3779B97F4A7C15 * k % 2 ** 64 for k in (3, 5, 7, 9)], np.uint64)


def _shape(word: str) -> str:
    return _RUNS.sub(lambda m: "X" if m[1] else "x" if m[2] else "9" if m[3] else m[4], word)


def _hashes(word: str) -> tuple[int, int]:
    return xxhash.xxh64_intdigest(word.lower()), xxhash.xxh64_intdigest("shape " + _shape(word))




def _char_grams(text: str) -> np.ndarray:
    """One hash per n-gram of neighbouring characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    grams = np.zeros(len(codes) - LONG_GRAM + 1, np.uint64)
    for i in range(LONG_GRAM):
        grams = (grams ^ (codes[i:i + len(grams)] + _MIX)) * _FAMILY_MIX[0]
        grams ^= grams >> np.uint64(31)
    return grams


def _word_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and of shapes in the order of the text, with the n-grams of long words behind them."""
    kinds, shapes, short = [], [], []
    known = worker_memory("word hashes")
    if len(known) > KEPT_WORDS:
        known.clear()

    def flush() -> None:
        if short:
            for w in set(short).difference(known):
                known[w] = _hashes(w)
            both = np.array([known[w] for w in short], np.uint64)
            kinds.append(both[:, 0])
            shapes.append(both[:, 1])
            short.clear()

    for word in words:
        if len(word) <= LONG_WORD:
            short.append(word)
            continue
        flush()
        whole, shape = _hashes(word)
        runs = {c: _shape(c) for c in set(word)}
        kinds += [np.array([whole], np.uint64), _char_grams(word.lower())]
        shapes += [np.array([shape], np.uint64), _char_grams("".join(map(runs.__getitem__, word)))]
    flush()
    return np.concatenate(kinds), np.concatenate(shapes)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text; slot 0 is the constant. Each family of n-grams has length 1."""
    words = text.split() if text else []
    slots, values = [np.zeros(1, np.int64)], [np.ones(1)]
    if words:
        for family, hashes in enumerate(_word_hashes(words)):
            pairs = hashes[:-1] * _MIX + hashes[1:]
            pairs[hashes[:-1] == hashes[1:]] = np.uint64(family + 1)  # the same word or shape again
            for n, grams in enumerate((hashes, pairs)):
                if len(grams):
                    mixed = (grams ^ (grams >> np.uint64(29))) * _FAMILY_MIX[2 * family + n]
                    found, counts = np.unique((mixed >> np.uint64(40)) % np.uint64(SLOTS - 1), return_counts=True)
                    slots.append(found.astype(np.int64) + 1)
                    values.append(np.sqrt(counts / len(grams)))
    return np.concatenate(slots), np.concatenate(values)


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Closed form of the regularised leader."""
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, w)


def ftrl_pass(z: np.ndarray, n: np.ndarray, rows) -> None:
    """One pass over (slots, values, label); changes z and n."""
    for slots, values, label in rows:
        w = weights(z[slots], n[slots])
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = (p - label) * values
        sigma = (np.sqrt(n[slots] + g * g) - np.sqrt(n[slots])) / ALPHA
        np.add.at(z, slots, g - sigma * w)
        np.add.at(n, slots, g * g)


class QualityModel:
    def __init__(self, w: np.ndarray):
        self.w = w

    def score(self, texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            slots, values = features(text)
            out.append(1 / (1 + np.exp(-np.clip(self.w[slots] @ values, -35, 35))))
        return pd.Series(out, dtype="float64")


def training_rows(docs: DataFrame, labels: DataFrame, label: str, rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, y) of the labelled documents with the smallest hashes of doc_id.

    Labels other than 0 and 1 and rows without id are left out. Repeated labels of a document
    count by their largest, repeated rows of a document by one of its texts (the smallest).
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    # twice the share wanted is enough for the order to choose from; with few rows that is all of them
    share = 2.0 * rows / max(1, usable.select("doc_id").distinct().count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    chosen = (usable.filter(place < int(min(1.0, share) * (1 << 40)))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
              .orderBy(place, "doc_id").limit(rows))
    # at most `rows` ids are broadcast
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "y").agg(F.min("text").alias("text")))


def _shard_pass(sent, turn: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        z, n = (a.astype(np.float64) for a in sent.value)
        order = sorted(range(len(part)), key=lambda i: xxhash.xxh64_intdigest(f"{turn} {part['doc_id'].iloc[i]}"))
        ftrl_pass(z, n, ((*features(part["text"].iloc[i]), float(part["y"].iloc[i])) for i in order))
        return pd.DataFrame({"shard": [int(part["shard"].iloc[0])], "rows": [len(part)],
                             "z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return run


def fit(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> QualityModel:
    """Rows (doc_id, text, y); without any, every score is one half."""
    spark = rows.sparkSession
    rows = stored(rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards))), "quality-rows")
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))
        # one state per shard: bounded by shards and slots
        states = rows.groupBy("shard").applyInPandas(_shard_pass(sent, turn), "shard int, rows long, z binary, n binary")
        seen, z, n = 0, np.zeros(SLOTS), np.zeros(SLOTS)
        for state in states.orderBy("shard").toLocalIterator():  # one at a time, in a fixed order
            seen += state["rows"]
            z += state["rows"] * np.frombuffer(state["z"], np.float32)
            n += state["rows"] * np.frombuffer(state["n"], np.float32)
        sent.unpersist()
        z, n = z / max(1, seen), n / max(1, seen)
    return QualityModel(weights(z, n).astype(np.float32))


def quality_score(spark, model: QualityModel) -> Column:
    """Column with the score of `text`: null and empty texts get the score of the constant alone."""
    sent = Sent(spark, model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return sent.value.score(texts)

    return score.asNondeterministic()("text")  # else a filter on the score would run it twice


def fit_on_tables(spark, sf_dir: str) -> QualityModel:
    """Learns from the labelled rows outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return fit(training_rows(docs, labels.filter(~held_out(4, 2)), "quality"))


def op9_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = docs.select("doc_id", held_out(4, 2).alias("held_out"), quality_score(spark, fit_on_tables(spark, sf_dir)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
