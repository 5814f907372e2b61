"""What the training-data operators share: tables, stored results, words, held-out rows."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.session import fresh_folder

#: Bits of a filter sent to all tasks.
FILTER_BITS = 1 << 26
#: A-Z become a-z; everything else up to 0x7F that is no letter or digit separates words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there; cuts the lineage."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blank_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between blanks, UTF-8."""
    return text.encode().lower().split() if text else []


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of letters, digits and non-ASCII characters, UTF-8."""
    return text.encode().translate(WORD_BYTES).split() if text else []


class Sent:
    """An object of this package broadcast as its plain attributes, so that workers load it without the package.

    The class itself travels with the function that uses it.
    """

    def __init__(self, spark: SparkSession, held) -> None:
        self.kind, self.sent = type(held), spark.sparkContext.broadcast(vars(held))

    @property
    def value(self):
        held = object.__new__(self.kind)
        held.__dict__ = self.sent.value  # what the object remembers stays with the worker
        return held

    def unpersist(self) -> None:
        self.sent.unpersist()


def worker_memory(name: str) -> dict:
    """A dictionary that lives as long as the Python worker.

    Functions travel by value, so their own globals are new in every task.
    """
    return vars(sys.modules.setdefault("_ledgerpulse_memory", types.ModuleType("_ledgerpulse_memory"))).setdefault(name, {})


def held_out(modulus: int, remainder: int, key: str = "doc_id") -> Column:
    """True for rows whose crc32 of the id as text leaves the remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def least_step(counts: DataFrame, size: int, column: str = "n", parts: int = 16) -> tuple[Column, int]:
    """A step function of a count and the lowest step such that at most `size` rows reach it.

    Only the number of rows per step comes back, some hundred numbers, whatever the table holds.
    """
    step = F.floor(F.log2(column) * parts).cast("int")
    held, least = 0, None
    for s, n in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        if held + n > size:
            break
        held, least = held + n, s
    return step, least if least is not None else 2 ** 31 - 1


class IdFilter:
    """A test for ids that lets all of `ids` through and few others: one bit per hash of an id.

    The bits are at most `FILTER_BITS` however many ids there are; with very many ids the test lets more
    and more others through, so it may only stand before an exact join. Tasks ask `holds` for the
    places that `place` gave to ids.
    """

    def __init__(self, ids: DataFrame, name: str) -> None:
        self.bits = min(FILTER_BITS, 1 << max(16, (16 * ids.count()).bit_length()))
        words = (ids.select(self.place(F.col(name)).alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).toPandas())
        held = np.zeros(self.bits // 64, np.int64)
        held[words["word"]] = words["bits"]
        self.sent = ids.sparkSession.sparkContext.broadcast(held)

    def place(self, column: Column) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(column.cast("long"), F.lit(0))), F.lit(self.bits))

    def holds(self, places: np.ndarray) -> np.ndarray:
        return (self.sent.value[places >> 6] >> (places & 63) & 1).astype(bool)


def likely_in(ids: DataFrame, name: str) -> Callable[[Column], Column]:
    """The test of an `IdFilter` as a condition on a column."""
    held = IdFilter(ids, name)

    @F.pandas_udf("boolean")
    def test(places: pd.Series) -> pd.Series:
        return pd.Series(held.holds(places.to_numpy(np.int64)))

    return lambda column: test(held.place(column))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of the edges (a, b) reaches.

    Alternates large-star and small-star steps until the edges stand still. Neighbours are only reduced
    to their minimum, so a node with very many edges is combined on the map side.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct(), "edges")
    mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    while True:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        edges = stored(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.join(edges.select(F.col("a").alias("node")), "node", "left_anti").withColumn("component", F.col("node"))))
