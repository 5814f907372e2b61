"""N-gram Jaccard join by vertical partitioning.

All n-grams (runs of five words) stand in one global order, rarest first by their number of documents,
which a fixed table of counters estimates over the whole corpus. The order is cut into `FRAGMENTS`
pieces of equal weight. Two documents can only be similar if they share an n-gram of their
prefixes in that order; such pairs are verified by counting their overlap in each fragment separately and
summing the partial counts per pair.

Documents with equal sets are one class. The query needs what is connected, not each link, so a group of
near copies is not turned into all its pairs: first every class meets one or two members of the groups it shares
n-grams with, and components are formed; afterwards pairs inside a component need no look, and those
between components are all examined. A parity sketch of each set bounds the size of the symmetric difference
from below and removes pairs that cannot be similar inside the join.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerpulse.llm.common import IdFilter, Sent, blank_words, components, stored, table

WORDS = 5
PERCENT = 80
FRAGMENTS = 8
#: Counters of the table that estimates the frequency of n-grams.
COUNTERS = 1 << 21
_CHUNK = 8192
#: Members met per class in each of the first rounds, before the best one is verified.
LEADERS = 12
ROUNDS = 2
_SKETCH = [f"s{i}" for i in range(8)]
#: Sets from this size on have a wide sketch besides, as theirs differ in more n-grams than 512 parities can show.
WIDE_FROM = 1000
_P1, _P2 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of words; of a shorter text, of all its words as one."""
    tokens = blank_words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    n = len(tokens) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = (out ^ hashes[i:i + n]) * _P1
        out ^= out >> np.uint64(32)
    return np.unique(out * _P2)


def _class_of(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def needed(n: int, percent: int = PERCENT) -> int:
    """Shared n-grams that a set of n must have with any similar one."""
    return -(-percent * n // 100)


class GlobalOrder:
    """Rank of a counter by its count; n-grams go by (rank of their counter, hash)."""

    def __init__(self, counts: np.ndarray, fragments: int = FRAGMENTS):
        order = np.argsort(counts, kind="stable").astype(np.uint32)
        self.rank = np.empty(len(counts), np.uint32)
        self.rank[order] = np.arange(len(counts), dtype=np.uint32)
        weight = np.cumsum(counts[order])
        self.pivots = np.searchsorted(weight, max(1, weight[-1]) * np.arange(1, fragments) / fragments)

    def sort(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The n-grams rarest first, and the fragment of each."""
        rank = self.rank[hashes & np.uint64(len(self.rank) - 1)]
        order = np.lexsort((hashes, rank))
        return hashes[order], np.searchsorted(self.pivots, rank[order], side="right")


def sketch_of(hashes: np.ndarray, bits: int = 9) -> np.ndarray:
    """512 (2^bits) parities of the set; the Hamming distance of two sketches never exceeds their sets' difference."""
    odd = (np.bincount((hashes >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1).astype(np.uint8)
    return np.packbits(odd).view(">i8").astype(np.int64)


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """Per document its class and size; and per task the counters of the n-grams it saw, in chunks."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.binary()),
                        ("task", pa.int32()), ("chunk", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            sizes, classes = [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), words)
                sizes.append(len(found))
                classes.append(_class_of(found))
                np.add.at(counts, (found & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
            none = [None] * len(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(none, pa.int32()),
                                              pa.array(none, pa.int32()), pa.array(none, pa.binary())], schema=schema)
        chunks = [c for c in range(COUNTERS // _CHUNK) if counts[c * _CHUNK:(c + 1) * _CHUNK].any()]
        packed = [zlib.compress(counts[c * _CHUNK:(c + 1) * _CHUNK].tobytes(), 1) for c in chunks]
        none, task = [None] * len(chunks), TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([
            pa.array(none, pa.int64()), pa.array(none, pa.int64()), pa.array(none, pa.binary()), pa.array([task] * len(chunks), pa.int32()),
            pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return stored(rows.mapInArrow(run, "doc_id long, n long, class binary, task int, chunk int, counts binary"), "shingle-profile")


def _counters(profile: DataFrame) -> np.ndarray:
    """Sums of the counters, 256 tasks at a time and then all; a fixed number of bytes comes back."""
    def add(kind):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(zlib.decompress(c), kind).astype(np.int64) for c in rows["counts"])
            return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "task": [rows["task"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

        return run

    form = "chunk int, task int, counts binary"
    some = (profile.filter("chunk is not null").select("chunk", F.shiftright("task", 8).alias("task"), "counts")
            .groupBy("chunk", "task").applyInPandas(add(np.int32), form))
    out = np.zeros(COUNTERS, np.int64)
    for r in some.groupBy("chunk").applyInPandas(add(np.int64), form).toLocalIterator():
        out[r["chunk"] * _CHUNK:(r["chunk"] + 1) * _CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out


def _representatives(rows: DataFrame) -> DataFrame:
    """One row per different set: c (number), class, doc_id (smallest), class_size.

    The number is the doc_id, unless several sets share their smallest doc_id: then all but one get a number below all ids.
    """
    once = rows.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("class_size"))
    lowest = rows.agg(F.min("doc_id")).first()[0] or 0
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("class"))
    number = F.when(F.col("turn") == 1, F.col("doc_id")).otherwise(F.lit(lowest) - 1 - F.monotonically_increasing_id())
    return stored(once.withColumn("turn", turn).select(number.alias("c"), "class", "doc_id", "class_size"), "shingle-sets")


def _classes(docs: DataFrame, rows: DataFrame, sets: DataFrame, sent, words: int, percent: int) -> DataFrame:
    """(c, n, sketch, wide sketch or null, prefix) of every set.

    Most documents are alone with their set and carry its number themselves. Copies and rows that share a
    doc_id find theirs in a join; the others never leave their task.
    """
    kinds = [("doc_id", pa.int64()), ("class", pa.binary()), ("n", pa.int64()), ("prefix", pa.list_(pa.int64())), ("wide", pa.list_(pa.int64())), *[(k, pa.int64()) for k in _SKETCH]]
    schema = pa.schema(kinds)

    copies = rows.join(sets.select("class", F.col("doc_id").alias("first")), "class").filter("doc_id <> first").select("doc_id")
    repeated = rows.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    shared = IdFilter(stored(copies.unionByName(repeated).distinct(), "shingle-shared"), "doc_id")

    def run(batches: Iterator[pa.RecordBatch], held: bool) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids, classes, sizes, prefixes, wide, sketches = [], [], [], [], [], []
                for i in np.flatnonzero(shared.holds(batch.column(2).to_numpy()) == held).tolist():
                    doc_id, found = batch.column(0)[i], shingles(batch.column(1)[i].as_py(), words)
                    if len(found):
                        ids.append(doc_id.as_py())
                        classes.append(_class_of(found))
                        sizes.append(len(found))
                        prefixes.append(sent.value.sort(found)[0][:len(found) - needed(len(found), percent) + 1].view(np.int64))
                        wide.append(sketch_of(found, 12) if len(found) >= WIDE_FROM else None)
                        sketches.append(sketch_of(found))
                marks = np.array(sketches, np.int64).reshape(-1, 8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids, pa.int64()), pa.array(classes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(prefixes, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.int64())),
                    *[pa.array(marks[:, i]) for i in range(8)]], schema=schema)

    texts = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", shared.place(F.col("doc_id")))
    kind = "doc_id long, class binary, n long, prefix array<long>, wide array<long>, " + ", ".join(f"{k} long" for k in _SKETCH)
    columns = ["c", "n", *_SKETCH, "wide", "prefix"]
    alone = texts.mapInArrow(lambda batches: run(batches, False), kind).withColumnRenamed("doc_id", "c").select(*columns)
    others = texts.mapInArrow(lambda batches: run(batches, True), kind).join(sets.select("c", "class", "doc_id"), ["doc_id", "class"]).dropDuplicates(["c"])
    return stored(alone.unionByName(others.select(*columns)), "shingle-classes")


def _packed(grams: np.ndarray) -> bytes:
    """The upper 48 bits of each hash: enough to tell the n-grams of two texts apart."""
    return np.sort(grams >> np.uint64(16)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    parts = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.pad(parts, ((0, 0), (2, 0))).view(">u8").ravel()


def _segments(docs: DataFrame, wanted: DataFrame, sent, words: int) -> DataFrame:
    """The rows of `wanted` (doc_id, class and more) with (fragment, grams): their n-grams, cut at the pivots."""
    schema = pa.schema([("doc_id", pa.int64()), ("class", pa.binary()), ("fragment", pa.int32()), ("grams", pa.binary())])

    test = IdFilter(wanted, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch, rows = whole.slice(at, 500), []
                for i in np.flatnonzero(test.holds(batch.column(2).to_numpy())).tolist():
                    found = shingles(batch.column(1)[i].as_py(), words)
                    grams, fragment = sent.value.sort(found)
                    name = _class_of(found)
                    for f in np.unique(fragment):
                        rows.append({"doc_id": batch.column(0)[i].as_py(), "class": name, "fragment": int(f), "grams": _packed(grams[fragment == f])})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    some = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text", test.place(F.col("doc_id")))
    return some.mapInArrow(run, "doc_id long, class binary, fragment int, grams binary").join(wanted, ["doc_id", "class"])


def _similar(n_a: str, n_b: str, difference: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar when they differ in at least `difference` n-grams."""
    size = F.col(n_a) + F.col(n_b)
    return ((F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent)
            & (difference * (100 + percent) <= size * (100 - percent)))


def _distance(a: str, b: str) -> Column:
    total = F.lit(0)
    for s in _SKETCH:
        total = total + F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}")))
    return total


def _wide_distance(a: str, b: str) -> Column:
    """Distance of the wide sketches; null if a set has none."""
    return F.aggregate(F.zip_with(f"{a}.wide", f"{b}.wide", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda total, n: total + n)


def _links(docs: DataFrame, pairs: DataFrame, sets: DataFrame, sizes: DataFrame, sent, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar: partial overlaps of each fragment, summed per pair.

    Only texts of the pairs are cut; the segments of a travel to b.
    """
    @F.pandas_udf("long")
    def overlap(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([len(np.intersect1d(_unpacked(p), _unpacked(q), assume_unique=True)) for p, q in zip(x, y)], dtype="int64")

    pairs = stored(pairs, "shingle-pairs")
    named = sets.select("c", "class", "doc_id")
    # rows that repeat a document would count twice
    left = (_segments(docs, stored(named.join(pairs, F.col("c") == F.col("a")).select("doc_id", "class", "a", "b"), "shingle-left"), sent, words)
            .select("a", "b", "fragment", F.col("grams").alias("ga")))
    right = (_segments(docs, stored(named.join(pairs.select("b").distinct(), F.col("c") == F.col("b")).select("doc_id", "class", "b"), "shingle-right"), sent, words)
             .select("b", "fragment", F.col("grams").alias("gb")))
    partial = left.join(right, ["b", "fragment"]).select("a", "b", "fragment", overlap("ga", "gb").alias("shared"))
    whole = partial.groupBy("a", "b", "fragment").agg(F.first("shared").alias("shared")).groupBy("a", "b").agg(F.sum("shared").alias("shared"))
    n_a, n_b = sizes.select(F.col("c").alias("a"), F.col("n").alias("na")), sizes.select(F.col("c").alias("b"), F.col("n").alias("nb"))
    both = whole.join(n_a, "a").join(n_b, "b")
    return both.filter(F.col("shared") * 100 >= (F.col("na") + F.col("nb") - F.col("shared")) * percent).select("a", "b")


class GramFilter(IdFilter):
    """The test for n-grams: their upper bits are their place, as they are hashes already."""

    def place(self, column: Column) -> Column:
        return F.shiftrightunsigned(column, 65 - self.bits.bit_length())

    def holds_grams(self, grams: np.ndarray) -> np.ndarray:
        return self.holds((grams.view(np.uint64) >> np.uint64(65 - self.bits.bit_length())).astype(np.int64))


def _holders(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, gram, and the columns of `wanted`) for the wanted n-grams; others do not leave their task, as far as a filter can tell."""
    test = GramFilter(wanted, "gram")
    schema = pa.schema([("c", pa.int64()), ("gram", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix = batch.column(1)
            grams = prefix.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(batch.column(0).to_numpy(), prefix.value_lengths().to_numpy(zero_copy_only=False))
            kept = test.holds_grams(grams)
            yield pa.RecordBatch.from_arrays([pa.array(owner[kept]), pa.array(grams[kept])], schema=schema)

    return classes.select("c", "prefix").mapInArrow(run, "c long, gram long").join(wanted, "gram")


def _near(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs (c, leader) that sizes and sketches allow to be similar, with their distance as a share of both sizes.

    Sizes go first, so that few pairs carry sketches.
    """
    n_x, n_y = known.select("c", F.col("n").alias("n_c")), known.select(F.col("c").alias("leader"), F.col("n").alias("n_leader"))
    like = pairs.select("c", "leader").join(n_x, "c").join(n_y, "leader").filter(_similar("n_c", "n_leader", F.lit(0), percent))
    x, y = known.alias("x"), known.withColumnRenamed("c", "leader").alias("y")
    return (like.select("c", "leader").join(y, "leader").join(x, "c").withColumn("distance", F.greatest(_distance("x", "y"), _wide_distance("x", "y")))
            .filter(_similar("x.n", "y.n", F.col("distance"), percent))
            .select("c", "leader", (F.col("distance") / (F.col("x.n") + F.col("y.n"))).alias("distance")))


def _class_components(docs: DataFrame, classes: DataFrame, sets: DataFrame, sent, words: int, percent: int) -> DataFrame:
    """(c, root) of the sets that link with another one.

    An n-gram of two sets is one pair, which the count of its sets names at once. Only n-grams of three sets or more need
    the list of their sets.
    """
    spark = docs.sparkSession
    grams = classes.select("c", F.explode("prefix").alias("gram"))
    shared = stored(grams.groupBy("gram").agg(F.count("c").alias("held_by"), F.min("c").alias("low"), F.max("c").alias("high"))
                    .filter("held_by > 1"), "shingle-shared-grams")
    known = classes.select("c", "n", *_SKETCH, "wide")
    couples = stored(_near(shared.filter("held_by = 2").select(F.col("high").alias("c"), F.col("low").alias("leader")).distinct(),
                           known, percent), "shingle-couples")
    hits = stored(_holders(classes, shared.filter("held_by > 2").select("gram", "held_by")), "shingle-hits")
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "c long, root long")

    def verified(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = stored(links.unionByName(_links(docs, pairs, sets, known, sent, words, percent)), "shingle-links")
        return found, stored(components(found).select(F.col("node").alias("c"), F.col("component").alias("root")), "shingle-roots")

    for turn in range(ROUNDS):
        # each set meets the leaders of its most shared n-grams, and the likeliest of them is verified
        leaders = hits.groupBy("gram").agg(F.min_by("c", F.xxhash64("c", "gram", F.lit(turn))).alias("leader"))
        met = (hits.join(leaders, "gram").filter("c <> leader").groupBy("c", "leader").agg(F.max("held_by").alias("held_by"))
               .withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("held_by"), F.xxhash64("leader", F.lit(turn)))))
               .filter(F.col("k") <= LEADERS))
        near = (_near(_apart(met, labels), known, percent).unionByName(_apart(couples, labels))
                .groupBy("c").agg(F.min_by("leader", "distance").alias("leader")))
        one_way = near.groupBy(F.least("c", "leader").alias("low"), F.greatest("c", "leader").alias("high")).agg(F.min("leader").alias("b"))
        links, labels = verified(one_way.select(F.when(F.col("b") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("a"), "b"))
    # every pair that is still in two components; lists are cut by size, so that a common n-gram is many small joins
    rooted = hits.select("gram", "c").join(labels, "c", "left").withColumn("root", F.coalesce("root", "c"))
    open_grams = rooted.groupBy("gram").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("gram")
    # similar sets are less than one step apart, rounding included
    step = F.floor(F.log(F.col("n").cast("double")) * ((1 - 1e-9) / math.log(max(100 / percent, 1.01)))).cast("int")
    left_over = stored(rooted.join(open_grams, "gram", "left_semi").join(known.drop("wide"), "c").withColumn("step", step), "shingle-open")
    x = left_over.alias("x")
    y = left_over.withColumn("step", F.explode(F.array(F.col("step"), F.col("step") + 1))).alias("y")
    rest = (x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.step") == F.col("y.step")) & (F.col("x.root") != F.col("y.root"))
                   & ((F.col("x.n") > F.col("y.n")) | (F.col("x.n") == F.col("y.n")) & (F.col("x.c") > F.col("y.c")))
                   & _similar("x.n", "y.n", _distance("x", "y"), percent))
            .select(F.col("x.c").alias("c"), F.col("y.c").alias("leader")).distinct())
    last = _near(rest, known, percent).unionByName(_apart(couples, labels))
    return verified(last.select(F.col("c").alias("a"), F.col("leader").alias("b")).distinct())[1]


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (c, leader) that are not in one component yet."""
    columns = pairs.columns
    mine, other = labels, labels.select(F.col("c").alias("leader"), F.col("root").alias("other_root"))
    return (pairs.join(mine, "c", "left").join(other, "leader", "left")
            .filter(F.coalesce("root", "c") != F.coalesce("other_root", "leader")).select(*columns))


def similarity_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_size) per row of `docs` (doc_id, text).

    Documents link when 100 * shared >= percent * united n-grams; component_id is the smallest doc_id
    reachable. Null, empty and blank texts have no n-grams and link with nothing. Rows without doc_id
    have no component and link with nothing. Rows with the same doc_id are separate members of
    the graph that share a name. class_size counts the rows with the same set.
    """
    profile = _profile(docs, words)
    rows = profile.filter("chunk is null").select("doc_id", "n", "class")
    linked = rows.filter("n > 0 and doc_id is not null")
    counts = _counters(profile)
    sent = Sent(docs.sparkSession, GlobalOrder(counts))
    sets = _representatives(linked)
    classes = _classes(docs, linked, sets, sent, words, percent)
    roots = _class_components(docs, classes, sets, sent, words, percent)
    named = sets.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = named.join(smallest, "root").select("class", "component_id", "class_size")
    in_class = linked.join(found, "class")
    alone = rows.filter("n = 0 or doc_id is null")
    return (in_class.select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_size")
            .unionByName(alone.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(1).cast("long").alias("class_size"))))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similarity_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
