"""Exact ranked lexical search in norm buckets, after LEMP.

A document is the vector of its impacts: per term the weight of the term times the saturated frequency, all
integers. An item is the vector with a one for each of its terms, so a score is an inner product. Documents lie in
buckets by the length of their vector, four to a doubling. Buckets are searched from the longest vectors down, in a few
rounds; the last score of an item's ranking goes with it, and a bucket whose longest vector times the length of
the item's cannot reach it is left out (Cauchy-Schwarz).

Inside a block of a bucket the terms with the highest impacts are the focus coordinates: as many as it takes for the
others' highest impacts together to stay below the last score. Documents without a focus term are out. The others are bounded
by their focus impacts plus the smaller of two bounds of the rest: the sum of highest impacts, and the
lengths of both remaining vectors multiplied. What survives is scored in whole numbers.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import FILTER_BITS, plain_words, stored, table, worker_memory
from ledgerpulse.operators.ranking import top_n_per_key

K = 10
#: Buckets per doubling of the squared length; documents of a block, items of a task.
STEPS, BLOCK_DOCS, TASK_ITEMS = 2, 4096, 256
#: Shares of the documents after which a round ends and the last scores are shared.
ROUNDS = (0.125, 0.5, 1.0)
#: Terms of which a worker remembers whether the filter lets them through.
KEPT_TERMS = 300_000
_FOUND = "item long, score long, doc_id long, row long"


def item_terms(items: DataFrame) -> DataFrame:
    """(item, item_id, term) per row of `items` (item_id, text) and different term of it, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                terms = sorted(set(plain_words(batch.column(2)[i].as_py())))
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(batch.column(0)[i], len(terms)), pa.repeat(batch.column(1)[i], len(terms)), pa.array(terms, pa.binary()),
                    pa.array([xxhash.xxh64_intdigest(t) % FILTER_BITS for t in terms], pa.int64())], names=["item", "item_id", "term", "place"])

    rows = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    kind = rows.schema["item_id"].dataType.simpleString()
    return stored(rows.mapInArrow(run, f"item long, item_id {kind}, term binary, place long"), "item-terms")


def _filter_bits(terms: DataFrame):
    """A bit for the hash of each term, sent to all tasks: `FILTER_BITS` bits at most, whatever the number of terms."""
    words = terms.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toPandas()
    held = np.zeros(FILTER_BITS // 64, np.int64)
    held[words["word"]] = words["bits"]
    return terms.sparkSession.sparkContext.broadcast(held)


def document_terms(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, doc_id, n, terms, tfs) per document with a term: n counts all, the lists hold those that may be among `terms`."""
    sent = _filter_bits(terms)
    search = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, memory = sent.value, worker_memory("lexical search")
        if search not in memory:  # what was remembered belongs to other terms
            memory.clear()
        known = memory.setdefault(search, {})
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                kept, sizes, found, tfs = [], [], [], []
                for i, text in enumerate(batch.column(2).to_pylist()):
                    words = plain_words(text)
                    if not words:
                        continue
                    if len(known) > KEPT_TERMS:
                        known.clear()
                    counts = Counter(words)
                    for t in [t for t in counts if t not in known]:
                        place = xxhash.xxh64_intdigest(t) % FILTER_BITS
                        known[t] = bool(held[place >> 6] >> (place & 63) & 1)
                    some = [t for t in counts if known[t]]
                    kept.append(i)
                    sizes.append(len(words))
                    found.append(some)
                    tfs.append([counts[t] for t in some])
                at_rows = pa.array(kept, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(at_rows), batch.column(1).take(at_rows), pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.binary())), pa.array(tfs, pa.list_(pa.int64()))], names=["row", "doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "row long, doc_id long, n long, terms array<binary>, tfs array<bigint>")


def impacts(documents: DataFrame, terms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weights (term, t, w) of the items' terms, and impact vectors (row, doc_id, ts, values, square), both stored."""
    total, length = documents.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    cells = documents.select("row", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select(
        "row", "doc_id", "n", F.col("x.terms").alias("term"), F.col("x.tfs").alias("tf"))
    counted = cells.groupBy("term").agg(F.count("*").alias("df")).join(terms.select("term").distinct(), "term")
    weight = F.floor(1000 * F.log(F.lit(float(2 * total + 2)) / (2 * F.col("df") + 1).cast("double")))
    weights = stored(counted.select("term", F.monotonically_increasing_id().alias("t"), weight.alias("w")), "term-weights")
    m = F.expr(f"10 + (90 * n * {total}L) div {max(1, length)}L")
    value = cells.join(weights.filter("w > 0"), "term").withColumn("m", m).select(
        "row", "doc_id", "t", F.expr("w * ((1000000000 * tf) div (1000 * tf + 8 * m))").alias("v"))
    vectors = value.groupBy("row", "doc_id").agg(
        F.collect_list("t").alias("ts"), F.collect_list("v").alias("values"), F.sum(F.col("v").cast("double") * F.col("v")).alias("square"))
    return weights, stored(vectors, "impact-vectors")


def _bucket(square: Column) -> Column:
    return F.floor(STEPS * F.log2(square)).cast("int")


class Block:
    """Impact vectors of some documents by document and by term."""

    def __init__(self, ts: list, values: list, squares: np.ndarray, place: np.ndarray, row: np.ndarray) -> None:
        sizes = np.array([len(x) for x in ts], np.int64)
        flat, self.value = np.concatenate([np.asarray(x, np.int64) for x in ts]), np.concatenate([np.asarray(x, np.int64) for x in values])
        self.terms, self.term = np.unique(flat, return_inverse=True)
        self.begin, self.sizes, self.squares = np.cumsum(sizes) - sizes, sizes, squares
        self.place, self.row = place, row
        order = np.argsort(self.term, kind="stable")
        self.owner = np.repeat(np.arange(len(sizes)), sizes)[order]
        self.impact = self.value[order].astype(np.float64)
        self.from_ = np.searchsorted(self.term[order], np.arange(len(self.terms) + 1))
        self.highest = np.maximum.reduceat(self.impact, self.from_[:-1])

    def best(self, wanted: np.ndarray, last: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best for an item with the terms `wanted`; some of those below `last` are left out."""
        at = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        own = at[self.terms[at] == wanted]
        own = own[np.argsort(-self.highest[own], kind="stable")]
        rest = np.append(np.cumsum(self.highest[own][::-1])[::-1], 0.0)  # of the terms from each on
        if not len(own) or rest[0] < last:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        focus = max(1, int(np.argmax(rest < last))) if rest[-1] < last else len(own)
        lists = [slice(self.from_[t], self.from_[t + 1]) for t in own[:focus]]
        owners, found = np.concatenate([self.owner[s] for s in lists]), np.concatenate([self.impact[s] for s in lists])
        sums = np.bincount(owners, found, len(self.sizes))
        docs = np.flatnonzero(sums)
        if focus < len(own):
            squares = np.bincount(owners, found * found, len(self.sizes))[docs]
            others = np.sqrt((len(own) - focus) * np.maximum(self.squares[docs] - squares, 0.0) * (1 + 1e-9) + 1.0)
            docs = docs[sums[docs] + np.minimum(rest[focus], others) >= last]
        if not len(docs):
            return docs, docs
        scores = self._score(docs, own)
        keep = scores >= last
        docs, scores = docs[keep], scores[keep]
        rank = np.lexsort((self.row[docs], self.place[docs], -scores))[:k]
        return docs[rank], scores[rank]

    def _score(self, docs: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whole-number scores of the documents: the impacts of the item's terms, summed."""
        asked = np.zeros(len(self.terms), bool)
        asked[own] = True
        sizes = self.sizes[docs]
        starts = np.cumsum(sizes) - sizes
        cells = np.arange(sizes.sum()) + np.repeat(self.begin[docs] - starts, sizes)
        return np.add.reduceat(np.where(asked[self.term[cells]], self.value[cells], 0), starts)


def _search(items: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k best of each group of (bucket, block, chunk): `items` (item, ts, last) against `vectors`."""
    def search(some: pd.DataFrame, docs: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(some) and len(docs):
            ids = docs["doc_id"]
            place = ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64) if ids.isna().any() else ids.to_numpy(np.int64)
            row = docs["row"].to_numpy(np.int64)
            block = Block(docs["ts"].tolist(), docs["values"].tolist(), docs["square"].to_numpy(np.float64), place, row)
            named = ids.astype("Int64").to_numpy(object)
            for item, ts, last in zip(some["item"], some["ts"], some["last"]):
                found, scores = block.best(np.asarray(ts, np.int64), last, k)
                parts.append(pd.DataFrame({"item": item, "score": scores, "doc_id": pd.array(named[found], "Int64"), "row": row[found]}))
        return pd.concat(parts) if parts else pd.DataFrame({"item": [], "score": [], "doc_id": [], "row": []})

    keys = ["bucket", "block", "chunk"]
    return items.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(search, _FOUND)


def rank_documents(items: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for each row of `items`.

    Both tables have a text; null, empty and wordless ones hold no term and are never ranked. Equal scores go by
    doc_id, a null one last. Repeated rows of `docs` are documents of their own; repeated rows of `items` each get
    their ranking. Further columns are left aside. A long text is counted as a whole, in memory for its different terms.
    """
    asked = item_terms(items)
    weights, vectors = impacts(stored(document_terms(docs, asked), "document-terms"), asked)
    queries = stored(asked.join(weights.filter("w > 0"), "term").groupBy("item", "item_id").agg(F.collect_list("t").alias("ts")), "item-vectors")
    chunks = max(1, math.ceil(queries.count() / TASK_ITEMS))
    # one row per step of the length: some hundred at most
    buckets = sorted(((r["b"], r["n"]) for r in vectors.groupBy(_bucket(F.col("square")).alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, seen, found = sum(n for _, n in buckets), 0, None
    chunk = F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("chunk")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    for share in ROUNDS:
        now = []
        while buckets and (seen < share * total or share == ROUNDS[-1]):
            seen += buckets[0][1]
            now.append(buckets.pop(0))
        if not now:
            continue
        blocks = F.create_map(*[F.lit(x) for b, n in now for x in (b, math.ceil(n / BLOCK_DOCS))])
        last = F.lit(0.0)
        some = queries
        if found is not None:
            some = queries.join(found.groupBy("item").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("last")), "item", "left")
            last = F.coalesce("last", F.lit(0.0))
        reach = F.sqrt(F.size("ts") * F.pow(F.lit(2.0), (F.col("bucket") + 1) / STEPS)) * (1 + 1e-9)
        active = (some.select("item", "ts", chunk, last.alias("last"), F.explode(F.array(*[F.lit(b) for b, _ in now])).alias("bucket"))
                  .filter(reach >= F.col("last"))
                  .withColumn("block", F.explode(F.sequence(F.lit(0), blocks[F.col("bucket")] - 1))))
        dealt = (vectors.withColumn("bucket", _bucket(F.col("square"))).filter(F.col("bucket").isin([b for b, _ in now]))
                 .withColumn("block", F.pmod(F.xxhash64("row"), blocks[F.col("bucket")]).cast("int"))
                 .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))))
        new = _search(active, dealt, k)
        found = stored(top_n_per_key(new if found is None else new.unionByName(found.drop("rank")), "item", order, k), "lexical-found")
    if found is None:
        return queries.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return found.join(queries.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op13_ranked_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return rank_documents(table(spark, sf_dir, "benchmark").select("item_id", "text"), table(spark, sf_dir, "documents").select("doc_id", "text"))
