"""Line dedup over sharded cuckoo filters with exact reference counts.

State of a `LineIndex`: signed reference rows, one per distinct key and document
(+1 inserted, -1 deleted), kept as files in the shared folder by batch, so inserting
and deleting documents only adds rows and any step can be undone. The exact
reference-count table sums them per key on the map side first.

Keys held often enough are put into cuckoo filters, one per shard of the key space. While
all filters together stay below `FILTER_BYTES` they are sent to every task and
lines that are in no filter leave the job before any shuffle; above that bound the lines
are joined with the exact table directly. Either way the exact table decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm.common import stored, table

MIN_CHARS = 20
MIN_DOCS = 3
SHARDS = 64
#: The filters are broadcast up to this size only.
FILTER_BYTES = 32 << 20
_BLANK = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()


def _key_hash(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the key of a line; None where the key is too short to count."""
    key = line_key(line)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; supports delete; a full filter doubles and is rebuilt."""

    SLOTS = 4

    def __init__(self, expected: int, table: np.ndarray | None = None):
        size = 1
        while size * self.SLOTS * 0.8 < max(expected, 1):
            size *= 2
        self.table = np.zeros((size, self.SLOTS), np.uint16) if table is None else table

    @staticmethod
    def parts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bucket seed, fingerprint from 1) of 64-bit keys."""
        return keys >> np.uint64(16), ((keys & np.uint64(0xFFFF)) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, bucket, fingerprint):
        spread = np.asarray(fingerprint, np.uint64) * np.uint64(0x5BD1E995)
        return (np.asarray(bucket, np.uint64) ^ spread) & np.uint64(len(self.table) - 1)

    def insert(self, key: int) -> bool:
        seed, prints = self.parts(np.array([key], np.uint64))
        bucket, mark = int(seed[0]) & (len(self.table) - 1), int(prints[0])
        for turn in range(500):
            for place in (bucket, int(self._other(bucket, mark))):
                free = np.flatnonzero(self.table[place] == 0)
                if len(free):
                    self.table[place, free[0]] = mark
                    return True
            slot = turn % self.SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = int(self._other(bucket, mark))
        return False

    def delete(self, key: int) -> bool:
        seed, prints = self.parts(np.array([key], np.uint64))
        bucket = int(seed[0]) & (len(self.table) - 1)
        for place in (bucket, int(self._other(bucket, prints[0]))):
            held = np.flatnonzero(self.table[place] == prints[0])
            if len(held):
                self.table[place, held[0]] = 0
                return True
        return False

    def might_hold(self, keys: np.ndarray) -> np.ndarray:
        seed, prints = self.parts(keys)
        first = seed & np.uint64(len(self.table) - 1)
        second = self._other(first, prints)
        return ((self.table[first.astype(np.int64)] == prints[:, None]).any(1)
                | (self.table[second.astype(np.int64)] == prints[:, None]).any(1))

    @classmethod
    def of(cls, keys: np.ndarray) -> "CuckooFilter":
        room = len(keys)
        while True:
            made = cls(room)
            if all(made.insert(int(k)) for k in keys):
                return made
            room = 2 * made.table.size


def _shard(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(58)).astype(np.int64)


def _front(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(h[:8] for h in hashes), ">u8").astype(np.uint64)


def references(docs: DataFrame, sign: int = 1, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id, n): one row per document row and distinct key that is long enough."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("n", pa.int32())])

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, owners = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {_key_hash(x, min_chars) for x in (text or b"").split(b"\n")} - {None}
                keys += found
                owners += [doc] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(owners, pa.int64()), pa.array([sign] * len(keys), pa.int32())], schema=schema)

    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return rows.mapInArrow(keys_of, "key binary, doc_id long, n int")


def _reference_counts(rows: DataFrame, min_docs: int) -> DataFrame:
    """Exact table of the keys in at least `min_docs` documents, with the largest document."""
    return (rows.groupBy("key").agg(F.sum("n").alias("n_docs"), F.max("doc_id").alias("keeper"))
            .filter(F.col("n_docs") >= min_docs))


def _filters(counts: DataFrame) -> DataFrame:
    """(shard, table): a cuckoo filter of the counted keys for each shard."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(np.unique(_front(list(rows["key"]))))
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "cells": [made.table.tobytes()]})

    first = F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("int")
    return counts.select("key", F.shiftright(first, 2).alias("shard")).groupBy("shard").applyInPandas(build, "shard int, cells binary")


class LineIndex:
    """Lines of a growing corpus. `insert` and `delete` take documents; both can be repeated in any order.

    A document row counts once per key, so rows that repeat a doc_id count as separate documents;
    they share the keeper. Rows without doc_id hold no lines: they are never counted and lose nothing.
    """

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS):
        self.spark, self.min_chars, self.min_docs = spark, min_chars, min_docs
        self.batches: list[DataFrame] = []
        self.deleted = False

    def insert(self, docs: DataFrame) -> "LineIndex":
        self.batches.append(stored(references(docs, 1, self.min_chars), "line-references"))
        return self

    def delete(self, docs: DataFrame) -> "LineIndex":
        """Take out documents that were inserted with these texts."""
        self.batches.append(stored(references(docs, -1, self.min_chars), "line-references"))
        self.deleted = True
        return self

    def counts(self) -> DataFrame:
        rows = self.batches[0]
        for more in self.batches[1:]:
            rows = rows.unionByName(more)
        if self.deleted:  # the keeper must be a document that is still there
            rows = rows.groupBy("key", "doc_id").agg(F.sum("n").alias("n")).filter("n > 0")
        return _reference_counts(rows, self.min_docs)

    def dedup(self, docs: DataFrame) -> DataFrame:
        return drop_lines(docs, self.counts(), self.min_chars)


def _probe(spark: SparkSession, counts: DataFrame):
    """The broadcast filters by shard, or None where they would be too large to send."""
    cells = stored(_filters(counts), "line-filters")
    size = cells.agg(F.sum(F.length("cells"))).first()[0] or 0
    if size > FILTER_BYTES:
        return None
    return spark.sparkContext.broadcast({r["shard"]: bytes(r["cells"]) for r in cells.collect()})


def drop_lines(docs: DataFrame, counts: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The rows of `docs` with `n_lines`, `n_dropped` and `kept` (the text without the lines it loses).

    A null or empty text is one empty line and keeps it. Other columns are handed on; of
    columns named n_lines, n_dropped or kept the new ones stay.
    """
    spark = docs.sparkSession
    counts = stored(counts, "line-counts")
    sent = _probe(spark, counts)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept", "_line_row", "_line_keys")]

    @F.pandas_udf("array<binary>")
    def suspects(texts: pd.Series) -> pd.Series:
        """Keys of a text that a filter may hold."""
        shards = None
        if sent is not None:
            shards = {s: CuckooFilter(1, np.frombuffer(c, np.uint16).reshape(-1, CuckooFilter.SLOTS)) for s, c in sent.value.items()}
        found = [list({_key_hash(x, min_chars) for x in (t or "").encode().split(b"\n")} - {None}) for t in texts]
        if shards is None:
            return pd.Series(found)
        every = [h for keys in found for h in keys]
        held = np.zeros(len(every), bool)
        if every:
            front = _front(every)
            shard = _shard(front)
            for s, cuckoo in shards.items():
                at = np.flatnonzero(shard == s)
                held[at] = cuckoo.might_hold(front[at])
        out, at = [], 0
        for keys in found:
            out.append([h for h, yes in zip(keys, held[at:at + len(keys)]) if yes])
            at += len(keys)
        return pd.Series(out)

    @F.pandas_udf("n_lines long, n_dropped long, kept string")
    def without(texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        rows = []
        for text, keys in zip(texts, lost):
            lines = (text or "").encode().split(b"\n")
            gone = set() if keys is None else {bytes(k) for k in keys}
            kept = [x for x in lines if _key_hash(x, min_chars) not in gone] if gone else lines
            rows.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept"])

    def finish(rows: DataFrame, lost) -> DataFrame:
        cut = rows.select(*names, without.asNondeterministic()("text", lost).alias("_line_cut"))
        return cut.select(*names, "_line_cut.n_lines", "_line_cut.n_dropped", "_line_cut.kept")

    probed = stored(docs.select(*names).withColumn("_line_row", F.monotonically_increasing_id())
                    .withColumn("_line_keys", F.when(F.col("doc_id").isNotNull(), suspects.asNondeterministic()("text"))), "line-suspects")
    lost = (probed.filter(F.size("_line_keys") > 0).select("_line_row", "doc_id", F.explode("_line_keys").alias("key"))
            .join(counts, "key").filter(F.col("doc_id") != F.col("keeper"))
            .groupBy("_line_row").agg(F.collect_list("key").alias("_line_lost")))
    none = F.lit(None).cast("array<binary>")
    touched = finish(probed.filter(F.size("_line_keys") > 0).join(lost, "_line_row", "left"), F.col("_line_lost"))
    return touched.unionByName(finish(probed.filter("_line_keys is null or size(_line_keys) = 0"), none))


def op8_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = drop_lines(docs, _reference_counts(references(docs), MIN_DOCS))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
