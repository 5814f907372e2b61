"""Token ids in files of directly addressable codes.

A file row is a block of whole documents. Its ids are split into 8-bit chunks: level 0 holds
the lowest chunk of every id, level k+1 the next chunk of those ids of level k that go on.
A bitmap per level marks which go on, and a rank directory holds the number of marks
before every 512 bits, so the place of any id on the next level is found by one lookup and one short
count. Any id, or range of ids, is read without decoding what stands before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerpulse.llm.common import stored, table
from ledgerpulse.llm.tokens import BATCH_TEXTS, tokenizer_path, worker_tokenizer

END_ID = 1
#: A block is closed once it holds so many ids.
BLOCK_IDS = 1 << 18
_STEP = 64  # bytes of bitmap per entry of the rank directory
_MAGIC = b"DAC1"
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint32)


def encode_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """Header, documents (valid, id, length), then chunks, bitmap and rank directory of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bitmap = np.packbits(more, bitorder="little")
        counts = np.add.reduceat(_BITS[bitmap], np.arange(0, len(bitmap), _STEP)) if len(bitmap) else np.zeros(0, np.uint32)
        ranks = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u4") if len(counts) else np.zeros(0, "<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bitmap.tobytes() + ranks.tobytes())
        if not more.any():
            break
        rest = rest[more] >> 8
    valid = np.array([d is not None for d in doc_ids], np.uint8).tobytes()
    keys = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    return b"".join([_MAGIC, struct.pack("<II", len(doc_ids), len(levels)), valid, keys, np.array(lengths, "<u8").tobytes(), *levels])


class Block:
    """Random access to a block of ids."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a block of token ids")
        n_docs, n_levels = struct.unpack_from("<II", data, 4)
        at = 12
        valid = np.frombuffer(data, np.uint8, n_docs, at)
        keys = np.frombuffer(data, "<i8", n_docs, at + n_docs)
        self.lengths = np.frombuffer(data, "<u8", n_docs, at + 9 * n_docs).astype(np.int64)
        self.doc_ids = [int(k) if v else None for k, v in zip(keys, valid)]
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        at += 17 * n_docs
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            width = (n + 7) // 8
            steps = (width + _STEP - 1) // _STEP
            self.levels.append((np.frombuffer(data, np.uint8, n, at + 8), np.frombuffer(data, np.uint8, width, at + 8 + n),
                                np.frombuffer(data, "<u4", steps, at + 8 + n + width)))
            at += 8 + n + width + 4 * steps

    def _rank(self, level: int, i: int) -> int:
        """Marks before place i."""
        chunks, bitmap, ranks = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        byte, step = i >> 3, (i >> 3) // _STEP
        part = int(_BITS[bitmap[step * _STEP:byte]].sum())
        return int(ranks[step]) + part + int(_BITS[int(bitmap[byte]) & ((1 << (i & 7)) - 1)])

    def __getitem__(self, i: int) -> int:
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * level)
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def ids(self, first: int, last: int, level: int = 0) -> np.ndarray:
        """The ids from `first` up to but without `last`."""
        chunks, bitmap, _ = self.levels[level]
        out = chunks[first:last].astype("<u4")
        if level + 1 < len(self.levels) and last > first:
            base = first >> 3
            more = np.unpackbits(bitmap[base:(last + 7) >> 3], bitorder="little")[first - 8 * base:last - 8 * base].astype(bool)
            if more.any():
                out[more] |= self.ids(self._rank(level, first), self._rank(level, last), level + 1) << np.uint32(8)
        return out


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = END_ID, drops_blanks: bool = True) -> DataFrame:
    """Encodes the documents in ascending doc_id and writes (shard, block, n_ids, data) to the shared folder.

    Shards follow the order of doc_id, null ids first; rows with the same doc_id are written one after
    the other. The range of a shard is chosen from (doc_id, row), so a repeated doc_id is spread as well.
    """
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())])
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        encoder = worker_tokenizer(tokenizer, drops_blanks)
        end = np.array([end_id], "<u4").tobytes()
        keys, parts, size = [], [], 0

        def close():
            ids = np.frombuffer(b"".join(parts), "<u4")
            data = encode_block(keys, [len(p) // 4 for p in parts], ids)
            return pa.RecordBatch.from_pydict({"shard": [shard], "block": [block], "n_ids": [len(ids)], "data": [data]}, schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                some = batch.slice(at, BATCH_TEXTS)
                for key, ids in zip(some.column(0).to_pylist(), encoder.ids(some.column(1).to_pylist())):
                    keys.append(key)
                    parts.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield close()
                        block, keys, parts, size = block + 1, [], [], 0
        if keys:
            yield close()

    ordered = (docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("_row"))
               .repartitionByRange(shards, "doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text"))
    return stored(ordered.mapInArrow(encode, "shard int, block int, n_ids long, data binary"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    spark = files.sparkSession
    totals = sorted((r["shard"], r["n"]) for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())  # a row per shard
    before, bases = 0, []
    for shard, n in totals:
        bases.append((shard, before))
        before += n
    base = spark.createDataFrame(bases, "shard int, base long")
    sizes = files.select("shard", "block", "n_ids").join(base, "shard")
    run = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", (F.col("base") + F.coalesce(F.sum("n_ids").over(run), F.lit(0))).alias("first"))
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("place", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = Block(data)
                n = len(block.doc_ids)
                sums = [zlib.crc32(block.ids(int(a), int(b)).tobytes()) for a, b in zip(block.starts, block.starts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(block.doc_ids, pa.int64()),
                    pa.array(block.starts[:-1], pa.int64()), pa.array(block.lengths, pa.int64()), pa.array(sums, pa.int64())], schema=schema)

    rows = files.select("shard", "block", "data").mapInArrow(
        decode, "shard int, block int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return rows.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op4_token_files(spark, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))
