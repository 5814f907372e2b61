"""Hierarchical best-fit packing of documents into sequences of bounded length.

Level 0 deals the pieces to groups of bounded size and packs each group by best fit, longest
piece first. Bins with little room left are final. The others go on as single items to the
next level, dealt anew to fewer groups, until one group is left or a level no longer helps.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import stored, table
from ledgerpulse.llm.tokens import tokenizer_path, worker_tokenizer

CAPACITY = 2048
END_ID = 0
#: Rows that one task packs at a time.
GROUP_ROWS = 50_000
#: A bin with at most this share of its room left is final.
NEARLY_FULL = 0.01
_PIECE = "array<struct<piece: int, start: long, length: long, ids_crc32: long>>"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, into the open bin with the least room that fits."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin with room r is open
    count = 0
    for at, size in zip(order.tolist(), sizes[order].tolist()):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, count
            count += 1
        bins[at], offsets[at] = chosen, capacity - room
        left = room - size
        by_room[left].append(chosen)
        rooms |= 1 << left
    return bins, offsets


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32. Of a long document the first piece is the short one."""
    @F.pandas_udf(_PIECE)
    def pieces(texts: pd.Series) -> pd.Series:
        out = []
        end = np.array([end_id], "<u4").tobytes()
        for ids in worker_tokenizer(tokenizer, drops_blanks=False).ids(texts.tolist()):
            ids += end
            n = len(ids) // 4
            starts = [0, *range(n % capacity or capacity, n, capacity)]
            ends = [*starts[1:], n]
            out.append([{"piece": k, "start": a, "length": b - a, "ids_crc32": zlib.crc32(ids[4 * a:4 * b])}
                        for k, (a, b) in enumerate(zip(starts, ends))])
        return pd.Series(out)

    return docs.select("doc_id", F.explode(pieces("text")).alias("p")).select("doc_id", "p.*")


def _pack_level(level: int, capacity: int, last: bool):
    room_left = 0 if last else int(capacity * NEARLY_FULL)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.drop_duplicates("bin")
        bins, offsets = best_fit(first["fill"].to_numpy(np.int64), capacity)
        place = pd.Series(np.arange(len(first)), index=first["bin"])[rows["bin"]].to_numpy()
        fills = np.bincount(bins, weights=first["fill"].to_numpy()).astype(np.int64)
        group = int(rows["group"].iloc[0])
        return pd.DataFrame({
            "row": rows["row"].to_numpy(), "offset": rows["offset"].to_numpy() + offsets[place],
            "bin": (level << 56) + (group << 24) + bins[place], "fill": fills[bins[place]],
            "done": last | (fills[bins[place]] >= capacity - room_left)})

    return pack


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(row, bin, offset) of items (row: unique long, length: 1 to capacity)."""
    full = items.filter(F.col("length") == capacity).select("row", (-1 - F.col("row")).alias("bin"), F.lit(0).cast("long").alias("offset"))
    open_rows = items.filter(F.col("length") < capacity).select(
        "row", F.lit(0).cast("long").alias("offset"), F.col("row").alias("bin"), F.col("length").cast("long").alias("fill"))
    result, level, before = full, 0, None
    while True:
        n = open_rows.count()
        groups = max(1, ceil(n / GROUP_ROWS))
        last = groups == 1 or before is not None and n > 0.9 * before
        packed = stored(
            open_rows.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(level)), F.lit(groups)))
            .groupBy("group").applyInPandas(
                _pack_level(level, capacity, last), "row long, offset long, bin long, fill long, done boolean"), f"pack-{level}")
        result = result.unionByName(packed.filter("done").select("row", "bin", "offset"))
        if last:
            return result
        open_rows, before, level = packed.filter("not done").drop("done"), n, level + 1


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    A null or empty text is the end id alone. Rows with the same doc_id, or without one,
    are separate documents. An empty table gives no rows. Other columns are not handed on.
    """
    pieces = cut_documents(docs, tokenizer, end_id, capacity)
    numbered = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    places = pack(numbered.select("row", "length"), capacity)
    return numbered.join(places, "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
