"""Document fingerprints by a randomised edit embedding.

Shared random bits drive a walk over the characters of a text: at every step the current
character is written, then a bit that depends on the character and the step tells whether the
walk moves on. After an edit two walks meet again after a while, so texts at a small edit distance agree at
most steps: edit distance becomes Hamming distance. The random bits repeat after `PERIOD` steps.

A fingerprint samples steps: `SAMPLES` of each octave [2^k, 2^(k+1)), the same for every text,
one bit each, behind the number of steps walked. Bands of sampled bits find candidates, the
share of equal bits, weighted by the steps an octave stands for, verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import components, stored, table, worker_memory

PERIOD = 4096
CLASSES = 64
SAMPLES = 128
BAND_BITS = 16
LEADER_ROUNDS = 3
_PAD = 0x110000  # stands behind the end of a text
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xBF58476D1CE4E5B9)


def _stays(kind: int) -> list[int]:
    """For each step of the period: how many steps a character of this class is written before the walk moves on."""
    bits = np.array([xxhash.xxh32_intdigest(f"{kind} {j}") & 1 for j in range(PERIOD)])
    ones = np.flatnonzero(bits)
    ones = np.append(ones, ones[0] + PERIOD)
    steps = np.arange(PERIOD)
    return (ones[np.searchsorted(ones, steps)] - steps + 1).tolist()


class _Tables(dict):
    def __missing__(self, char: str) -> list[int]:
        kind, known = xxhash.xxh32_intdigest(char) % CLASSES, worker_memory("stays")
        if kind not in known:
            known[kind] = _stays(kind)
        if len(self) > 100_000:
            self.clear()
        self[char] = known[kind]
        return known[kind]


_tables = _Tables()


def _sampled(octave: int) -> np.ndarray:
    """Sorted steps sampled from an octave; octave 0 begins at step 0."""
    known = worker_memory("sampled steps")
    if octave not in known:
        known[octave] = _draw(octave)
    return known[octave]


def _draw(octave: int) -> np.ndarray:
    low, high = (0, 2) if octave == 0 else (1 << octave, 1 << (octave + 1))
    if high - low <= SAMPLES:
        return np.resize(np.arange(low, high), SAMPLES)
    draws = [low + xxhash.xxh64_intdigest(f"{octave} {i}") % (high - low) for i in range(SAMPLES)]
    return np.array(sorted(draws))


class Walk:
    """Steps at which each character of a text is first written; can go on from a common beginning."""

    def __init__(self, text: str, begun: "Walk | None" = None, shared: int = 0):
        if begun is None or shared == 0:
            starts, step, rest = [], 0, text
        else:
            starts, rest = begun.starts[:shared], text[shared:]
            step = begun.starts[shared] if shared < len(begun.starts) else begun.end
        add, mask = starts.append, PERIOD - 1
        for stays in map(_tables.__getitem__, rest):
            add(step)
            step += stays[step & mask]
        self.text, self.starts, self.end = text, starts, step

    def fingerprint(self) -> str:
        if not self.end:
            return "0:"
        octaves = max(self.end - 1, 1).bit_length()
        steps = np.concatenate([_sampled(k) for k in range(octaves)])
        at = np.searchsorted(np.array(self.starts), steps, side="right") - 1
        codes = np.frombuffer(self.text.encode("utf-32-le"), "<u4")
        chars = np.where(steps < self.end, codes[at], _PAD).astype(np.uint64)
        mixed = (chars * _K1 ^ steps.astype(np.uint64) * _K2) * _K3
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _K1
        return f"{self.end:x}:" + np.packbits((mixed >> np.uint64(63)).astype(np.uint8)).tobytes().hex()


def _octaves(fingerprint: str) -> tuple[int, list[str]]:
    end, _, digits = fingerprint.partition(":")
    width = SAMPLES // 4
    return int(end, 16), [digits[i:i + width] for i in range(0, len(digits), width)]


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, about 0 for unrelated ones: equal bits beyond the half that agree by chance."""
    if a == b:
        return 1.0
    (end_a, one), (end_b, two) = _octaves(a), _octaves(b)
    end = max(end_a, end_b)
    agreed = total = 0.0
    for k in range(max(len(one), len(two))):
        low = 0 if k == 0 else 1 << k
        weight = min(end, 1 << (k + 1)) - low
        total += weight
        if k < len(one) and k < len(two):
            equal = SAMPLES - (int(one[k], 16) ^ int(two[k], 16)).bit_count()
            agreed += weight * max(0.0, 2 * equal / SAMPLES - 1)
    return agreed / total


def bands(fingerprint: str) -> list[str]:
    """Keys of `BAND_BITS` neighbouring sampled bits in the two last octaves that the walk fills."""
    end, octaves = _octaves(fingerprint)
    filled = [k for k in range(len(octaves)) if 1 << (k + 1) <= end][-2:] or list(range(len(octaves)))
    width = BAND_BITS // 4
    return [f"{k}.{i}.{octaves[k][i:i + width]}" for k in filled for i in range(0, SAMPLES // 4, width)]


def edited_text(text: str, following: str) -> str:
    """The last half of the characters replaced by as many first ones (or all) of the text that follows."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, shared_bands int"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _row(doc_id, text: str, walk: Walk, mark: str, following: str, next_mark: str) -> dict:
    edited = edited_text(text, following)
    edited_mark = mark if edited == text else Walk(edited, walk, len(text) - len(text) // 2).fingerprint()
    return dict(zip(_NAMES, (
        doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark, likeness(mark, edited_mark),
        likeness(mark, next_mark), len(set(bands(mark)) & set(bands(edited_mark))))))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, which borrows from the next document by doc_id.

    Documents are ordered by (doc_id, row), null ids first; a null text is empty and has the fingerprint
    `0:`; a single document follows itself. Each range of ids is walked in one stream with one
    document looked ahead; the last document of a range is completed from the first of the next one.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _ROW.split(", ")]
                       + [("range", pa.int32()), ("first", pa.string()), ("last", pa.string())])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size, held = TaskContext.get().partitionId(), [], 0, None

        def full(row: dict) -> dict:
            return dict.fromkeys(schema.names) | row

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                doc_id, text = doc_id.as_py(), text.as_py()
                walked = Walk(text)
                mark = walked.fingerprint()
                if held is None:
                    rows.append(full({"range": number, "first": text}))
                else:
                    rows.append(full(_row(*held, text, mark)))
                held = (doc_id, text, walked, mark)
                size += 1
                if size % 1000 == 0:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if held:
            rows.append(full({"range": number, "last": held[1], "doc_id": held[0]}))
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ordered = (docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
               .repartitionByRange(ranges, "doc_id", "_row").sortWithinPartitions("doc_id", "_row").select("doc_id", "text"))
    found = stored(ordered.mapInArrow(walk, _ROW + ", range int, first string, last string"), "fingerprints")
    filled = sorted(r["range"] for r in found.filter("first is not null").select("range").collect())  # one number per range
    order = spark.createDataFrame(list(zip(filled, filled[1:] + filled[:1])), "range int, next int")
    heads = found.filter("first is not null").select(F.col("range").alias("next"), F.col("first").alias("following"))
    ends = found.filter("last is not null").select("range", "doc_id", F.col("last").alias("text")).join(order, "range").join(heads, "next")

    @F.pandas_udf(_ROW)
    def complete(texts: pd.Series, following: pd.Series) -> pd.DataFrame:
        rows = []
        for text, after in zip(texts, following):
            walked = Walk(text)
            rows.append(_row(None, text, walked, walked.fingerprint(), after, Walk(after).fingerprint()))
        return pd.DataFrame(rows, columns=_NAMES)

    last = ends.select("doc_id", complete("text", "following").alias("r")).select("doc_id", *[f"r.{c}" for c in _NAMES[1:]])
    return found.filter("range is null").select(*_NAMES).unionByName(last)


def near_pairs(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, other, near): links between rows that share a band and are verified, and between copies.

    Rows of one fingerprint are a class, linked to its smallest row; classes are compared. Every two classes of a band
    end up compared or in one component, so the links hold together what all verified pairs would. First each class
    meets a changing leader per band, so that large groups join through few pairs; then every pair of a band that
    is still in two components is verified. Rows without doc_id are left out; rows of a repeated doc_id are separate.
    """
    @F.pandas_udf("string")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([Walk(t or "").fingerprint() for t in texts])

    @F.pandas_udf("array<string>")
    def keys(marks: pd.Series) -> pd.Series:
        return marks.map(bands)

    @F.pandas_udf("double")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    rows = stored(docs.filter("doc_id is not null").select(F.monotonically_increasing_id().alias("row"), "doc_id", mark("text").alias("mark")), "marks")
    first = rows.groupBy("mark").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    classes = stored(first.select("mark", F.col("first.row").alias("node"), F.col("first.doc_id").alias("other")), "mark-classes")
    copies = rows.join(classes, "mark").filter("row <> node").select("doc_id", "other", F.lit(1.0).alias("near"))
    banded = stored(classes.select("node", F.xxhash64("mark").alias("h"), F.explode(keys("mark")).alias("band")), "mark-bands")

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        one = classes.select(F.col("node").alias("a"), F.col("other").alias("x"), F.col("mark").alias("mark_a"))
        two = classes.select(F.col("node").alias("b"), F.col("other").alias("y"), F.col("mark").alias("mark_b"))
        near = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y", alike.asNondeterministic()("mark_a", "mark_b").alias("near"))
        return stored(near.filter(F.col("near") >= least), "mark-links")

    links = None
    joined = banded.withColumn("c", F.col("node"))
    for turn in range(LEADER_ROUNDS):
        leaders = (joined.groupBy("band").agg(F.min(F.struct(F.xxhash64("h", F.lit(turn)).alias("p"), "node", "c")).alias("l"))
                   .select("band", F.col("l.node").alias("b"), F.col("l.c").alias("c_b")))
        found = verified(joined.join(leaders, "band").filter("c <> c_b").select(F.col("node").alias("a"), "b"))
        links = found if links is None else links.unionByName(found)
        joined = (banded.join(stored(components(links.select("a", "b")), "mark-components"), "node", "left")
                  .select("node", "h", "band", F.coalesce("component", "node").alias("c")))
    open_bands = joined.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high")).filter("low < high").select("band")
    rest = joined.join(open_bands, "band").select("band", F.col("node").alias("a"), F.col("c").alias("c_a"))
    other = rest.select("band", F.col("a").alias("b"), F.col("c_a").alias("c_b"))
    links = links.unionByName(verified(rest.join(other, "band").filter("c_a < c_b").select("a", "b")))
    return links.select(F.greatest("x", "y").alias("doc_id"), F.least("x", "y").alias("other"), "near").unionByName(copies)


def op5_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
