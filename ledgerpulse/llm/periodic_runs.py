"""Periodic runs of words by a dictionary of basic factors.

For every power of two F the stretches of F words (basic factors) get names: equal names, equal words. A name
of 2F words is the pair of its halves' names, so only places whose factor occurs again are carried to the next level.
The next occurrence of a factor within twice its length tells a distance; places in a row with the same distance
form an arithmetic progression and propose it as a period. A factor at least as long as the period of a run occurs
there every period and nowhere between, so periods above F / 2 and up to F are taken from the level F: one level per period, and each
is the smallest of its run. Proposals are extended to both sides, word by word of the same distance, and equal ones met once.

Documents are worked on in batches: their words stand in one array with a different number between any two documents,
which no factor can span and come again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import table

#: A run has at least so many words, and so many times its period.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words worked on at a time; a longer document is worked on alone.
BATCH_WORDS = 400_000


def _next_same(names: np.ndarray) -> np.ndarray:
    """For names in the order of their places: index of the next equal name, -1 if there is none."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    following = np.full(len(names), -1, np.int64)
    following[order[:-1][same]] = order[1:][same]
    return following


def _proposals(words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: first and last place and distance of the progressions of successors."""
    places, names, size, total = np.arange(len(words)), words, 1, len(words)
    while len(places) > 1:
        following = _next_same(names)
        again = following >= 0
        apart = np.where(again, places[following] - places, 0)
        near = again & (apart <= 2 * size)
        usable = near & (apart <= size) & (2 * apart > size)  # others are met one level below or above
        at, distance = places[usable], apart[usable]
        if len(at):
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(distance) != 0)) + 1
            begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]]) - 1
            yield at[begin], at[end] + size + distance[end] - 1, distance[begin]
        # a longer factor comes again only where both of its halves do
        known = again.copy()
        known[following[again]] = True
        name_at = np.full(total + size, -1, np.int64)
        _, dense = np.unique(names[known], return_inverse=True)
        name_at[places[known]] = dense
        first = places[known]
        second = name_at[np.minimum(first + size, total)]
        whole = second >= 0
        places = first[whole]
        names = name_at[places] * np.int64(len(words) + 1) + second[whole]
        size *= 2


def _extend(words: np.ndarray, place: int, distance: int, step: int) -> int:
    """How many words from `place` on, in the direction of `step`, equal those `distance` before them (or behind)."""
    n, width, count = len(words), 16, 0
    while True:
        if step > 0:
            a = words[place + count:place + count + width]
            b = words[place + count - distance:place + count - distance + len(a)]
        else:
            stop = place - count + 1
            a = words[max(0, stop - width):max(0, stop)][::-1]
            b = words[max(0, stop - width) + distance:max(0, stop) + distance][::-1]
        if not len(a):
            return count
        differ = np.flatnonzero(a != b)
        if len(differ):
            return count + int(differ[0])
        count += len(a)
        if count > n:
            return count
        width *= 2


def runs_of(words: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs of the array, by start and period."""
    found = set()
    for first, last, distance in _proposals(words):
        for a, b, d in zip(first.tolist(), last.tolist(), distance.tolist()):
            right = _extend(words, b + 1, d, 1)
            left = _extend(words, a - 1, d, -1)
            start, length = a - left, b + right - (a - left) + 1
            if length >= max(min_words, min_periods * d):
                found.add((start, length, d))
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted_order(doc_id: int | None, n: int) -> np.ndarray:
    """Which of the n words stands at each place: some documents, by the hash of their id, repeat a stretch to their end."""
    at = np.arange(n)
    if doc_id is None or n == 0:
        return at
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return at
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at[a:] = a + (at[a:] - a) % p
    return at


def kept_places(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for words that some run holds behind its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


_SCHEMA = pa.schema([("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])


def _batch_runs(texts: list[tuple[list[bytes], np.ndarray]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each (words, order of the places) of a batch."""
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    parts, starts, size = [], [], 0
    for i, (words, order) in enumerate(texts):
        own = np.fromiter((number(w, len(numbers)) for w in words), np.int64, len(words))[order]
        starts.append(size)
        parts += [own, np.array([-1 - i])]
        size += len(own) + 1
    joined = np.concatenate(parts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in runs_of(joined):
        i = int(np.searchsorted(starts, start, side="right")) - 1
        out[i].append((start - starts[i], length, period))
    return out


def find_runs(docs: DataFrame, planted: bool = False) -> DataFrame:
    """The rows of `docs` without text, with `runs` (start, length, period; by start, period) and `collapsed`.

    Words stand between blanks of ASCII. `collapsed` has the words joined by one space, without those that
    some run holds behind its first period. `planted` first repeats a stretch of some documents, by doc_id. Null, empty and
    blank texts have no runs and collapse to nothing. Rows are worked on one by one, so repeated ids and rows
    change nothing; other columns are handed on, those named like the new ones or `text` are replaced. A text needs
    memory of a few dozen bytes per word in its task, however long it is.
    """
    others = [c for c in docs.columns if c not in ("text", "runs", "collapsed")]
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("kept")
    rows = docs.select(kept, F.col("text").alias("text"), (F.col("doc_id").cast("long") if planted else F.lit(None).cast("long")).alias("id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, size = 0, [], 0
            for i in range(batch.num_rows + 1):
                if held and (i == batch.num_rows or size >= BATCH_WORDS):
                    found, collapsed = _batch_runs(held), []
                    for (words, order), runs in zip(held, found):
                        stay = order[kept_places(len(order), runs)]
                        collapsed.append(b" ".join([words[k] for k in stay.tolist()]))
                    lists = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(held)), pa.array(lists, _SCHEMA.field(0).type), pa.array(collapsed, pa.binary())],
                                                     names=["kept", "runs", "collapsed"])
                    begin, held, size = i, [], 0
                if i < batch.num_rows:
                    text = batch.column(1)[i].as_py()
                    words = text.encode().split() if text else []
                    held.append((words, planted_order(batch.column(2)[i].as_py(), len(words))))
                    size += len(words)

    kinds = f"kept {rows.schema['kept'].dataType.simpleString()}, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
    found = rows.mapInArrow(run, kinds)
    return found.select(*[F.col(f"kept.`{c}`").alias(c) for c in others], "runs", F.col("collapsed").cast("string").alias("collapsed"))


def longest_run():
    """The run with the greatest length, then the smallest start, then the smallest period; null without runs."""
    return F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("finer"))))


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Per document its runs, the longest of them, and digests of all runs and of the collapsed text."""
    found = find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted=True)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", longest_run()).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.finer")).alias("period"), F.expr("best.length * 1000 div -best.finer").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
