"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton recognises every run of words of every item. Each document streams
through it once; the length of the longest run that ends at each word is tracked
by following suffix links, so the work is linear in the text. Runs of at least
`window` words are hits, and so is a whole item that is shorter. A document
whose hits cover `1/coverage` of its words is contaminated; its spans can be cut.

Items are read in blocks of at most `BLOCK_WORDS` words. One block, one automaton,
one pass over the documents; a usual benchmark is a single block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import WORD_BYTES, Sent, plain_words, stored, table

WINDOW = 13
COVERAGE = 20
#: Words of test items in one automaton; its size in memory follows from this.
BLOCK_WORDS = 300_000
_RUN = re.compile(rb"\S+")
_FOUND = "n_words long, hits array<struct<first: long, last: long>>, items array<string>, cleaned string"


class SuffixAutomaton:
    """All runs of words of a set of items; `window` is the shortest run that counts."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.windows: dict[tuple, set[str]] = defaultdict(set)
        ends: list[tuple[str, int, int]] = []
        for item, words in items:
            run = [self.ids.setdefault(w, len(self.ids)) for w in words]
            last = 0
            for word in run:
                last = self._extend(last, word)
            if 0 < len(run) < window:
                ends.append((item, len(run), tuple(run)))
            for i in range(len(run) - window + 1):
                self.windows[tuple(run[i:i + window])].add(item)
        # whole short items, by the state that stands for them
        self.short: dict[int, tuple[int, set[str]]] = {}
        for item, n, run in ends:
            state = 0
            for word in run:
                state = self.step[state][word]
            self.short.setdefault(state, (n, set()))[1].add(item)

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for (longest run of `state`) + word, cut out of a longer one where needed."""
        target = self.step[state][word]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = clone
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, {}, 0)
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def matches(self, words: list[bytes]) -> tuple[list[list[int]], set[str]]:
        """Merged spans [first, last] of hit words, and the items whose windows occur."""
        step, link, length, window, short = self.step, self.link, self.length, self.window, self.short
        spans: list[list[int]] = []
        items: set[str] = set()
        known = [self.ids.get(w, -1) for w in words]
        state = run = 0
        for at, word in enumerate(known):
            while state and word not in step[state]:
                state = link[state]
                run = length[state]
            if word not in step[state]:
                continue
            state = step[state][word]
            run += 1
            hit = 0
            if run >= window:
                hit = run
                items |= self.windows[tuple(known[at - window + 1:at + 1])]
            if short:
                suffix = state
                while suffix > 0:
                    if suffix in short and short[suffix][0] <= run:
                        hit = max(hit, short[suffix][0])
                        items |= short[suffix][1]
                    suffix = link[suffix]
            if hit:
                first = at - hit + 1
                while spans and spans[-1][1] >= first - 1:
                    first = min(first, spans.pop()[0])
                spans.append([first, at])
        return spans, items


def cut_spans(text: str, spans: list[list[int]]) -> str:
    """The text without the spans of words; what stands between other words stays."""
    raw = text.encode()
    places = [m.span() for m in _RUN.finditer(raw.translate(WORD_BYTES))]
    kept, at = [], 0
    for first, last in spans:
        kept.append(raw[at:places[first][0]])
        at = places[last][1]
    return b"".join([*kept, raw[at:]]).decode()


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").dropna().toLocalIterator():
        words = plain_words(text)
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append((item, words))
        size += len(words)
    yield block


def _finder(spark, block, window: int, clean: bool):
    automaton = Sent(spark, SuffixAutomaton(block, window))

    @F.pandas_udf(_FOUND)
    def find(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = plain_words(text)
            spans, items = automaton.value.matches(words)
            rows.append((len(words), [{"first": a, "last": b} for a, b in spans], sorted(items),
                         cut_spans(text, spans) if clean and text is not None else None))
        return pd.DataFrame(rows, columns=["n_words", "hits", "items", "cleaned"])

    return find.asNondeterministic()  # else a filter on the result would run it twice


def match_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, clean: bool = False) -> DataFrame:
    """The rows of `docs` with a column `found`: n_words, hits (spans of words), items, cleaned.

    Null or wordless texts have no words and no hits. Items without id, text or words are
    left out; repeated items count once. `cleaned` (the text without its spans) is filled
    on request; with several blocks of items it is cut from the text once more at the end.
    Other columns of `docs` are handed on; one named `found` is replaced.
    """
    spark = docs.sparkSession
    blocks = _blocks(benchmark)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.drop("found").withColumn("found", _finder(spark, first, window, clean)("text"))
    rows = stored(docs.drop("found").withColumn("_benchmark_row", F.monotonically_increasing_id()), "decontaminate")
    parts = None
    for block in [first, second]:
        part = rows.select("_benchmark_row", _finder(spark, block, window, False)("text").alias("f"))
        parts = part if parts is None else parts.unionByName(part)
    for block in blocks:
        parts = parts.unionByName(rows.select("_benchmark_row", _finder(spark, block, window, False)("text").alias("f")))
    merged = parts.groupBy("_benchmark_row").agg(
        F.max("f.n_words").alias("_n"), F.flatten(F.collect_list("f.hits")).alias("_hits"),
        F.array_distinct(F.flatten(F.collect_list("f.items"))).alias("_items"))

    @F.pandas_udf(_FOUND)
    def merge(texts: pd.Series, n_words: pd.Series, hits: pd.Series, items: pd.Series) -> pd.DataFrame:
        out = []
        for text, n, spans, names in zip(texts, n_words, hits, items):
            joined: list[list[int]] = []
            for a, b in sorted((h["first"], h["last"]) for h in spans):
                if joined and joined[-1][1] >= a - 1:
                    joined[-1][1] = max(joined[-1][1], b)
                else:
                    joined.append([a, b])
            out.append((n, [{"first": a, "last": b} for a, b in joined], sorted(names),
                        cut_spans(text, joined) if clean and text is not None else None))
        return pd.DataFrame(out, columns=["n_words", "hits", "items", "cleaned"])

    return (rows.join(merged, "_benchmark_row")
            .withColumn("found", merge.asNondeterministic()("text", "_n", "_hits", "_items"))
            .select(*[c for c in docs.columns if c != "found"], "found"))


def hit_words():
    """Number of hit words of `found`."""
    return F.aggregate("found.hits", F.lit(0).cast("long"), lambda n, h: n + h["last"] - h["first"] + 1)


def contaminated(coverage: int = COVERAGE):
    return (hit_words() > 0) & (hit_words() * coverage >= F.col("found.n_words"))


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Per document: words, hit words, items with occurring windows, and the verdict."""
    found = match_benchmark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), hit_words().alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))
