"""Hidden Markov language model over words, trained by Baum-Welch, and scored by the forward recursion.

Words are symbols: at most `VOCABULARY` of the most frequent training words (by steps of count), one symbol for the end of a
text and one for every other word. A rare word then also costs its own share of the rare symbol,
by add-one counts over all rare training words and one unseen word.

Expected counts of states, moves and symbols are computed by the workers over all training texts and
summed across partitions; a few numbers per state and symbol return to the driver. Texts of at most `WHOLE` symbols
go step by step together, longest first, each with one vector of states. A longer text is cut into
segments of `SEGMENT` symbols whose transfer matrices are multiplied; its segments then go together like texts. States are scaled every
few steps, so the likelihood of the whole text is exact and a long text costs no more per word.

Word counts stay a table: only the counts of the vocabulary are broadcast, rare words meet theirs in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerpulse.llm.common import Sent, blank_words, held_out, least_step, stored, table

VOCABULARY = 60_000
STATES = 4
ROUNDS = 3
#: Share with which a state follows itself before the first round.
STAY = 0.99
SEGMENT = 64
SMOOTHING = 1.0
#: Longer words are never symbols of their own, so the broadcast stays bounded.
SYMBOL_BYTES = 64
#: Distinct words a task holds before it hands its counts on.
HELD_WORDS = 100_000
#: Texts of more symbols than this are cut into segments.
WHOLE = 4096
#: Texts taken from a batch of rows at a time.
TEXTS = 4000
#: Steps after which a transfer matrix or a state is scaled; a step lowers it by some ten decimal places at most.
RESCALE = 4
#: Segments, or texts of as many symbols, worked on at a time.
BATCH = 4096
_ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, ids binary, base double, known long, rare map<binary, int>"


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over the column `text`, summed on the map side first."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(blank_words(text.as_py()))
                if len(counts) > HELD_WORDS:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    return texts.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class WordStatistics:
    """Totals of the training texts and the symbols: word -> (id, count)."""

    def __init__(self, counts: DataFrame, texts: int, size: int = VOCABULARY):
        n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("n")).first()
        self.ends = texts
        self.tokens, self.kinds = n + texts, v + (texts > 0)
        short = counts.filter(F.length("word") <= SYMBOL_BYTES)
        step, least = least_step(short, size)
        top = sorted(short.filter(step >= least).collect(), key=lambda r: (-r["n"], r["word"]))  # at most `size` rows
        self.symbols = {bytes(r["word"]): i for i, r in enumerate(top)}
        self.counts = np.array([r["n"] for r in top], np.int64)
        self.rare_tokens, self.rare_kinds = n - int(self.counts.sum()), v - len(top)
        self.end, self.rare = len(top), len(top) + 1

    def base(self, count):
        """log10 share of a word by add-one counts."""
        return np.log10((count + 1) / (self.tokens + self.kinds + 1))


def encode(docs: DataFrame, words: WordStatistics) -> DataFrame:
    """Per text: symbol ids (the end included), the base score of its symbols, and its rare words."""
    sent = Sent(docs.sparkSession, words)
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                        ("base", pa.float64()), ("known", pa.int64()), ("rare", pa.map_(pa.binary(), pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        shares = w.base(w.counts)
        end_share, end_known = w.base(w.ends), int(w.ends > 0)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                ids_of, base, known, sizes, rare = [], [], [], [], []
                for text in batch.column(3):
                    tokens = blank_words(text.as_py())
                    get = w.symbols.get
                    ids = np.fromiter(map(get, tokens, repeat(w.rare)), np.int64, len(tokens))
                    symbols = ids[ids != w.rare]
                    sizes.append(len(tokens) + 1)
                    ids_of.append(np.append(ids, w.end).astype("<u4" if w.rare > 0xFFFF else "<u2").tobytes())
                    base.append(float(shares[symbols].sum() + end_share))
                    known.append(len(symbols) + end_known)
                    rare.append(list(Counter([tokens[i] for i in np.flatnonzero(ids == w.rare).tolist()]).items()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()), pa.array(ids_of, pa.binary()),
                    pa.array(base, pa.float64()), pa.array(known, pa.int64()), pa.array(rare, pa.map_(pa.binary(), pa.int32()))], schema=schema)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "held_out", "text")
    return rows.mapInArrow(run, _ENCODED)


class HiddenMarkovModel:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (S), (S, S), (symbols, S)

    @classmethod
    def initial(cls, unigram: np.ndarray, states: int) -> "HiddenMarkovModel":
        """Near the unigram shares, each state leaning to its own part of the symbols.

        States stay with share `STAY`, so that a text is mostly told by one of them and states become kinds of texts.
        """
        lean = np.array([[xxhash.xxh32_intdigest(f"{k} {s}") for s in range(states)] for k in range(len(unigram))]) / 2.0 ** 32
        emit = unigram[:, None] * (0.25 + lean) ** 2
        move = np.full((states, states), (1 - STAY) / max(1, states - 1))
        np.fill_diagonal(move, STAY if states > 1 else 1.0)
        return cls(np.full(states, 1.0 / states), move, emit / emit.sum(0))

    def _segments(self, ids: list[np.ndarray]):
        """Padded symbols (pad -1) of all segments, owner of each, and whether it begins a text."""
        owners = np.repeat(np.arange(len(ids)), [(len(x) + SEGMENT - 1) // SEGMENT for x in ids])
        flat = np.full(len(owners) * SEGMENT, -1, np.int64)
        at = 0
        for x in ids:
            flat[at:at + len(x)] = x
            at += (len(x) + SEGMENT - 1) // SEGMENT * SEGMENT
        begins = np.ones(len(owners), bool)
        begins[1:] = owners[1:] != owners[:-1]
        return flat.reshape(-1, SEGMENT), owners, begins

    def _steps(self, symbols: np.ndarray, begins: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Emission weights of place t (1 for padding), and which rows are there."""
        there = symbols[:, t] >= 0
        e = self.emit[np.maximum(symbols[:, t], 0)]
        return e, there

    def _transfer(self, symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per segment the scaled matrix from the state before it to the state at its end, and the log of the scale.

        The first symbol of a text is not preceded by a move.
        """
        n, s = len(symbols), len(self.start)
        m = np.broadcast_to(np.eye(s), (n, s, s)).copy()
        log = np.zeros(n)
        for t in range(SEGMENT):
            e, there = self._steps(symbols, begins, t)
            if not there.any():
                break
            moved = (m.reshape(-1, s) @ self.move).reshape(n, s, s)
            if t == 0:
                moved[begins] = m[begins]
            moved *= e[:, None, :]
            m = moved if there.all() else np.where(there[:, None, None], moved, m)
            if t % RESCALE == RESCALE - 1:
                log += self._scaled(m)
        return m, log + self._scaled(m)

    @staticmethod
    def _scaled(m: np.ndarray) -> np.ndarray:
        """Divides each matrix by its sum, in place; the logs of the sums."""
        scale = m.sum((1, 2))
        m /= scale[:, None, None]
        return np.log(scale)

    def log10(self, ids: list[np.ndarray]) -> np.ndarray:
        """log10 likelihood of each symbol sequence."""
        out = np.zeros(len(ids))
        for group in _groups(ids):
            some, n = [ids[i] for i in group], len(group)
            if len(some[0]) > WHOLE:
                out[group] = self._log_in_segments(some)
            else:
                steps = _Steps(some)
                out[group[steps.order]] = self._forward(steps, np.ones(n, bool), np.tile(self.start, (n, 1)))[2]
        return out / np.log(10)

    def _log_in_segments(self, ids: list[np.ndarray]) -> np.ndarray:
        symbols, owners, begins = self._segments(ids)
        out = np.zeros(len(ids))
        state = self.start
        for at in range(0, len(symbols), BATCH):
            m, log = self._transfer(symbols[at:at + BATCH], begins[at:at + BATCH])
            for i in range(len(m)):
                j = at + i
                state = (self.start if begins[j] else state) @ m[i]
                total = state.sum()
                state = state / total
                out[owners[j]] += log[i] + np.log(total)
        return out

    def expected(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions over the sequences."""
        s = len(self.start)
        sums = np.zeros(s), np.zeros((s, s)), np.zeros_like(self.emit)
        for group in _groups(ids):
            some, n = [ids[i] for i in group], len(group)
            if len(some[0]) > WHOLE:
                self._expected_in_segments(some, *sums)
            else:
                self._within(some, np.ones(n, bool), np.tile(self.start, (n, 1)), np.ones((n, s)), *sums)
        return sums

    def _expected_in_segments(self, ids: list[np.ndarray], starts, moves, emits) -> None:
        s = len(self.start)
        symbols, owners, begins = self._segments(ids)
        n = len(symbols)
        ends = np.append(begins[1:], True)
        m = np.concatenate([self._transfer(symbols[at:at + BATCH], begins[at:at + BATCH])[0] for at in range(0, n, BATCH)])
        before, after = np.empty((n, s)), np.empty((n, s))  # states ahead of, and weights behind, each segment
        state = self.start
        for i in range(n):
            before[i] = self.start if begins[i] else state
            state = before[i] @ m[i]
            state /= state.sum()
        weight = np.ones(s)
        for i in range(n - 1, -1, -1):
            after[i] = np.ones(s) if ends[i] else weight
            weight = m[i] @ after[i]
            weight /= weight.sum()
        for at in range(0, n, BATCH):
            part = slice(at, at + BATCH)
            self._within([x[x >= 0] for x in symbols[part]], begins[part], before[part], after[part], starts, moves, emits)

    def _forward(self, steps: "_Steps", begins: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """States after each symbol, its emission weights, and the log likelihood of each sequence, in the order of `steps`.

        What a state is divided by every few steps is taken off the emission weights as well, so a state always is the one before it,
        moved, times the weights.
        """
        weights = self.emit[steps.symbols]
        states, log, one = np.empty_like(weights), np.zeros(len(steps.order)), np.ones(len(self.start))
        state = before
        for t, (at, end) in enumerate(steps.spans):
            moved = np.matmul(state[:end - at], self.move, out=states[at:end])
            if t == 0:
                moved[begins] = before[begins]
            moved *= weights[at:end]
            if t % RESCALE == RESCALE - 1:
                scale = moved @ one
                moved /= scale[:, None]
                weights[at:end] /= scale[:, None]
                log[:end - at] += np.log(scale)
            state = moved
        return states, weights, log + np.log(states[steps.last] @ one)

    def _within(self, ids: list[np.ndarray], begins, before, after, starts, moves, emits) -> None:
        """Adds the expected counts of pieces of texts, given the states ahead of and the weights behind each."""
        steps = _Steps(ids)
        begins, before, after = begins[steps.order], before[steps.order], after[steps.order]
        states, weights, _ = self._forward(steps, begins, before)
        after = after / (states[steps.last] * after).sum(1, keepdims=True)  # so that states times `behind` sum to 1 at every place
        behind, pairs, back = np.empty_like(states), np.zeros_like(self.move), np.ascontiguousarray(self.move.T)
        ahead = after[:0]  # weights of being in a state, its symbol included
        for t in range(len(steps.spans) - 1, -1, -1):
            at, end = steps.spans[t]
            here = behind[at:end]
            np.matmul(ahead, back, out=here[:len(ahead)])
            here[len(ahead):] = after[len(ahead):end - at]
            ahead = weights[at:end] * here
            if t:
                prior = steps.spans[t - 1][0]
                pairs += states[prior:prior + end - at].T @ ahead
            else:
                pairs += before[~begins].T @ ahead[~begins]
        moves += self.move * pairs
        states *= behind
        starts += states[:len(begins)][begins].sum(0)
        for k in range(len(self.start)):
            emits[:, k] += np.bincount(steps.symbols, weights=states[:, k], minlength=len(emits))


class _Steps:
    """Sequences laid out place by place, the longest first: those with a t-th symbol stand in `spans[t]`, always in the same order."""

    def __init__(self, ids: list[np.ndarray]) -> None:
        lengths = np.array([len(x) for x in ids])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        at = np.append(0, np.cumsum(np.searchsorted(-lengths, -np.arange(lengths[0]))))
        self.spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        rank = np.arange(len(ids))
        self.last = at[lengths - 1] + rank
        place = np.arange(at[-1]) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.symbols = np.empty(at[-1], np.int64)
        self.symbols[at[place] + np.repeat(rank, lengths)] = np.concatenate([ids[i] for i in self.order])


def _groups(ids: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Places of all sequences that are not empty, like lengths together, in groups of about BATCH * SEGMENT symbols, none on both sides of `WHOLE`."""
    lengths = np.array([len(x) for x in ids], np.int64)
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    group = (np.cumsum(lengths[order]) - 1) // (BATCH * SEGMENT)
    cuts = (np.diff(group) > 0) | np.diff(lengths[order] > WHOLE)
    return (part for part in np.split(order, np.flatnonzero(cuts) + 1) if len(part))


def _ids(data: bytes, wide: bool) -> np.ndarray:
    return np.frombuffer(data, "<u4" if wide else "<u2")


def train(encoded: DataFrame, words: WordStatistics, states: int = STATES, rounds: int = ROUNDS) -> HiddenMarkovModel:
    """Baum-Welch over all rows of `encoded`; without any, the initial model over end and rare symbol."""
    spark = encoded.sparkSession
    unigram = np.concatenate([words.counts, [words.ends, words.rare_tokens]]) + SMOOTHING
    unigram = unigram / unigram.sum()
    model = HiddenMarkovModel.initial(unigram, states)
    n, wide = len(unigram), words.rare > 0xFFFF
    names = [f"s{k}" for k in range(states)]
    schema = pa.schema([("symbol", pa.int64()), *((name, pa.float64()) for name in names)])
    for _ in range(rounds):
        sent = Sent(spark, model)

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros((n + states + 1, states))  # symbols, then moves, then starts
            for batch in batches:
                for at in range(0, batch.num_rows, TEXTS):
                    ids = [_ids(x.as_py(), wide) for x in batch.column(0).slice(at, TEXTS)]
                    if ids:
                        starts, moves, emits = sent.value.expected(ids)
                        total[:n] += emits
                        total[n:] += np.vstack([moves, starts])
            held = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), *(pa.array(x, pa.float64()) for x in total[held].T)], schema=schema)

        # at most states * (symbols + states + 1) sums come back
        sums = (encoded.select("ids").mapInArrow(count, ", ".join(["symbol long", *(f"{name} double" for name in names)]))
                .groupBy("symbol").agg(*(F.sum(name).alias(name) for name in names)).toPandas())
        total = np.zeros((n + states + 1, states))
        total[sums["symbol"]] = sums[names]
        emits, moves, starts = total[:n], total[n:-1] + SMOOTHING, total[-1]
        emits = emits + SMOOTHING * n * unigram[:, None] / 100
        model = HiddenMarkovModel((starts + SMOOTHING) / (starts + SMOOTHING).sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return model


def score(encoded: DataFrame, counts: DataFrame, words: WordStatistics, model: HiddenMarkovModel) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every encoded text."""
    sent, wide = Sent(encoded.sparkSession, model), words.rare > 0xFFFF
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("base", pa.float64()), ("known", pa.int64()), ("hmm", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                *others, ids = part.columns
                found = sent.value.log10([_ids(x.as_py(), wide) for x in ids])
                yield pa.RecordBatch.from_arrays([*others, pa.array(found, pa.float64())], schema=schema)

    likely = encoded.select("row", "doc_id", "held_out", "n_tokens", "base", "known", "ids").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, base double, known long, hmm double")
    n = F.coalesce("n", F.lit(0))
    uses = encoded.select("row", F.explode("rare").alias("word", "uses"))
    rare = (uses.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("uses"))).alias("rare_known"),
        F.sum(F.col("uses") * F.log10((n + 1.0) / (words.tokens + words.kinds + 1.0))).alias("rare_base"),
        F.sum(F.col("uses") * F.log10((n + 1.0) / (words.rare_tokens + words.rare_kinds + 1.0))).alias("rare_share")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return likely.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("rare_known")).alias("n_known"),
        F.lit(int(words.tokens)).cast("long").alias("train_tokens"), (F.col("base") + zero("rare_base")).alias("base_score"),
        (F.col("hmm") + zero("rare_share")).alias("score"))


def score_documents(docs: DataFrame, vocabulary: int = VOCABULARY, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Scores the texts of `docs` (doc_id, text, held_out), learning from those that are not held out.

    A null or empty text is the end alone. Rows with the same doc_id are separate texts. Without
    training texts every word is unseen. Other columns are not handed on.
    """
    learnt = docs.filter("not held_out")
    counts = stored(count_words(learnt), "word-counts")
    words = WordStatistics(counts, learnt.count(), vocabulary)
    encoded = stored(encode(docs, words), "word-symbols")
    model = train(encoded.filter("not held_out"), words, states, rounds)
    return score(encoded, counts, words, model)


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out(7, 2).alias("held_out"))
    return score_documents(docs)
