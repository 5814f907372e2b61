import hashlib
import random
import zlib

import numpy as np
import pytest

from cases import ROWS, documents, tables
from ledgerpulse.llm import periodic_runs
from ledgerpulse.llm.periodic_runs import find_runs, op12_periodic_runs, runs_of


def brute(words, shortest=6, periods=4):
    """All maximal runs by trying every period at every start."""
    n, found = len(words), set()
    for q in range(1, n // periods + 1):
        same = [words[i] == words[i + q] for i in range(n - q)]
        i = 0
        while i < len(same):
            if not same[i]:
                i += 1
                continue
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + q
            if length >= max(shortest, periods * q):
                stretch = words[i:i + length]
                if all(any(stretch[x] != stretch[x + p] for x in range(length - p)) for p in range(1, q)):
                    found.add((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def rearranged(doc, words):
    h = zlib.crc32(str(doc).encode())
    n = len(words)
    if doc is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc, text):
    words = rearranged(doc, (text or "").encode().split())
    runs = brute(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    words: list[int] = []
    while len(words) < 150:
        part = [draw.randint(0, draw.choice([1, 2, 30])) for _ in range(draw.randint(1, 12))]
        words += part * draw.randint(1, 7) + part[:draw.randint(0, len(part))]
    assert runs_of(np.array(words)) == brute(words)


@pytest.mark.parametrize("words", [[], [1], [1] * 5, [1] * 6, [1, 2] * 3, [1, 2] * 4, [1, 2, 1, 1, 2, 1, 1, 2, 1, 1, 2, 1], list(range(50)), [3] * 1000])
def test_small_arrays(words):
    assert runs_of(np.array(words, np.int64)) == brute(words)


def test_query_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 50)
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice("abcdefghij") for _ in range(draw.randint(0, 60))), "en") for i in range(120)]
    rows += [(200, "x " * 500, "en"), (201, "A a " * 9 + "\x1c  b", "en"), (201, "A a " * 9 + "\x1c  b", "en"), (-3, "ab cd " * 40, None)]
    rows += [r for r in ROWS if r[1] is None or len(r[1]) < 500]
    folder = tables(tmp_path, documents=documents(spark, rows))
    mine = sorted((tuple(r) for r in op12_periodic_runs(spark, folder).collect()), key=str)
    assert mine == sorted((expected(i, t) for i, t, _ in rows), key=str)


def test_columns_are_handed_on_and_long_texts_are_whole(spark):
    rows = [(0, "la " * 70_000 + "end", "en"), (1, None, None)]
    found = find_runs(documents(spark, rows)).orderBy("doc_id").collect()
    assert [(r["start"], r["length"], r["period"]) for r in found[0]["runs"]] == [(0, 70_000, 1)]
    assert found[0]["collapsed"] == "la end" and found[1]["collapsed"] == "" and found[0]["score"] == "clash"
    assert find_runs(documents(spark, rows).limit(0)).collect() == []
