from collections import defaultdict

import numpy as np

from cases import LINE, ROWS, documents
from ledgerpulse.llm import line_dedup
from ledgerpulse.llm.line_dedup import CuckooFilter, LineIndex


def brute_force(rows, least=3):
    holders = defaultdict(list)
    for i, (doc, text, _) in enumerate(rows):
        for key in {x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for x in (text or "").split("\n")}:
            if doc is not None and len(key) >= 20:
                holders[key].append(doc)
    out = []
    for doc, text, _ in rows:
        lines = (text or "").split("\n")
        key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
        gone = [doc is not None and len(holders[key(x)]) >= least and max(holders[key(x)]) != doc for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(map(str, out))


def _result(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "n_lines", "n_dropped", "kept").collect())


def test_against_brute_force(spark):
    docs = documents(spark)
    assert _result(LineIndex(spark).insert(docs).dedup(docs)) == brute_force(ROWS)


def test_without_filters_the_result_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", -1)
    docs = documents(spark)
    assert _result(LineIndex(spark).insert(docs).dedup(docs)) == brute_force(ROWS)


def test_insert_and_delete_are_reversible(spark):
    some, more = ROWS[:6], [(20, LINE, "en"), (21, f"{LINE}\nand more", "en")]
    a, b = documents(spark, some), documents(spark, more)
    both = LineIndex(spark).insert(a).insert(b)
    assert _result(both.dedup(a.unionByName(b))) == brute_force(some + more)
    assert _result(both.delete(b).dedup(a)) == brute_force(some)


def test_empty_table(spark):
    docs = documents(spark, [])
    assert LineIndex(spark).insert(docs).dedup(docs).count() == 0


def test_cuckoo_filter_has_no_false_negatives_and_deletes():
    keys = np.random.default_rng(1).integers(0, 2 ** 63, 5000).astype(np.uint64)
    made = CuckooFilter.of(keys)
    assert made.might_hold(keys).all()
    assert made.might_hold(np.arange(10_000, dtype=np.uint64) * np.uint64(7919 << 30)).mean() < 0.01
    assert all(made.delete(int(k)) for k in keys[:2500])
    assert made.might_hold(keys[2500:]).all() and made.might_hold(keys[:2500]).mean() < 0.05


def test_a_filter_of_equal_keys_grows():
    assert CuckooFilter.of(np.unique(np.full(3, 9, np.uint64))).might_hold(np.array([9], np.uint64)).all()
