import hashlib
import random

import pytest

from cases import ROWS, documents
from ledgerpulse.llm.fingerprints import Walk, bands, edited_text, fingerprint_documents, likeness, near_pairs


def _text(draw, n):
    return "".join(draw.choice("abcdefghij klmno\n") for _ in range(n))


@pytest.mark.parametrize("n", [1, 5, 100, 3000])
def test_equal_texts_have_equal_fingerprints_and_a_walk_can_go_on(n):
    text = _text(random.Random(n), n)
    assert Walk(text).fingerprint() == Walk(text).fingerprint()
    for shared in {0, n // 2, n - 1}:
        other = text[:shared] + "xyz" + text[shared:]
        assert Walk(other, Walk(text), shared).fingerprint() == Walk(other).fingerprint()


def test_few_edits_stay_near_and_other_texts_do_not():
    draw = random.Random(1)
    near, far = [], []
    for _ in range(20):
        text = _text(draw, 2000)
        at = draw.randrange(2000)
        near.append(likeness(Walk(text).fingerprint(), Walk(text[:at] + "Q" + text[at + 1:]).fingerprint()))
        far.append(likeness(Walk(text).fingerprint(), Walk(_text(draw, 2000)).fingerprint()))
    assert min(near) > max(far) and sum(near) / 20 > 0.85 and sum(far) / 20 < 0.2
    assert likeness("0:", "0:") == 1.0 and likeness("0:", Walk("abc").fingerprint()) == 0.0
    assert bands("0:") == []


def brute_force(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for (doc, text, _), (_, after, _) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        edited = text[:len(text) - len(text) // 2] + after[:len(text) // 2]
        a, b, c = (Walk(t).fingerprint() for t in (text, edited, after))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    return sorted(map(str, out))


@pytest.mark.parametrize("rows", [ROWS, ROWS[3:4], []])
def test_documents_against_brute_force(spark, rows):
    found = fingerprint_documents(documents(spark, rows)).drop("shared_bands").collect()
    assert sorted(str(tuple(r)) for r in found) == brute_force(rows)


def test_edited_text():
    assert edited_text("abcde", "XYZ") == "abcXY" and edited_text("abcdef", "X") == "abcX" and edited_text("", "X") == ""


def test_near_pairs_finds_planted_copies(spark):
    draw = random.Random(2)
    base = _text(draw, 3000)
    rows = [(i, _text(draw, 3000), "en") for i in range(20)] + [(100, base, "en"), (101, base[:50] + "!" + base[51:], "en"), (102, base, "en"), (103, None, "en")]
    pairs = {(r["doc_id"], r["other"]) for r in near_pairs(documents(spark, rows)).collect()}
    assert pairs == {(101, 100), (102, 100)}


def _joined(pairs):
    """Components of two members or more."""
    groups = {}
    for a, b in pairs:
        one = groups.get(a, {a}) | groups.get(b, {b})
        groups |= dict.fromkeys(one, one)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


def test_near_pairs_behind_a_smaller_document_that_is_not_near(spark):
    draw = random.Random(3)
    text = _text(draw, 3900)
    walk = Walk(text)
    cut = next(i for i, step in enumerate(walk.starts) if step > 4200)  # behind all bands
    decoy, edited = text[:cut] + _text(draw, 3900 - cut), text[:3800] + "!" + text[3801:]
    a, b, c = (Walk(t).fingerprint() for t in (decoy, text, edited))
    assert 4096 < Walk(decoy).end < 8192 and set(bands(a)) == set(bands(b)) == set(bands(c))
    assert max(likeness(a, b), likeness(a, c)) < 0.8 <= likeness(b, c)
    found = near_pairs(documents(spark, [(1, decoy, "en"), (2, text, "en"), (3, edited, "en")]))
    assert {(r["doc_id"], r["other"]) for r in found.collect()} == {(3, 2)}


def test_near_pairs_keep_rows_of_a_repeated_id_apart(spark):
    draw = random.Random(4)
    one, two = _text(draw, 2000), _text(draw, 2000)
    rows = [(7, one, "en"), (7, two, "en"), (9, two[:1900] + "!" + two[1901:], "en"), (10, one[:1900] + "!" + one[1901:], "en")]
    assert sorted((r["doc_id"], r["other"]) for r in near_pairs(documents(spark, rows)).collect()) == [(9, 7), (10, 7)]


def test_near_pairs_join_what_all_verified_pairs_join(spark):
    draw = random.Random(5)
    rows = [(i, _text(draw, 1500), "en") for i in range(5)]
    for family in range(4):
        text = _text(draw, 1500)
        for i in range(8):
            rows.append((draw.randrange(10 ** 6), text, "en"))
            for at in draw.sample(range(1500), 15):
                text = text[:at] + draw.choice("QRSTU") + text[at + 1:]
    marks = {doc: Walk(text).fingerprint() for doc, text, _ in rows}
    expected = [(a, b) for a in marks for b in marks if a < b and set(bands(marks[a])) & set(bands(marks[b])) and likeness(marks[a], marks[b]) >= 0.8]
    assert expected
    assert _joined((r["doc_id"], r["other"]) for r in near_pairs(documents(spark, rows)).collect()) == _joined(expected)
