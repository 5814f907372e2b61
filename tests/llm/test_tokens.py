import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cases import ROWS, documents
from ledgerpulse.llm.packing import best_fit, cut_documents, pack, pack_documents
from ledgerpulse.llm import packing, token_files, tokens
from ledgerpulse.llm.token_files import Block, encode_block, read_token_files, write_token_files
from ledgerpulse.llm.tokens import PieceTokenizer, tokenizer_path

WORDS, BYTES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


def whole(path, text):
    t = Tokenizer.from_file(path)
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,drops", [(WORDS, True), (BYTES, False)])
def test_pieces_give_the_ids_of_the_whole_text(path, drops, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 50)
    draw = random.Random(3)
    letters = "ab'sé \n\t 　.,12<|>́​\x1c\r\x85中İΣ"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(600)]
    texts += [None, "", " ", "\n", " a", "a ", "a  b", "it's 's", "<|endoftext|> x<|endoftext|>"] + [t for _, t, _ in ROWS if t and len(t) < 500]
    t = Tokenizer.from_file(path)
    expected = [np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert PieceTokenizer(path, drops).ids(texts) == expected


@pytest.mark.parametrize("n,top", [(0, 1), (1, 49408), (5000, 49408), (5000, 1 << 24), (700, 200)])
def test_block_round_trip_and_random_access(n, top):
    draw = np.random.default_rng(n + top)
    ids = draw.integers(0, top, n).astype(np.uint32)
    block = Block(encode_block([5, None], [n, 0], ids))
    assert block.doc_ids == [5, None] and block.lengths.tolist() == [n, 0]
    assert (block.ids(0, n) == ids).all()
    for a, b in [(0, 0), (n // 3, n // 2), (n - 1 if n else 0, n)]:
        assert (block.ids(a, b) == ids[a:b]).all()
    assert all(block[int(i)] == ids[i] for i in draw.integers(0, n, 50 if n else 0))


def test_a_foreign_block_is_refused():
    with pytest.raises(ValueError):
        Block(b"nothing")


def test_token_files(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 1000)
    rows = read_token_files(write_token_files(documents(spark), WORDS)).collect()
    expected, start = [], 0
    for doc, text, _ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = whole(WORDS, text) + [1]
        expected.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))


def test_token_files_of_an_empty_table(spark):
    assert read_token_files(write_token_files(documents(spark, []), WORDS)).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets = best_fit(np.array([6, 5, 4, 5]), 10)
    assert bins.tolist() == [0, 1, 0, 1] and offsets.tolist() == [0, 0, 6, 5]


def _check_places(rows, capacity):
    by_bin = {}
    for _, length, where, offset in rows:
        by_bin.setdefault(where, []).append((offset, length))
    for parts in by_bin.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_bin)


@pytest.mark.parametrize("group", [50_000, 300])
def test_packing_is_gapless_whole_and_tight(spark, monkeypatch, group):
    monkeypatch.setattr(packing, "GROUP_ROWS", group)
    draw = random.Random(5)
    lengths = [draw.choice([100, draw.randint(1, 100), draw.randint(1, 20)]) for _ in range(4000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    rows = pack(items, 100).join(items, "row").select("row", "length", "bin", "offset").collect()
    assert sorted(r[0] for r in rows) == list(range(4000))
    assert _check_places([tuple(r) for r in rows], 100) <= 1.01 * sum(lengths) / 100 + 2


def test_packing_stops_where_nothing_can_be_joined(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 50)
    items = spark.createDataFrame([(i, 60) for i in range(500)], "row long, length long")
    assert pack(items, 100).select("bin").distinct().count() == 500


def test_packed_documents(spark):
    rows = pack_documents(documents(spark), BYTES, capacity=512).collect()
    assert _check_places([(0, r["length"], r["sequence_id"], r["offset"]) for r in rows], 512) >= 1
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    ids = np.array(whole(BYTES, ROWS[8][1]) + [0], "<u4")
    assert [(r["start"], r["length"], r["ids_crc32"]) for r in own[7]] == [
        (0, len(ids), zlib.crc32(ids.tobytes()))]
    long = sorted(own[3], key=lambda r: r["piece"])
    assert [r["length"] for r in long[1:]] == [512] * (len(long) - 1) and long[0]["length"] <= 512
    assert [r["start"] for r in long] == np.cumsum([0] + [r["length"] for r in long[:-1]]).tolist()
    assert sum(r["length"] for r in long) == len(whole(BYTES, ROWS[3][1])) + 1
    assert len(own[6]) == 2 and own[0][0]["length"] == 1


def test_empty_table_packs_to_nothing(spark):
    assert cut_documents(documents(spark, []), BYTES).count() == 0
    assert pack_documents(documents(spark, []), BYTES).count() == 0
