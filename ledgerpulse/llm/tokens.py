"""Token ids by a public tokenizer, with ids of repeated pieces kept per Python worker.

A text is cut at places where the tokenizer never joins what stands on both sides:
between a visible character and a single blank or line feed before another visible one
(byte-level), or at every blank and line feed (where white space is dropped). Each piece
is encoded by the tokenizers library once and remembered; the ids of a text are
those of its pieces in a row, equal to those of the whole text.
"""

from __future__ import annotations

import itertools
import os
import re
import struct

import numpy as np

from ledgerpulse.llm.common import worker_memory

#: Pieces remembered by a worker; beyond it the later half, rarer words as a rule, is forgotten.
KEPT_PIECES = 400_000
#: Texts whose pieces are held at a time.
BATCH_TEXTS = 200
_CUT = re.compile(r"(?<=[\w!-~])(?=[ \n][\w!-~])")
_NOT_LATIN = re.compile("[\u0130\u0250-\U0010ffff]")
# the sign comes first, so that only its places are looked at
_SIGN = re.compile(r"[.,;:?](?<=[a-z].)(?= )")
_MARKED_SIGN = re.compile(r"[.,;:?](?<=[A-Za-z].)(?= |\Z)")
_VISIBLE = re.compile(r"\0[.,;:?]|\n?[\w!-~](?:.*[\w!-~])?", re.DOTALL)


def _byte_letters() -> dict[int, str]:
    """Byte-level models write bytes as letters: printable ones as they are, all others counted up from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(others)}


_BYTE_LETTERS = _byte_letters()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_tokenizer(path: str, drops_blanks: bool) -> "PieceTokenizer":
    """The tokenizer of this Python worker, loaded once."""
    loaded, key = worker_memory("tokenizers"), (path, drops_blanks)
    if key not in loaded:
        loaded[key] = PieceTokenizer(path, drops_blanks)
    return loaded[key]


class _Pieces(dict):
    """Ids of pieces, found when a piece is first asked for."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, piece: str) -> bytes | None:
        ids = self[piece] = self.find(piece)
        return ids


class PieceTokenizer:
    """ids(texts): little-endian 32-bit ids of every text as bytes, as the tokenizer gives them without adding special tokens."""

    def __init__(self, path: str, drops_blanks: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.drops_blanks = drops_blanks
        self.whole = _Pieces(self._encode)  # pieces as they stand
        self.after = _Pieces(self._encode_after)  # pieces behind a blank; None: no place to cut

    def _is_word(self, piece: str) -> bool:
        """Whether the piece is one run of letters that the tokenizer hands to its model as it stands."""
        if self.drops_blanks:
            return piece.isalpha() and piece == piece.lower() and not _NOT_LATIN.search(piece)
        return piece[1:].isalpha() and piece[0] == " "

    def _encode(self, piece: str) -> bytes:
        if self._is_word(piece):  # straight to the merges, without normalising and cutting one word
            ids = [t.id for t in self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(_BYTE_LETTERS))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_after(self, piece: str) -> bytes | None:
        if not _VISIBLE.fullmatch(piece):
            return None
        return self._encode(piece if piece[0] == "\n" else piece[1:] if piece[0] == "\0" else " " + piece)

    def _bound(self) -> None:
        for name in ("whole", "after"):
            known = getattr(self, name)
            if len(known) > KEPT_PIECES:
                kept = list(itertools.islice(known.items(), KEPT_PIECES // 2))
                known.clear()
                known.update(kept)

    def ids(self, texts: list[str | None]) -> list[bytes]:
        encode = self._dropping if self.drops_blanks else self._bytewise
        marked = [i for i, t in enumerate(texts) if t and any(s in t for s in self.special)]
        if marked:  # names of special tokens have ids of their own: such a text is encoded as a whole
            texts = list(texts)
            whole = {i: np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, "<u4").tobytes() for i in marked}
            for i in marked:
                texts[i] = None
        out = [x for at in range(0, len(texts), BATCH_TEXTS) for x in encode(texts[at:at + BATCH_TEXTS])]
        return [whole.get(i, x) for i, x in enumerate(out)] if marked else out

    def _dropping(self, texts: list[str | None]) -> list[bytes]:
        cut = [(t or "").replace("\n", " ") for t in texts]
        # in plain Latin text case does not matter, and a sign between a letter and a blank is a token of its own
        cut = [(t if _NOT_LATIN.search(t) else _SIGN.sub(r" \g<0>", t.lower())).split(" ") for t in cut]
        get = self.whole.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in cut]
        self._bound()
        return out

    def _bytewise(self, texts: list[str | None]) -> list[bytes]:
        cut = [_MARKED_SIGN.sub(" \0\\g<0>", (t or "").replace("\n", " \n")).split(" ") for t in texts]
        heads = [pieces.pop(0) for pieces in cut]
        after, whole = self.after.__getitem__, self.whole.__getitem__
        out: list = []
        for head, pieces, text in zip(heads, cut, texts):
            try:
                if head and not _VISIBLE.fullmatch("x" + head[-1]) or pieces and not head or text and "\0" in text:
                    raise TypeError
                out.append((head, b"".join(map(after, pieces))))
            except TypeError:  # blanks in a row, control characters: cut where it is safe
                out.append((_CUT.split(text), None))
        out = [b"".join(map(whole, h)) if rest is None else whole(h) + rest for h, rest in out]
        self._bound()
        return out
