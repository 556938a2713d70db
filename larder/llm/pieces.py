"""Whole-text encoding through pieces that a byte-level BPE encodes independently.

The vocabularies' pattern never joins a character that is not white space with white space
after it, so a text may be cut before any blank or line end that follows such a character. Each
different piece is encoded once and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A blank or line end after a character other than white space begins a piece; so does the text.
PIECE = re.compile(r"(?:\A|[ \n])\s*\S*(?:[^\S \n]\s*\S*)*")
#: Letters alone, with a blank before them or not, are one match of the vocabularies' pattern.
LETTERS = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Two characters of white space (Python's, named one by one for Arrow's expressions).
_SIDE_BY_SIDE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
#: Encoded pieces that one Python worker remembers.
MEMO_ROWS = 800_000


class PieceMemo:
    """Encodes texts by ``encode_pieces``, which gets each piece that is not remembered once.

    Pieces are kept in two halves: when the newer is full it becomes the older one, whose
    pieces come over as texts ask for them. So pieces in use stay, those seen once go.
    """

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], rows: int = MEMO_ROWS):
        self.encode_pieces, self.rows = encode_pieces, rows
        self.whole: dict[str, bytes] = {}  # piece -> ids
        self.after: dict[str, bytes] = {}  # piece without the blank it begins with, or from its line end on -> ids
        self.older: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def word(self, word: str) -> bytes | None:
        """The ids of a word, if it is a blank and letters (so a piece) and remembered."""
        if word[:1] != " " or not word[1:].isalpha():
            return None
        return self.after.get(word[1:]) or self.older[1].get(word[1:])

    def keep_words(self, ids: dict[str, bytes]) -> None:
        """Remember words of a blank and letters: each is also a piece."""
        self.after.update((w[1:], i) for w, i in ids.items() if w[:1] == " " and w[1:].isalpha())

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.whole) + len(self.after) > self.rows // 2:
            self.older, self.whole, self.after = (self.whole, self.after), {}, {}
        (old_whole, old_after), whole, after = self.older, self.whole, self.after
        column = pa.array(texts, pa.large_string())
        beside = pc.match_substring_regex(column, _SIDE_BY_SIDE).to_pylist()
        found = [PIECE.findall(t) if b else [] for t, b in zip(texts, beside, strict=True)]
        # elsewhere a plain split finds the pieces
        words = pc.split_pattern(pc.replace_substring(column.filter(pc.invert(pa.array(beside, pa.bool_()))), "\n", " \n"), " ")
        begin, flat = words.offsets.to_numpy(), words.values
        first = np.zeros(len(flat), dtype=bool)
        first[begin[:-1]] = True
        heads = {p for pieces in found for p in pieces}
        starts = flat.filter(pa.array(first)).to_pylist()
        heads.update(starts)
        tails = flat.filter(pa.array(~first)).dictionary_encode()  # each different word of these texts is looked up once
        rest = tails.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(after.get, rest))
        gaps = [k for k, i in enumerate(ids) if i is None] if None in ids else []
        for wanted, now, old in ((heads, whole, old_whole), ([rest[k] for k in gaps], after, old_after)):
            now.update([(p, old[p]) for p in wanted if p in old and p not in now])
        new_heads, new_tails = [p for p in heads if p not in whole], [rest[k] for k in gaps if rest[k] not in after]
        encoded = self.encode_pieces(new_heads + [p if p[:1] == "\n" else " " + p for p in new_tails])
        whole.update(zip(new_heads, encoded, strict=False))
        after.update(zip(new_tails, encoded[len(new_heads):], strict=True))
        for k in gaps:
            ids[k] = after[rest[k]]
        joined = pa.array(ids, pa.large_binary()).take(tails.indices)
        _, ends, data = joined.buffers()
        data = memoryview(data or b"")
        at = np.frombuffer(ends, dtype=np.int64, count=len(joined) + 1)[begin - np.arange(len(begin))].tolist()
        split = (whole[p] + data[i:j] for p, i, j in zip(starts, at, at[1:], strict=False))
        return [b"".join(map(whole.__getitem__, pieces)) if b else next(split) for pieces, b in zip(found, beside, strict=True)]
