"""Byte-level BPE ids by the tokenizers library, its answers kept a word.

Byte-level BPE never merges across the pieces of its pre-tokenizer, so the ids of a piece don't depend
on what stands around it. Texts are cut by the pre-tokenizer's pattern, the library's model encodes each
new piece once, and a bounded table keeps its answers. Texts with characters on which regular-expression
engines may differ, and texts with a special token's string, go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from operator import itemgetter

import numpy as np

from orrery.llm.wordhash import FORGET

#: Pieces of the younger half of the table; the two halves take about 250 MB of a worker at most.
HALF = 600_000
#: Characters on which the pattern below is the library's: ASCII, Latin letters, common punctuation.
ODD = re.compile("[^\\t\\n\\r -~¡-±´-¸º»¿-ɏ–—‘-„•…€]")
PIECE = re.compile(r" ?[^\W\d_]+| ?(?:[^\s\w']|_)+(?:[^\s\w]|_)*|'(?:[sdmt]|re|ve|ll)| ?[0-9]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: visible Latin-1 characters stand for themselves, other bytes for U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


LETTERS = _byte_letters()
_ENCODERS: dict[str, "PieceEncoder"] = {}
FORGET.append(_ENCODERS.clear)


class PieceTable(dict):
    """Piece to its ids as little-endian uint32 bytes; asks the model on a miss and forgets the older half."""

    def __init__(self, model):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is None:
            plain = " " + piece if piece[0] != " " else piece
            letters = LETTERS[32] * (plain is piece) + plain[1:] if plain[1:].isalnum() and piece.isascii() else piece.encode().decode("latin-1").translate(LETTERS)
            found = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        if len(self) >= HALF:
            self.older = dict(self)
            self.clear()
        self[piece] = found
        return found


class PieceEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.table = PieceTable(self.library.model)

    @staticmethod
    def of(path: str) -> PieceEncoder:
        """One encoder a process and file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = PieceEncoder(path)
        return _ENCODERS[path]

    def _ids(self, text: str) -> np.ndarray:
        if ODD.search(text) or any(x in text for x in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        pieces = PIECE.findall(text)
        if len(pieces) < 2:
            return np.frombuffer(b"".join(map(self.table.__getitem__, pieces)), "<u4")
        return np.frombuffer(b"".join(itemgetter(*pieces)(self.table)), "<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text, as the library gives them without added special tokens."""
        return [self._ids(t) for t in texts]
