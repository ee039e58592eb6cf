"""Token ids of whole texts, by a tokenizer whose words end at white space.

The tokenizer file is a parameter. Text is cut at ASCII white space, which no
token spans, and the ids of each piece are remembered per Python worker, so a
frequent word is looked up, not encoded again. Words of lower-case Latin letters,
with or without marks after them, go straight to the model; anything else goes
through the whole tokenizer. The ids equal those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

#: Pieces that one Python worker remembers the tokens of.
REMEMBERED = 400_000

PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,:;!?]*)")
#: Byte-level models spell a byte that is a visible Latin-1 character as itself and the others, in order, from 256 on.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SPELLED = dict(zip((b for b in range(256) if b not in set(VISIBLE)), range(256, 512)))


class WordTokens(dict):
    """Ids of one piece between white space, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.stems: dict[str, bytes] = {"": b""}

    def _encode(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        """A word of lower-case Latin letters, for which lower() and NFC change nothing more."""
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(SPELLED)
        ids = [t.id for t in self.whole.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
            self.stems = {"": b""}
        text, stems = piece.decode(), self.stems
        if plain := PLAIN.fullmatch(text):
            word, marks = plain.groups()
            word = word.lower()
            if (ids := stems.get(word)) is None:
                ids = stems[word] = self._word(word)
            if marks not in stems:
                stems[marks] = self._encode(marks)
            ids += stems[marks]
        else:
            ids = self._encode(text)
        self[piece] = ids
        return ids

    def of(self, text: bytes | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, (text or b"").split())), "<u4")


_READY: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One per worker and file."""
    if path not in _READY:
        _READY[path] = WordTokens(path)
    return _READY[path]


def word_bpe_path() -> str:
    """The word-level file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
