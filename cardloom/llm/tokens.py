"""Token ids of whole texts, through the ``tokenizers`` library, as packed integers.

A text is cut at ASCII white space, which no token of a white-space-dropping tokenizer spans,
and the ids of each piece are kept for the next time it is met. A piece of Latin letters and
closing punctuation goes straight to the tokenizer's model; any other piece goes through the
whole tokenizer. The ids are those of ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache
from typing import Any

import numpy as np

KNOWN = 90_000  # pieces in each of two generations, and a third as many words: about 45 MB of a worker at most
_LATIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:-@\[-`{-~]*)")  # no apostrophe: contractions split


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes bytes as letters: printable ones as themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class _Remembered(dict):
    """Values worked out when first asked for, in two generations.

    A full generation becomes the former one, whose values are taken over when asked for again; so
    what occurs often stays when a long tail passes by. Two generations hold twice ``room`` at most.
    """

    def __init__(self, work: Callable[[Any], bytes], room: int):
        super().__init__()
        self.work, self.room, self.former = work, room, {}

    def __missing__(self, asked: Any) -> bytes:
        if len(self) >= self.room:
            self.former = dict(self)
            self.clear()
        value = self.former.get(asked)
        if value is None:
            value = self.work(asked)
        self[asked] = value
        return value


class TokenIds:
    """Encoder for a tokenizer file; ``dtype`` is the narrowest that holds its ids."""

    def __init__(self, path: str, latin_words: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = _byte_letters()
        self.latin_words = latin_words
        self.pieces = _Remembered(self._piece, KNOWN)
        self.words = _Remembered(self._word, KNOWN // 3)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, packed; NULL and empty texts have none."""
        if not text:
            return b""
        # Of bytes: this cuts at the six ASCII white-space characters and at no others.
        whole = text.encode()
        # A tokenizer with a shortcut for Latin words lower-cases, so "The" and "the" are one piece.
        return b"".join(map(self.pieces.__getitem__, (whole.lower() if self.latin_words else whole).split()))

    def _piece(self, piece: bytes) -> bytes:
        if self.latin_words:
            if piece.isalpha():  # of bytes: ASCII letters only, which byte-level BPE writes as themselves
                return self._tokens(piece.decode())
            latin = _LATIN.fullmatch(piece.decode())
            if latin is not None:
                return self.words[latin[1].lower()] + self.words[latin[2]]
        return self._pack(self.tokenizer.encode(piece.decode(), add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        return self._tokens(word.encode().decode("latin-1").translate(self.letters)) if word else b""

    def _tokens(self, spelled: str) -> bytes:
        return self._pack([token.id for token in self.tokenizer.model.tokenize(spelled)])

    def _pack(self, ids: list[int]) -> bytes:
        packed = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> TokenIds:
    """One encoder per worker process and file.

    The shortcut for Latin words holds for tokenizers that lower-case and then take runs of
    letters, single digits and runs of other characters; it is used only where the encoder
    agrees with the tokenizer on a probe of such pieces.
    """
    ids = TokenIds(path)
    probe = "The Quick, brown fox... jumps OVER é À ß naïve Über-cool (maybe) señor&&& $$$ an%%% x"
    whole = ids._pack(ids.tokenizer.encode(probe, add_special_tokens=False).ids)
    if ids.encode(probe) != whole:
        return TokenIds(path, latin_words=False)
    return ids
