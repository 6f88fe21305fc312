"""Token ids of whole texts by a public tokenizer, with bounded caches of pieces of text."""

from __future__ import annotations

import os
import re
import sys
from array import array

#: A byte-level BPE never joins what stands on both sides of a single space between two words.
_CUT = re.compile(r"(?<=\S)(?= \S)")
_ODD_SPACE = re.compile(r" \s|\s ")
_SIGNS = frozenset(".,;:!?")


def _byte_letters() -> dict[int, str]:
    """How a byte-level BPE writes bytes: printable ones as themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}


def _bytes_of(ids: list[int]) -> bytes:
    values = array("I", ids)
    if sys.byteorder == "big":
        values.byteswap()
    return values.tobytes()


class TokenIds:
    """``encode`` gives the ids that the tokenizer gives for the whole text, as little-endian 32-bit integers.

    Texts are cut at single spaces, where the tokenizer itself always cuts, and each piece is tokenized once for as long
    as it stays in the cache. A piece that is one word, or a word and a sign, goes to the tokenizer's model word by word;
    any other piece goes through the whole tokenizer.
    """

    def __init__(self, path: str, entries: int = 600_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.entries = Tokenizer.from_file(path), entries
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        """Ids of a run of letters, with or without a space before it, or of one sign."""
        ids = self.words.get(word)
        if ids is None:
            written = word.encode().decode("latin-1").translate(self.letters)
            ids = _bytes_of([t.id for t in self.model.tokenize(written)])
            if len(self.words) >= self.entries:
                self.words.clear()
            if len(word) < 40:
                self.words[word] = ids
        return ids

    def _line(self, piece: str) -> bytes | None:
        """Ids of a piece within one line, if it is a word or a word and a sign."""
        bare = piece[1:] if piece[0] == " " else piece
        if bare.isalpha():
            return self._word(piece)
        if bare[-1:] in _SIGNS and bare[:-1].isalpha():
            return self._word(piece[:-1]) + self._word(piece[-1])
        return None

    def _new(self, piece: str) -> bytes:
        if "\n" in piece:
            lines = piece.split("\n")
            if all(x.strip() for x in lines):  # line breaks between words stand alone
                found = [self._line(x) for x in lines]
                if None not in found:
                    return self._word("\n").join(found)
        elif piece.strip():
            found = self._line(piece)
            if found is not None:
                return found
        return _bytes_of(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD_SPACE.search(text):
            first, *rest = _CUT.split(text)
            rest = [p[1:] for p in rest]
        else:
            first, *rest = text.split(" ")
        # The cache knows a piece by what follows its space.
        ids = list(map(self.known.get, rest))
        if None in ids:
            if len(self.known) > self.entries:
                self.known.clear()
            for i, found in enumerate(ids):
                if found is None:
                    piece = rest[i]
                    found = self.known.get(piece)
                    if found is None:
                        found = self._new(" " + piece)
                        if len(piece) < 40:
                            self.known[piece] = found
                    ids[i] = found
        return (self._new(first) if first else b"") + b"".join(ids)


_loaded: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One tokenizer for each worker process and file."""
    if path not in _loaded:
        _loaded[path] = TokenIds(path)
    return _loaded[path]
