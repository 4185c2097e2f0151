"""Token ids of whole texts from the ``tokenizers`` library, each distinct word encoded once per worker.

The vocabulary lower-cases, drops white space and forms no token across it, nor
between a letter and another character (contractions and special tokens aside).
So the ids of a text are the ids of its pieces in order; a worker remembers
pieces in a dictionary of bounded size, and the library encodes only new ones.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import islice

from recsignals.llm.textbuf import give_back

#: Pieces remembered per worker (the older half goes when full), and the longest that is.
CACHE_PIECES, CACHE_CHARS = 1_000_000, 48
#: Runs of word characters without digits, and of all else.
_cut = re.compile(r"[^\W\d_]+|[\W\d_]+").findall


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, all others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(shown))}


class _Pieces(dict):
    """Lower-case text between spaces -> ids."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()

    def __missing__(self, piece: str) -> bytes:
        if piece.isalpha() and max(piece) < "\u0250" and piece.islower():  # one word in the model's own spelling
            word = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.model.tokenize(word)]).tobytes()
        elif "'" in piece or "<" in piece or "\u0130" in piece or not piece.isascii() and not unicodedata.is_normalized("NFC", piece):
            ids = self._library(piece)
        else:
            parts = _cut(piece)
            ids = b"".join([self[p] for p in parts]) if len(parts) > 1 else self._library(piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_PIECES:
                for old in list(islice(self, CACHE_PIECES // 2)):
                    del self[old]
            self[piece] = ids
        return ids

    def _library(self, piece: str) -> bytes:
        return array("I", self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()


_loaded: dict[str, _Pieces] = {}


def encoder(path: str):
    """``encode(text) -> bytes`` of little-endian unsigned 32-bit ids."""
    if path not in _loaded:
        _loaded[path] = _Pieces(path)
    lookup = _loaded[path].__getitem__

    def encode(text: str) -> bytes:
        # Lower-casing first is what the vocabulary does, but for letters whose lower case depends on their neighbours
        # or is two characters, and for special tokens, which are matched before.
        if text.isascii() and "<" not in text or "\u0130" not in text and "\u03a3" not in text and "<" not in text and unicodedata.is_normalized("NFC", text):
            text = text.lower()
        return b"".join(map(lookup, text.replace("\n", " ").split(" ")))

    return encode


def forget(path: str, keep: int = 100_000) -> None:
    """Drop a worker's remembered pieces if they are many: workers outlive their stage and share an executor's memory."""
    if path in _loaded and len(_loaded[path]) > keep:
        _loaded[path].clear()
        give_back()


def texts(column) -> Iterator[str]:
    """The strings of an Arrow column one at a time; null is empty."""
    for x in column:
        yield x.as_py() or ""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
