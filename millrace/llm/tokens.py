"""Token ids of whole texts by the tokenizers library, with every piece of text between splits encoded once.

Both vocabularies split a text before merging, so ids of a text are those of its pieces in a row. A worker keeps the
pieces it has met; only new ones go to the library. Texts or pieces whose splitting isn't certain go there whole.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks and pieces that a worker remembers: the first that it meets, so the frequent ones.
CACHE_CHUNKS, CACHE_PIECES = 500_000, 700_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(rf"([ \n]?)([{_LETTERS}]*)([!#$%&*,./:;<=>?@^_`|~+\-()\[\]{{}}]*)\Z")
_CHUNK = re.compile(r"[ \t\n\v\f\r]*[^ \t\n\v\f\r]+|[ \t\n\v\f\r]+\Z")
#: White space, or what some take for it, beyond the six ASCII characters.
_ODD = re.compile("[\\x00-\\x08\\x0e-\\x1f\\x7f-\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u206f\\u3000\\ufeff]")


def _byte_letters() -> list[str]:
    """The printable stand-in that byte-level vocabularies have for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class Encoder:
    """encode(text) gives the ids as little-endian bytes of `dtype`. lowers: the vocabulary lower-cases and drops white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.library.model
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        # an inner space that vanishes tells the two kinds apart
        self.lowers = self._library("A b") == self._library("a b") and self._library("a  b") == self._library("a b")
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of letters only or of punctuation only, with the space before it if the vocabulary keeps that."""
        ids = self.pieces.get(piece)
        if ids is None:
            spelled = "".join([self.letters[b] for b in piece.encode()])
            ids = array(self.code, [t.id for t in self.model.tokenize(spelled)]).tobytes()
            if len(self.pieces) < CACHE_PIECES:
                self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        m = _SIMPLE.match(chunk)
        if m is None or not (m[2] or m[3]):
            return self._library(chunk)
        space, letters, rest = m.groups()
        if self.lowers:
            return (self._piece(letters.lower()) if letters else b"") + (self._piece(rest) if rest else b"")
        out = b""
        if space == "\n":
            out, space = self._piece("\n"), ""
        if letters:
            out += self._piece(space + letters)
            space = ""
        return out + (self._piece(space + rest) if rest else b"")

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if _ODD.search(text):
            return self._library(text)
        words = text.split()
        if self.lowers:
            chunks = words
        elif len(words) == text.count(" ") + text.count("\n") + 1 and not any(c in text for c in "\t\v\f\r"):  # single spaces and line ends, none at the ends
            chunks = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        else:
            chunks = _CHUNK.findall(text)
        known = self.chunks
        out = list(map(known.get, chunks))
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    c = chunks[i]
                    if (ids := known.get(c)) is None:
                        ids = self._chunk(c)
                        if len(known) < CACHE_CHUNKS:
                            known[c] = ids
                    out[i] = ids
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One a worker: it outlives tasks if the worker is reused."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Gives up the encoders of this worker with all that they remember, some 300 MB; the next use makes them anew."""
    if _encoders:
        _encoders.clear()
        pa.default_memory_pool().release_unused()


def public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
