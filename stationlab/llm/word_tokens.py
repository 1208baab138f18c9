"""Exact token ids of whole texts, with the work of a repeated word done once.

The lower-casing vocabulary used here drops white space and never merges
across the pieces its pre-tokenizer cuts, so the ids of a text are the ids of
its white-space separated chunks in order.  Each task keeps the ids of chunks
and pieces it has met in a bounded memory; only new pieces are given to the
``tokenizers`` library.  A chunk whose pieces depend on more than the cutting
(a special string, characters not in normal form C, odd case changes) goes to
the library as it stands.
"""

from __future__ import annotations

import unicodedata
from array import array
from sys import getsizeof

import numpy as np

# The pieces of the lower-casing vocabulary.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


LONG_KEY = 64           # characters or bytes of the longest key that is remembered
ENTRY_BYTES = 100       # about what an entry costs beside its key and value


class Memory(dict):
    """A dict that computes what it lacks and holds two generations of at most ``most_bytes`` each.

    Long keys are computed each time, so no text, however long its unbroken runs, fills it.
    """

    def __init__(self, compute, most_bytes: int = 40 << 20):
        super().__init__()
        self.compute, self.most_bytes, self.older, self.bytes = compute, most_bytes, {}, 0

    def __missing__(self, key):
        if len(key) > LONG_KEY:
            return self.compute(key)
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if self.bytes >= self.most_bytes:
            self.older, self.bytes = dict(self), 0
            self.clear()
        self.bytes += ENTRY_BYTES + getsizeof(key) + getsizeof(value)
        self[key] = value
        return value


def byte_alphabet() -> list:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b] = chr(extra)
            extra += 1
    return out


class WordEncoder:
    """Ids of texts (as UTF-8 bytes) under a lower-casing word-end vocabulary file."""

    def __init__(self, path: str):
        import os

        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.model = self.lib.model
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.size = self.lib.get_vocab_size()
        self.width = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.cut = regex.compile(WORD_PIECES).findall
        self.alphabet = byte_alphabet()
        self.pieces = Memory(self._piece)
        self.chunks = Memory(self._chunk)
        self.get = self.chunks.__getitem__

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype=self.width).tobytes()

    def _piece(self, piece: str) -> bytes:
        alphabet = self.alphabet
        mapped = piece if piece.isalpha() and piece.isascii() else "".join([alphabet[b] for b in piece.encode()])
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        low = text.lower()
        core = low.rstrip(".,")
        if core.isascii() and core.isalpha():       # a word and its stop: two pieces at most
            return self.pieces[core] + self.pieces[low[len(core):]] if len(core) < len(low) else self.pieces[core]
        odd = "<|" in low and any(s in low for s in self.specials) or not text.isascii() and (
            "Σ" in text or len(low) != len(text) or not unicodedata.is_normalized("NFC", text))
        if odd:
            return self.whole(text)
        if core.isalpha():
            return self.pieces[core] + self.pieces[low[len(core):]] if len(core) < len(low) else self.pieces[core]
        return b"".join(map(self.pieces.__getitem__, self.cut(low)))

    def encode(self, text: bytes | None) -> bytes:
        """The ids, little-endian, ``width`` bytes each; null: none."""
        return b"".join(map(self.get, text.split())) if text else b""
