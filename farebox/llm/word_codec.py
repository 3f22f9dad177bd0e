"""Token ids of white-space delimited words, by the tokenizers library, remembered per worker.

The word-level tokenizer drops white space and never merges across it, so the ids of a text
are the ids of its words ``[^\\x20\\x09-\\x0D]+`` one after another.  A word of printable
Latin-1 characters without an apostrophe or ``<`` falls apart, in lower case, into runs of
letters, single digits and runs of other characters; each part is its UTF-8 bytes in the
vocabulary's byte characters and goes to the library's merge model.  Every other word
(contractions, special tokens, other scripts) goes through the whole library.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable
from sys import getsizeof

from tokenizers import Tokenizer

# Bytes of a table of remembered words; a fuller one is emptied.  It lives as long as the
# task that made it.
REMEMBERED = 32 << 20
# Bytes of each of a codec's two tables, of words and of their parts, which live as long as
# the Python worker: some 480,000 entries.  Smaller ones cost CPU: with 64 and 32 MB the packing's
# token stage took 107 s on 0.5 GB instead of 79.
REMEMBERED_IDS = 96 << 20

# Printable Latin-1 without ' and <, and without what Unicode counts as white space or as
# numbers beyond 0-9 there.
_PLAIN = re.compile("[!-&(-;=-~¡-±´-¸º»¿-ÿ]+")
# Its lower-case letters; single digits; the rest.
_PARTS = re.compile("[a-zªµºß-öø-ÿ]+|[0-9]|[^a-z0-9ªµºß-öø-ÿ]+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the others take the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Remembered(dict):
    """A table that works out missing entries and is emptied when they take ``most`` bytes."""

    def __init__(self, work_out: Callable, most: int = REMEMBERED):
        super().__init__()
        self.work_out, self.most, self.held = work_out, most, 0

    def __missing__(self, key):
        value = self.work_out(key)
        if self.held >= self.most:
            self.clear()
            self.held = 0
        self.held += getsizeof(key) + getsizeof(value) + 100  # a dict's slot and spare room
        self[key] = value
        return value


class WordCodec:
    """``encode(word)``, or ``ids[word]``, which remembers: the ids of a word (UTF-8 bytes)
    as little-endian uint32."""

    def __init__(self, tokenizer: Tokenizer, remembered: int = REMEMBERED_IDS):
        self.tokenizer = tokenizer
        self.model = tokenizer.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.ids = Remembered(self.encode, remembered)
        self.parts = Remembered(self._part, remembered)

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else part.encode().decode("latin-1").translate(self.symbols)
        return _packed([t.id for t in self.model.tokenize(text)])

    def encode(self, word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text):
            parts = self.parts
            return b"".join([parts[p] for p in _PARTS.findall(text.lower())])
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_codecs: dict[str, WordCodec] = {}


def codec(path: str) -> WordCodec:
    """The worker's codec for ``path``; workers are reused by later tasks."""
    if path not in _codecs:
        _codecs[path] = WordCodec(Tokenizer.from_file(path))
    return _codecs[path]


def vocabulary(path: str) -> list[tuple[int, str]]:
    """(id, piece) of every entry of a tokenizer file, special tokens included."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pieces = {i: p for p, i in spec["model"]["vocab"].items()}
    pieces.update((t["id"], t["content"]) for t in spec["added_tokens"])
    return sorted(pieces.items())
