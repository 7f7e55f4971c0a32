"""Exact word-level encoding with the public word-BPE tokenizer.

The tokenizer drops white space and never merges across it, so a text's ids
are the ids of its white-space-delimited words in order. Words repeat; a
bounded cache in each Python worker holds what was encoded before. Anything
outside the plain cases goes to the library itself.
"""

from __future__ import annotations

import ctypes
import gc
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import lru_cache, wraps

import pyarrow as pa

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: Entries of a generation of a worker's caches of words, and of pieces of words; the longest word worth an entry.
CACHE_WORDS, CACHE_PIECES, CACHE_LETTERS = 200_000, 40_000, 48
#: Where Python's and the tokenizer's idea of white space may differ: such texts go to the library whole.
ODD_SPACE = re.compile("[\x1c-\x1f\x85᠎​﻿]")
#: The tokenizer's split pattern on lower-case ASCII (fixed values).
ASCII_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: Words of letters of the Latin-1 range: lower case and composition are letter by letter there.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LETTERS_THEN_MARKS = re.compile(r"([^\W\d_]+)([.,!?;:|]+)")


def byte_letters() -> list[str]:
    """The tokenizer's letter for each byte: printable Latin-1 stands for itself, the other bytes for letters from 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def give_back() -> None:
    """Returns memory that an earlier operator has freed to the system: workers are reused, and what their allocators keep adds up."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


_CACHES: dict[str, list] = {}
_in_use = [""]


def worker_cache(operator: str):
    """Keeps a function's last result in the worker process, as long as the worker serves this
    operator: Spark reuses workers, and the caches of several would add up."""

    def keep(make: Callable) -> Callable:
        held = lru_cache(maxsize=1)(make)
        _CACHES.setdefault(operator, []).append(held)

        @wraps(make)
        def get(*args):
            if _in_use[0] != operator:
                for other, caches in _CACHES.items():
                    if other != operator:
                        for cache in caches:
                            cache.cache_clear()
                _in_use[0] = operator
                give_back()
            return held(*args)

        return get

    return keep


def giving_back(tasks: Callable) -> Callable:
    """A function over a task's batches that returns freed memory at the task's end."""

    @wraps(tasks)
    def run(batches):
        yield from tasks(batches)
        give_back()

    return run


class Bounded(dict):
    """A dict that makes missing values and holds at most two generations of
    ``most`` keys: when one is full it becomes the old one, from which keys still
    in use return."""

    def __init__(self, make: Callable, most: int = CACHE_WORDS):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= CACHE_LETTERS:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def to_bytes(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of words, as bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        model = self.tokenizer.model
        #: of lower-case ASCII pieces, and of words of letters
        self.piece = lambda p: to_bytes([t.id for t in model.tokenize(p)])
        self.pieces = Bounded(self.piece, CACHE_PIECES)
        self.letters = Bounded(self.lettered, CACHE_PIECES)
        self.byte_letter = byte_letters().__getitem__

    def whole(self, text: str) -> bytes:
        """The library's own answer for any text."""
        return to_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def lettered(self, word: str) -> bytes:
        """Ids of a word of letters."""
        if LATIN.fullmatch(word):
            return self.piece("".join(map(self.byte_letter, word.lower().encode())))
        return self.whole(word)

    def word(self, word: str) -> bytes:
        """Ids of one white-space-delimited word."""
        if word.isascii():
            if word.isalpha():  # whole words are the caller's to keep
                low = word.lower()
                return self.pieces[low] if low != word else self.pieces.get(low) or self.piece(low)
            if "<|" in word or not word.isprintable():
                return self.whole(word)
            return b"".join([self.pieces[p] for p in ASCII_PIECES.findall(word.lower())])
        if "<|" in word:
            return self.whole(word)
        parts = LETTERS_THEN_MARKS.fullmatch(word)
        if parts and unicodedata.normalize("NFC", parts[1]).lower().isalpha():  # no mark for the punctuation to join
            return self.letters[parts[1]] + self.pieces[parts[2]]
        return self.lettered(word) if LATIN.fullmatch(word) else self.letters[word]


@worker_cache("tokens")
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process."""
    return WordEncoder(path)


@worker_cache("tokens")
def byte_cache(path: str, most: int = CACHE_WORDS) -> Bounded:
    return Bounded(encoder(path).word, most)


def encode_bytes(path: str, text: str, most: int = CACHE_WORDS) -> bytes:
    """All ids of ``text`` as bytes, equal to the library's; a worker keeps those of two generations of ``most`` words."""
    if ODD_SPACE.search(text):
        return encoder(path).whole(text)
    return b"".join(map(byte_cache(path, most).__getitem__, text.split()))
