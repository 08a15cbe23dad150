"""Whole-text tokenisation through the tokenizers library, one call per new token.

Both vocabularies cut a text into pre-tokens (words, numbers, runs of signs) and
merge within them only, so the ids of a text are the ids of its pre-tokens in a
row. A worker keeps the ids of pre-tokens it has met (a table bounded in bytes);
only new ones reach the library, when they are looked up. Plain texts are cut here by the
vocabulary's own pattern; of others the blank-separated words are, and words for
which the libraries could disagree on letters, white space or case (or which hold
a special token's mark) reach the library as they are.
"""

from __future__ import annotations

import os
import re
from array import array

CACHE_BYTES = 160 << 20  # of what a worker holds
_ENTRY = 220  # bytes of a held token besides its characters and ids

# Printable ASCII, line feed and precomposed Latin letters: here every library
# agrees on letters, digits and case. U+0130 lower-cases to two characters.
_PLAIN = re.compile("[\\n -~À-įı-ɏ]*")
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"  # of these characters
_SPECIAL = "<|"

_TOKENIZERS: dict[str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer of a vocabulary file, once per worker."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        _TOKENIZERS[path] = tokenizer
    return _TOKENIZERS[path]


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable
    Latin-1 for itself, the others from U+0100 on in order."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class _Ids(dict):
    """pre-token -> its ids as native array bytes, found when it is first looked up.

    Holds at most about ``room`` bytes: when half of it is full, what was met so far
    becomes the older half, of which what is met again moves back."""

    def __init__(self, tokenizer, typecode: str, room: int = 0):
        super().__init__()
        self.tokenizer, self.typecode, self.room = tokenizer, typecode, room or CACHE_BYTES
        self.merge = tokenizer.model.tokenize
        self.symbols = {b: ord(c) for c, b in byte_symbols().items()}
        self.blank, self.feed = chr(self.symbols[32]), chr(self.symbols[10])
        self.older: dict[str, bytes] = {}
        self.held = 0

    def encode(self, text: str) -> bytes:
        return array(self.typecode, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, token: str) -> bytes:
        ids = self.older.pop(token, None)
        if ids is None:
            ids = self._merged(token) if _PLAIN.fullmatch(token) and _SPECIAL not in token else self.encode(token)
        if self.held > self.room // 2:
            self.older = dict(self)
            self.clear()
            self.held = 0
        self.held += _ENTRY + len(token) + len(ids)
        self[token] = ids
        return ids

    def learn(self, tokens: set[str]) -> None:
        """Looks every given token up."""
        for token in tokens:
            self[token]

    def _merged(self, token: str) -> bytes:
        """A plain pre-token needs no normaliser and no cutting: the library's model
        merges its bytes, written as the vocabulary's symbols."""
        if token.isascii():  # printable ones stand for themselves
            written = token.replace(" ", self.blank).replace("\n", self.feed)
        else:
            written = token.encode().decode("latin-1").translate(self.symbols)
        return array(self.typecode, [found.id for found in self.merge(written)]).tobytes()


class _Encoder:
    ids: _Ids

    def cut(self, text: str) -> list[str]:
        raise NotImplementedError

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        of = self.ids.__getitem__
        return [b"".join(map(of, self.cut(t))) for t in texts]


class ByteBpeEncoder(_Encoder):
    """Texts to ids (native unsigned 32-bit bytes) with a byte-level BPE whose
    pre-tokens carry their leading blank."""

    def __init__(self, path: str):
        self.ids = _Ids(load_tokenizer(path), "I")
        # Letters come first: most pre-tokens are words.
        pattern = rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^ \n0-9{_LETTERS}]+|[ \n]+(?![^ \n])|[ \n]+"
        self.findall = re.compile(pattern).findall
        self.between_words = re.compile(r"(?<=\S)(?= \S)")

    def cut(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return self.findall(text)
        tokens = []
        for word in self.between_words.split(text):
            tokens += self.findall(word) if _PLAIN.fullmatch(word) and _SPECIAL not in word else [word] if word else []
        return tokens


class WordBpeEncoder(_Encoder):
    """Texts to ids with a lower-casing BPE that drops white space; ids are
    native unsigned integers of ``typecode``."""

    def __init__(self, path: str, typecode: str = "I"):
        import regex

        self.ids = _Ids(load_tokenizer(path), typecode)
        self.findall = re.compile(rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^ \n0-9{_LETTERS}]+").findall
        self.blank = regex.compile(r"\p{White_Space}+")

    def cut(self, text: str) -> list[str]:
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return self.findall(text.lower())
        tokens = []
        for word in filter(None, self.blank.split(text)):
            tokens += self.findall(word.lower()) if _PLAIN.fullmatch(word) and _SPECIAL not in word else [word]
        return tokens


def text_slices(texts: list[str | None], chars: int = 2_000_000):
    """(first index, texts) of consecutive slices of bounded size; null is empty."""
    at, size, held = 0, 0, []
    for text in texts:
        if held and size + len(text or "") > chars:
            yield at, held
            at, size, held = at + len(held), 0, []
        held.append(text or "")
        size += len(text or "")
    if held:
        yield at, held


_ENCODERS: dict[tuple, object] = {}


def worker_encoder(kind, *args):
    """One encoder per worker process, so that what it holds serves later tasks; the
    one of another kind goes, so that a worker holds one."""
    key = (kind.__name__, *args)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = kind(*args)
    return _ENCODERS[key]


def release_encoders() -> None:
    """Give up the encoder that a reused worker holds, with its table: for tasks of
    operators that encode nothing."""
    _ENCODERS.clear()
    _TOKENIZERS.clear()
