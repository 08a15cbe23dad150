"""BPE encoding and decoding in batched numpy merge rounds.

The words of a batch of texts are merged together. Their symbols stand in one
flat array; the rank of each neighbouring pair is found by binary search in the
sorted pair keys; a round merges, in every word at once, all places of the
word's lowest-ranked pair, from the left. Finished words leave the rounds. Work
per round is a few array operations, however many words there are. A worker
keeps the words it has merged (a bounded memory, emptied when full).

Before that, a text is split at special tokens, put into NFC, lower-cased
character by character and cut into contractions, runs of letters, single
digits and runs of other signs; white space goes.

Null text counts as empty: no ids, empty decoded text. Repeated rows and a null
``doc_id`` give a row each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .chunk_ids import text_slices, worker_encoder

WORD_END = "</w>"
MAX_WORDS = 400_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 for itself, the others from U+0100 in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class Merges:
    """A vocabulary's merge table as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            tokenizer = json.load(file)
        model = tokenizer["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in tokenizer["added_tokens"] if t["special"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        self.size = 1 + max(self.tokens)
        left, right = zip(*model["merges"])
        a, b = (np.array([self.ids[t] for t in side], np.int64) for side in (left, right))
        made = np.array([self.ids[x + y] for x, y in zip(left, right)], np.int64)
        keys = a * self.size + b
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        symbols = byte_symbols()
        self.inner = np.array([self.ids[s] for s in symbols], np.int64)
        self.final = np.array([self.ids[s + WORD_END] for s in symbols], np.int64)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word (not empty), all words at once."""
        if not words:
            return []
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths) - 1
        symbols = self.inner[data]
        symbols[ends] = self.final[data[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_word = [], []
        while len(symbols):
            keys = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            rank = np.where((self.keys[at] == keys) & (word[:-1] == word[1:]), self.ranks[at], _NO_RANK)
            rank = np.append(rank, _NO_RANK)
            begins = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, begins)
            sizes = np.diff(np.append(begins, len(word)))
            best = np.repeat(lowest, sizes)
            finished = best == _NO_RANK
            if finished.any():
                done_symbols.append(symbols[finished])
                done_word.append(word[finished])
            merge = np.flatnonzero((rank == best) & ~finished)
            # Of overlapping places (the same symbol three times) every second one, from the left.
            if len(merge):
                run = np.cumsum(np.diff(merge, prepend=-2) != 1) - 1
                first = np.flatnonzero(np.diff(run, prepend=-1))
                merge = merge[(np.arange(len(merge)) - first[run]) % 2 == 0]
                symbols[merge] = self.made[at[merge]]
            keep = ~finished
            keep[merge + 1] = False
            symbols, word = symbols[keep], word[keep]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.split(symbols[order], np.flatnonzero(np.diff(word[order])) + 1)


class NumpyBpe:
    """Encodes texts to ids and decodes ids to the tokens' text, blank-separated."""

    def __init__(self, path: str):
        import regex

        self.merges = Merges(path)
        self.ids: dict[str, bytes] = {}  # word -> decimal ids, blank-separated
        self.decoded: dict[str, bytes] = {}  # word -> decode(ids)
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+").findall
        self.blank = regex.compile(r"\p{White_Space}+")
        self.separators = regex.compile("[\x1c-\x1f]")
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")")

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.merges.tokens[i] for i in ids])

    def words(self, text: str) -> list[str]:
        if self.separators.search(text):
            return list(filter(None, self.blank.split(text)))
        return text.split()

    def _parts(self, word: str) -> list[str]:
        """Special tokens as they are, else the normalised pieces that are merged apart."""
        if word.isascii() and word.isalpha():
            return [word.lower()]
        parts: list[str] = []
        for k, piece in enumerate(self.at_special.split(word)):
            if k % 2:
                parts.append(piece)
            else:
                if not piece.isascii():
                    piece = unicodedata.normalize("NFC", piece)
                # str.lower() looks at a final sigma's neighbours; character by character it does not.
                piece = piece.lower() if "Σ" not in piece else "".join(c.lower() for c in piece)
                parts.extend(self.cut(piece))
        return parts

    def learn(self, words: set[str]) -> None:
        """Afterwards ``ids`` and ``decoded`` hold every given word."""
        if len(self.ids) > MAX_WORDS:
            self.ids.clear()
            self.decoded.clear()
        parts = {word: self._parts(word) for word in words - self.ids.keys()}
        new = list(set().union(*parts.values()) - self.merges.special.keys())
        found: dict[str, list[int]] = {t: [i] for t, i in self.merges.special.items()}
        found |= zip(new, (ids.tolist() for ids in self.merges.encode([t.encode() for t in new])))
        for word, own in parts.items():
            ids = found[own[0]] if len(own) == 1 else [i for part in own for i in found[part]]
            self.ids[word] = " ".join(map(str, ids)).encode()
            self.decoded[word] = self.decode(ids).encode()

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Per text: number of ids, SHA-256 of the decimal ids, of the decoded text."""
        cut = [self.words(t) for t in texts]
        self.learn(set().union(*cut))
        rows = []
        for words in cut:
            ids = b" ".join(map(self.ids.__getitem__, words))
            decoded = b" ".join(map(self.decoded.__getitem__, words))
            n = ids.count(b" ") + 1 if ids else 0
            rows.append((n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        return rows

    def encode(self, text: str) -> list[int]:
        words = self.words(text)
        self.learn(set(words))
        return [int(i) for word in words for i in self.ids[word].split()]


def encode_and_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per row of ``docs``: digests of its ids and of the text they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_encoder(NumpyBpe, tokenizer_path)
        for batch in batches:
            rows = [row for _, texts in text_slices(batch.column(1).to_pylist()) for row in bpe.digests(texts)]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)
