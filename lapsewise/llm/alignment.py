"""Alignment of the tokens of two vocabularies over the same bytes.

Both tokenisers read the blank plus the text: A is a byte-level BPE of the
tokenizers library, B a sentencepiece model that adds the blank itself. Their
spans (character offsets of A, spans of B's proto) give the byte ends of tokens
that end with a character; tokens that end inside one (parts of a multi-byte
character, byte fallback) have no span of their own and are placed by the
lengths of their decoded bytes. Byte offsets where a token of A and one of B
end together cut the tokens into groups; the two tokens that end there are
linked.

Neither vocabulary has a token across a blank between two words, so groups
never cross it either: a text is cut there, and a worker keeps the groups of
words it has met (a cache bounded in bytes). Only new words reach the
tokenisers, many as one text, and are told apart by their spans.

How often a pair of ids is linked is counted over all documents: documents go
to files in buckets of bounded size, each bucket sends its distinct pairs with
their counts to be summed, and gets back the sums of those pairs only. No task
and no message holds the pairs of all documents.

Null and empty texts, and texts whose tokens do not spell the blank plus the
text (they hold U+2581, say), have no tokens: zeros and an empty digest. A null
doc_id and repeated rows give a row each; repeats count as often as they occur.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .chunk_ids import byte_symbols, text_slices, worker_encoder
from .common import Scratch

CACHE_BYTES = 160 << 20  # of words kept by a worker
BUCKET_LINKS = 1 << 21
BLANK = "▁"  # a blank within sentencepiece's pieces
SEGMENT_SCHEMA = "bucket long, row long, doc_id long, n_a long, n_b long, n_links long, groups_sha256 string, links binary"
_BEFORE_WORDS = re.compile(r"(?<=\S)(?=[ \n]\S)")
_ENTRY = 400  # bytes of a cached word besides its texts
_UNEVEN = re.compile(r"\s\s|[^\S \n]|\x00")
_FIRST = " a"
_BATCH = 4096  # characters given to the tokenisers as one text


def _ends(span_ends: np.ndarray, whole: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: by span where a token ends ``whole`` characters, else by
    decoded bytes since the last such token."""
    decoded = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(whole, np.arange(len(whole)), -1))
    return np.where(last >= 0, span_ends[last], 0) + decoded - np.where(last >= 0, decoded[last], 0)


def _shift(path_a: str, path_b: str) -> int:
    """Bits of B's ids in a link: 16 if both vocabularies allow it."""
    import sentencepiece
    from tokenizers import Tokenizer

    sizes = Tokenizer.from_file(path_a).get_vocab_size(), sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    return 16 if max(sizes) <= 1 << 16 else 32


class Aligner:
    """Texts to their groups; keeps what it learned of words."""

    def __init__(self, path_a: str, path_b: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbols = byte_symbols()
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * max(self.a.get_vocab_size(), 1 + max(vocabulary.values()))
        for token, k in vocabulary.items():
            if all(c in symbols for c in token):
                self.bytes_a[k] = bytes(symbols[c] for c in token)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(k)[3:5], 16)]) if self.b.is_byte(k) else self.b.id_to_piece(k).replace(BLANK, " ").encode()
            for k in range(self.b.get_piece_size())
        ]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table]) for table in (self.bytes_a, self.bytes_b))
        self.shift = 16 if max(len(self.bytes_a), len(self.bytes_b)) <= 1 << 16 else 32
        self.link_type = np.dtype("<u4" if self.shift == 16 else "<u8")
        size = max(len(self.bytes_a), len(self.bytes_b))
        self.text = {mark: np.array([f"{k}{mark}" for k in range(size)], object) for mark in ",|;"}
        self.cache_bytes, self.held = cache_bytes, 0
        # " word" or "\\nword" -> (its groups, each ended by ";"; its links; its tokens of A, of B)
        self.words: dict[str, tuple[str, bytes, int, int] | None] = {}
        self.older: dict[str, tuple | None] = {}  # words met before the last half of the cache filled

    def learn(self, words: set[str]) -> None:
        """Afterwards ``self.words`` has every given word."""
        if self.held > self.cache_bytes // 2:
            self.words, self.older, self.held = {}, self.words, 0
        new = words - self.words.keys()
        again = new & self.older.keys()
        self._keep(again, self.older)
        batch, size = [], 0
        for word in new - again:
            if word[1].isspace() or word[-1].isspace() or BLANK in word:
                # Its blanks would join those of its neighbours, so it stands alone.
                self._keep([word], self._align([word]) if BLANK not in word else {})
                continue
            if size + len(word) > _BATCH:
                self._keep(batch, self._align(batch))
                batch, size = [], 0
            batch.append(word)
            size += len(word)
        self._keep(batch, self._align(batch))

    def _keep(self, words: Iterable[str], found: dict[str, tuple | None]) -> None:
        for word in words:
            self.words[word] = entry = found.get(word)
            self.held += _ENTRY + 2 * len(word) + (len(entry[0]) + len(entry[1]) if entry else 0)

    def _align(self, words: list[str]) -> dict[str, tuple]:
        """The entries of words (each with its leading blank) that both tokenisers spell."""
        if not words:
            return {}
        words = [_FIRST, *words]  # so that B's own blank stands before a word
        joined = "".join(words)
        raw = joined.encode()
        encoded = self.a.encode(joined, add_special_tokens=False)
        pieces = self.b.encode(joined[1:], return_type="proto").pieces
        ids_a, ids_b = encoded.ids, [p.id for p in pieces]
        if any(b"".join([table[k] for k in ids]) != raw for ids, table in ((ids_a, self.bytes_a), (ids_b, self.bytes_b))):
            return {} if len(words) == 2 else {w: e for word in words[1:] for w, e in self._align([word]).items()}
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        spans = np.array(encoded.offsets, np.int64)
        whole = np.append(spans[1:, 0] >= spans[:-1, 1], True)
        byte_at = np.arange(len(raw) + 1)
        if len(raw) > len(joined):
            code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            byte_at = np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)))
        ends_a = _ends(byte_at[spans[:, 1]], whole, self.lengths_a[ids_a])
        # B's spans are bytes after the blank that it adds itself.
        ends = np.array([p.end for p in pieces], np.int64)
        ends_b = _ends(ends + 1, np.append(True, ends[1:] > ends[:-1]), self.lengths_b[ids_b])

        _, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        links = (ids_a[last_a] << self.shift | ids_b[last_b]).astype(self.link_type).tobytes()
        # Place of every token in the written groups: those of A, then those of B.
        group_a = np.searchsorted(last_a, np.arange(len(ids_a)))
        group_b = np.searchsorted(last_b, np.arange(len(ids_b)))
        written = np.empty(len(ids_a) + len(ids_b), object)
        text_a, text_b = self.text[","][ids_a], self.text[","][ids_b]
        text_a[last_a], text_b[last_b] = self.text["|"][ids_a[last_a]], self.text[";"][ids_b[last_b]]
        written[np.arange(len(ids_a)) + np.append(0, last_b + 1)[group_a]] = text_a
        written[np.arange(len(ids_b)) + (last_a + 1)[group_b]] = text_b
        written = written.tolist()

        word_ends = np.cumsum([len(w.encode()) for w in words])
        tokens_a = np.searchsorted(ends_a, word_ends, side="right").tolist()
        tokens_b = np.searchsorted(ends_b, word_ends, side="right").tolist()
        groups = np.searchsorted(ends_a[last_a], word_ends, side="right").tolist()
        entries, a, b, g, width = {}, 0, 0, 0, self.link_type.itemsize
        for word, to_a, to_b, to_g in zip(words, tokens_a, tokens_b, groups):
            entries[word] = ("".join(written[a + b : to_a + to_b]), links[width * g : width * to_g], to_a - a, to_b - b)
            a, b, g = to_a, to_b, to_g
        return entries

    def align_batch(self, texts: list[str]) -> list[tuple[int, int, str, bytes]]:
        """(tokens of A, tokens of B, groups as text, links) of each text."""
        cut = [_cut(t) for t in texts]
        self.learn(set().union(*cut))
        of, out = self.words.__getitem__, []
        for words in cut:
            entries = list(map(of, words))
            if not entries or None in entries:
                out.append((0, 0, "", b""))
                continue
            groups, links, n_a, n_b = zip(*entries)
            out.append((sum(n_a), sum(n_b), "".join(groups)[:-1], b"".join(links)))
        return out


def _cut(text: str) -> list[str]:
    """The blank plus the text, cut before every blank or line feed that stands
    alone between two words. Empty for an empty text."""
    if not text:
        return []
    if _UNEVEN.search(f" {text} "):
        return _BEFORE_WORDS.split(" " + text)
    return f" {text}".replace("\n", "\0\n").replace(" ", "\0 ").split("\0")[1:]


def alignments(docs: DataFrame, path_a: str, path_b: str, bucket_links: int = BUCKET_LINKS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links,
    n_best (links whose pair is counted highest of all pairs of its id of B),
    count_sum (the pairs' counts, over the links) and groups_sha256."""
    scratch = Scratch(docs.sparkSession, "alignment")
    names = [field.split()[0] for field in SEGMENT_SCHEMA.split(", ")]
    types = [*[pa.int64()] * 6, pa.string(), pa.binary()]

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A document's links lie in the task's current bucket; what it cannot hold
        goes on in the next, in rows that add nothing but links."""
        aligner = worker_encoder(Aligner, path_a, path_b)
        width = aligner.link_type.itemsize
        first = TaskContext.get().partitionId() << 33
        row, bucket, room, rows = first, first, bucket_links, []
        for got in batches:
            doc_ids = got.column(0).to_pylist()
            for at, texts in text_slices(got.column(1).to_pylist()):
                for doc_id, (n_a, n_b, groups, links) in zip(doc_ids[at : at + len(texts)], aligner.align_batch(texts)):
                    digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    counts = (n_a, n_b, len(links) // width, digest)
                    while True:
                        part = links[: room * width]
                        rows.append((bucket, row, doc_id, *counts, part))
                        links, counts, room = links[len(part) :], (0, 0, 0, ""), room - len(part) // width
                        if room == 0:
                            bucket, room = bucket + 1, bucket_links
                        if not links:
                            break
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []

    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    segments = scratch.write(texts.mapInArrow(align, SEGMENT_SCHEMA), "segments")

    def link_array(column: pa.Array) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), worker_encoder(Aligner, path_a, path_b).link_type).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            buckets = got.column(0).to_numpy()
            for bucket in np.unique(buckets).tolist():
                pairs, n = np.unique(link_array(got.column(1).filter(pa.array(buckets == bucket))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), bucket)), pa.array(pairs), pa.array(n)], ["bucket", "pair", "n"])

    in_bucket = segments.select("bucket", "links").mapInArrow(count, "bucket long, pair long, n long")
    in_bucket = scratch.write(in_bucket.groupBy("bucket", "pair").agg(F.sum("n").alias("n")), "pairs")
    low = (1 << _shift(path_a, path_b)) - 1
    totals = in_bucket.groupBy("pair").agg(F.sum("n").alias("total"))
    # A window per id of B: at most as many pairs as A has ids.
    best = F.max("total").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(low))))
    totals = totals.select("pair", "total", (F.col("total") == best).alias("best"))
    known = in_bucket.join(totals, "pair").select("bucket", "pair", "total", "best")
    out = "row long, doc_id long, n_a long, n_b long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def look_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        order = np.argsort(known["pair"].to_numpy())
        pairs, total, best = (known[c].to_numpy()[order] for c in ("pair", "total", "best"))
        per_row = np.array([len(v) for v in rows["links"].to_pylist()]) // worker_encoder(Aligner, path_a, path_b).link_type.itemsize
        at = np.searchsorted(pairs, link_array(rows["links"]))
        edges = np.append(0, np.cumsum(per_row))
        sums = [np.append(0, np.cumsum(v[at], dtype=np.int64))[edges] if len(at) else np.zeros(len(edges), np.int64) for v in (best, total)]
        kept = rows.select(["row", "doc_id", "n_a", "n_b", "n_links"])
        kept = kept.append_column("n_best", pa.array(np.diff(sums[0]))).append_column("count_sum", pa.array(np.diff(sums[1])))
        return kept.append_column("groups_sha256", rows["groups_sha256"])

    counted = segments.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(look_up, out)
    sums = [F.sum(c).alias(c) for c in ("n_a", "n_b")]
    sums += [F.sum("n_links").alias("n_groups"), *[F.sum(c).alias(c) for c in ("n_links", "n_best", "count_sum")]]
    return counted.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256")).drop("row")
