"""Packing documents into fixed-length training sequences by minimum bin slack.

Each document is its token ids and one end id. Whole windows of ``capacity``
ids are sequences of their own; what is left of each document waits in a
bounded buffer of its task. A window is then filled by minimum bin slack: the
largest waiting piece is the seed, and a subset-sum dynamic program over a
bitset (bit s: sum s can be reached) finds the multiset of other waiting
lengths that comes closest to the capacity; walking the saved bitsets back
gives how often each length is used, and the pattern is repeated while its
lengths last. When no multiset fills the window exactly, another piece is cut
to fill it. A task's last, incomplete window is cut at powers of two.

Documents never leave the task that tokenises them, so there is no shuffle and
a hot source is as good as any other. Null text counts as empty; a null
``doc_id`` and repeated rows are packed like any other row; an empty table
gives no pieces; extra columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .chunk_ids import ByteBpeEncoder, text_slices, worker_encoder

CAPACITY = 1024
END_ID = 0
BUFFER = 8192  # pieces that wait in a task
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def fullest(lengths: list[int], counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of ``lengths`` (ascending, ``counts`` of each) that holds the
    largest one and whose sum is closest to, and at most, ``capacity``."""
    seed = lengths[-1]
    slack = capacity - seed
    mask = (1 << (slack + 1)) - 1
    reach, steps = 1, []
    for at in range(bisect_right(lengths, slack) - 1, -1, -1):
        length = lengths[at]
        left, take = min(counts[length] - (length == seed), slack // length), 1
        while left > 0 and not reach >> slack & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << take * length & mask
            left -= take
            take *= 2
        if reach >> slack & 1:
            break
    used: dict[int, int] = defaultdict(int, {seed: 1})
    total = reach.bit_length() - 1
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= take * length
    return used


class Packer:
    """Takes documents, gives rows of pieces; holds at most ``buffer`` pieces."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY, buffer: int = BUFFER):
        self.capacity, self.buffer = capacity, buffer
        self.sequence = first_sequence
        self.waiting: dict[int, list[tuple]] = defaultdict(list)  # length -> pieces
        self.lengths: list[int] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` are little-endian unsigned 32-bit ids."""
        n = len(ids) // 4
        whole = n - n % self.capacity
        for start in range(0, whole, self.capacity):
            self._emit([(doc_id, start, n, ids[4 * start : 4 * (start + self.capacity)])])
        if whole < n:
            self._wait((doc_id, whole, n, ids[4 * whole :]))
        if self.held >= self.buffer:
            self._pack(self.buffer // 8)

    def _wait(self, piece: tuple) -> None:
        length = len(piece[3]) // 4
        if not self.waiting[length]:
            insort(self.lengths, length)
        self.waiting[length].append(piece)
        self.held += 1

    def _take(self, length: int) -> tuple:
        pieces = self.waiting[length]
        piece = pieces.pop()
        if not pieces:
            self.lengths.remove(length)
        self.held -= 1
        return piece

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, n, ids in pieces:
            length = len(ids) // 4
            self.rows.append((doc_id, start, length, zlib.crc32(ids), n, self.sequence, offset))
            offset += length
        self.sequence += 1

    def _pack(self, leave: int) -> None:
        """Fill windows until at most ``leave`` pieces wait; the last may wait too
        if nothing is left to fill it."""
        while self.held > leave:
            counts = {length: len(p) for length, p in self.waiting.items() if p}
            used = fullest(self.lengths, counts, self.capacity)
            filled = sum(length * k for length, k in used.items())
            rest = self.held - sum(used.values())
            if filled < self.capacity and not rest:
                return
            repeat = min(counts[length] // k for length, k in used.items()) if filled == self.capacity else 1
            for _ in range(repeat):
                pieces = [self._take(length) for length, k in used.items() for _ in range(k)]
                if filled < self.capacity:
                    doc_id, start, n, ids = self._take(self.lengths[-1])
                    cut = self.capacity - filled
                    pieces.append((doc_id, start, n, ids[: 4 * cut]))
                    self._wait((doc_id, start + cut, n, ids[4 * cut :]))
                self._emit(pieces)

    def finish(self) -> None:
        self._pack(0)
        pieces = [self._take(length) for length in list(self.lengths) for _ in range(len(self.waiting[length]))]
        total = sum(len(p[3]) for p in pieces) // 4
        while total:
            size = 1 << total.bit_length() - 1
            window, room = [], size
            while room:
                doc_id, start, n, ids = pieces.pop()
                part = min(room, len(ids) // 4)
                window.append((doc_id, start, n, ids[: 4 * part]))
                if 4 * part < len(ids):
                    pieces.append((doc_id, start + part, n, ids[4 * part :]))
                room -= part
            self._emit(window)
            total -= size

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece (see ``SCHEMA``): where it stands in its document and in
    its sequence, and the crc32 of its ids as little-endian 32-bit integers."""
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    end = end_id.to_bytes(4, "little")

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(ByteBpeEncoder, tokenizer_path)
        # A partition has fewer than 2**33 sequences, as monotonically_increasing_id has rows.
        packer = Packer(TaskContext.get().partitionId() << 33, capacity)
        for got in batches:
            doc_ids = got.column(0).to_pylist()
            for at, texts in text_slices(got.column(1).to_pylist()):
                for doc_id, ids in zip(doc_ids[at : at + len(texts)], encoder.encode_batch(texts)):
                    packer.add(doc_id, ids + end)
                if packer.rows:
                    yield batch(packer.drain())
        packer.finish()
        if packer.rows:
            yield batch(packer.drain())

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(pack, SCHEMA)
