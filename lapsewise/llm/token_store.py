"""A token-id store: concatenated ids with Elias-Fano document boundaries.

Layout. Documents are range-partitioned and sorted by ``doc_id`` (nulls first;
equal ids by the hash of their text), so shards follow each other in id order.
A shard is written as chunks, one Parquet row each: the ids of consecutive
documents as one little-endian integer array (16 bits wide when the vocabulary
allows, else 32), the documents' ids, and the ends of the documents in that
array as an Elias-Fano code: 2 + log2(u / n) bits a document, with a sampled
select structure, in place of a 64-bit table. A chunk closes at ``CHUNK_IDS``
ids, so no row grows with the corpus; a longer document has a chunk of its
own. Parquet is the container because only Spark reaches the shared store.

Null text counts as empty: only the end id is stored. Repeated rows are stored
as often as they occur; an empty table gives an empty store; extra columns are
ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .chunk_ids import WordBpeEncoder, load_tokenizer, text_slices, worker_encoder

END_ID = 1
CHUNK_IDS = 1 << 20
SELECT_EVERY = 256
STORE_SCHEMA = "shard int, chunk int, n_ids long, doc_ids array<bigint>, ends binary, width int, ids binary"


class EliasFano:
    """A non-decreasing sequence of non-negative integers below 2**63.

    Each value's low bits are packed side by side; the high parts are a bit
    vector with one set bit per value, at (value >> low) + index. ``select``
    starts at the sampled position of every 256th set bit.
    """

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, samples: bytes):
        self.n, self.low = n, low
        self.lows, self.highs = np.frombuffer(lows, np.uint8), np.frombuffer(highs, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
        at = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        packed = [np.packbits(b.astype(np.uint8).ravel(), bitorder="little").tobytes() for b in (bits, high)]
        return cls(n, low, *packed, at[::SELECT_EVERY].astype("<u4").tobytes())

    def to_bytes(self) -> bytes:
        head = struct.pack("<QBQQ", self.n, self.low, len(self.lows), len(self.highs))
        return head + self.lows.tobytes() + self.highs.tobytes() + self.samples.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low, a, b = struct.unpack_from("<QBQQ", data)
        at = struct.calcsize("<QBQQ")
        return cls(n, low, data[at : at + a], data[at + a : at + a + b], data[at + a + b :])

    def _low(self, i: int) -> int:
        first = i * self.low
        word = int.from_bytes(self.lows[first // 8 : (first + self.low + 7) // 8].tobytes(), "little")
        return word >> first % 8 & (1 << self.low) - 1

    def select(self, i: int) -> int:
        """The i-th value, from one sample and the bytes up to the next."""
        at = int(self.samples[i // SELECT_EVERY])
        left = i % SELECT_EVERY
        byte, word = at // 8, int(self.highs[at // 8]) >> at % 8 << at % 8
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = int(self.highs[byte])
        for _ in range(left):
            word &= word - 1
        position = 8 * byte + (word & -word).bit_length() - 1
        return (position - i << self.low) | self._low(i)

    def select_many(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``: of the high bits only the stretches between the
        samples around them are unpacked, of the low ones only theirs."""
        index = np.asarray(index, np.int64)
        blocks, position = index // SELECT_EVERY, np.empty(len(index), np.int64)
        order = np.argsort(blocks, kind="stable")
        edges = np.flatnonzero(np.diff(blocks[order], prepend=-1))
        for first, end in zip(edges.tolist(), [*edges[1:].tolist(), len(index)]):
            rows = order[first:end]
            block = int(blocks[rows[0]])
            start = int(self.samples[block])
            stop = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.highs)
            bits = np.unpackbits(self.highs[start // 8 : stop // 8 + 1], bitorder="little")
            bits[: start % 8] = 0
            position[rows] = np.flatnonzero(bits)[index[rows] % SELECT_EVERY] + start // 8 * 8
        if self.low > 56:
            return (position - index << self.low) | np.array([self._low(i) for i in index.tolist()], np.int64)
        bit = index * self.low
        padded = np.append(self.lows, np.zeros(8, np.uint8))
        word = np.zeros(len(index), np.uint64)
        for k in range((self.low + 14) // 8):
            word |= padded[bit // 8 + k].astype(np.uint64) << np.uint64(8 * k)
        low = word >> (bit % 8).astype(np.uint64) & np.uint64((1 << self.low) - 1)
        return (position - index << self.low) | low.astype(np.int64)

    def values(self) -> np.ndarray:
        """All values, in order."""
        at = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low].reshape(self.n, self.low)
        lows = bits.astype(np.int64) @ (1 << np.arange(self.low, dtype=np.int64))
        return (at - np.arange(self.n) << self.low) + lows


def write_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, chunk_ids: int = CHUNK_IDS) -> None:
    """Tokenise every whole text and write the store below ``path``."""
    width = 2 if load_tokenizer(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    end = end_id.to_bytes(width, "little")
    names = [field.split()[0] for field in STORE_SCHEMA.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int32(), pa.binary()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(WordBpeEncoder, tokenizer_path, "H" if width == 2 else "I")
        shard, chunk, size, doc_ids, parts = TaskContext.get().partitionId(), 0, 0, [], []

        def row() -> pa.RecordBatch:
            ends = np.cumsum([len(p) // width for p in parts])
            values = (shard, chunk, int(ends[-1]), doc_ids, EliasFano.encode(ends).to_bytes(), width, b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

        for got in batches:
            batch_ids = got.column(0).to_pylist()
            for at, texts in text_slices(got.column(1).to_pylist()):
                for doc_id, ids in zip(batch_ids[at : at + len(texts)], encoder.encode_batch(texts)):
                    new = ids + end
                    if parts and size + len(new) // width > chunk_ids:
                        yield row()
                        chunk, size, doc_ids, parts = chunk + 1, 0, [], []
                    doc_ids.append(doc_id)
                    parts.append(new)
                    size += len(new) // width
        if parts:
            yield row()

    wanted = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = wanted.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(encode, STORE_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids of all documents
    before it), n_tokens and ids_crc32 (of its ids as little-endian 32 bits)."""
    schema = "shard long, chunk long, doc_id long, inside long, n_tokens long, ids_crc32 long"
    chunks = spark.read.schema(STORE_SCHEMA).parquet(path)
    # One row per shard: as many as partitions were written.
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    starts = chunks.select("shard", "chunk", F.coalesce(inside, F.lit(0)).alias("inside")).join(shards, "shard")
    starts = starts.select("shard", "chunk", (F.col("shard_start") + F.col("inside")).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for r in got.to_pylist():
                ends = EliasFano.from_bytes(r["ends"]).select_many(np.arange(len(r["doc_ids"])))
                inside = np.append(0, ends[:-1])
                ids = np.frombuffer(r["ids"], f"<u{r['width']}").astype("<u4").tobytes()
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(inside.tolist(), ends.tolist())]
                at = [np.full(len(ends), r[c]) for c in ("shard", "chunk")]
                columns = [*at, pa.array(r["doc_ids"], pa.int64()), inside, ends - inside, crc]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["shard", "chunk", "doc_id", "inside", "n_tokens", "ids_crc32"])

    # Ids are decoded where they are read; only a row a document moves.
    found = chunks.select("shard", "chunk", "doc_ids", "ends", "width", "ids").mapInArrow(decode, schema)
    found = found.join(starts, ["shard", "chunk"])
    return found.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_documents(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """(doc_id, ids) of the stored documents with one of the given ids: two selects a
    document cut its ids out of its chunk; other documents are not decoded."""
    wanted = frozenset(doc_ids)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in batches:
            for r in got.to_pylist():
                at = np.array([k for k, doc_id in enumerate(r["doc_ids"]) if doc_id in wanted], np.int64)
                code = EliasFano.from_bytes(r["ends"])
                ends = code.select_many(at)
                starts = np.where(at > 0, code.select_many(np.maximum(at - 1, 0)), 0)
                ids = np.frombuffer(r["ids"], f"<u{r['width']}")
                found = [ids[a:b].astype(np.int64).tolist() for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays([pa.array([r["doc_ids"][k] for k in at], pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "ids"])

    chunks = spark.read.schema(STORE_SCHEMA).parquet(path)
    chunks = chunks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in wanted])))
    return chunks.select("doc_ids", "ends", "width", "ids").mapInArrow(cut, "doc_id long, ids array<bigint>")
