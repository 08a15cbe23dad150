"""Removal of repeated substrings by bucket-pointer refinement.

Every byte that lies in a ``span``-byte string which also starts anywhere else
(another document, or another place of the same one) is removed. No suffix
array of the whole corpus is built; positions are put into buckets, buckets are
refined by the buckets of later offsets, and a position leaves as soon as its
bucket has no other member or only members that agree on all that matters.

* A bucket's identifier is a 64-bit name that depends on its bytes alone, so
  every task names a bucket alike and no pointer has to be fetched. A position's
  initial bucket is its q-gram, q = span / 4. Its bucket of 2q bytes is named
  after the buckets at the position and q later, that of 4q bytes (the span)
  after the 2q-buckets at the position and 2q later: refinement by bucket
  identifiers of later offsets, with the results of one round used in the next.
* Of the q-grams in a span-long window, the one with the smallest identifier
  (the leftmost, if equal) is the window's anchor. Equal windows have the same
  anchor at the same place, so only anchors, about 2 of 3q / 1 positions, are
  sorted into q-gram buckets over all documents; buckets with one member end.
* An anchor's windows are neighbours. The second refinement sorts by the span
  buckets of its first and last window: members that agree have all windows in
  common, and those windows are repeated.
* Only where members of a q-gram bucket disagree, one member for each different
  surrounding has its windows sorted one by one, by two independent names. A
  bucket with up to ``CLASS`` different surroundings does so inside one task,
  to which the bytes of the surroundings go; the windows of a larger one are
  counted by a grouping over all tasks, whose partial counts absorb a passage
  that a third of all documents share.

Joins on hot buckets are between written tables, so that adaptive execution can
split them; groupings combine map-side. Rows are told apart by ``doc_id`` and a
hash of the text; a repeated row is one more place where its strings start.
A task works on slices of its batches: arrays over a slice's positions take about
100 bytes for each byte of text, ``SLICE`` bytes (or one longer text) at a time.
Null text counts as empty, a null ``doc_id`` is an id like any other, texts
shorter than the span and empty tables come back whole. Other columns, of any
name, are carried inside a struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .chunk_ids import release_encoders
from .common import Scratch

SPAN = 200
CLASS = 8192  # different surroundings of a q-gram that one task holds
SLICE = 400_000  # bytes of texts, side by side, whose positions a task holds at once
ROWS = 1000  # rows of a batch that a task takes as Python objects at once
SURROUNDINGS = 2000  # surroundings whose windows a task names at once
_POSITION = 30  # bits of a position inside one buffer
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, one a family of names
_KEY = "doc_id long, text_hash long"


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the MurmurHash3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of a bucket from the names of its two halves."""
    return _mix(a * np.uint64(0x9FB21C651E98DF25) + (b ^ np.uint64(0x2545F4914F6CDD1D)))


def gram_names(data: np.ndarray, q: int, family: int = 0) -> np.ndarray:
    """The name of the q-gram at every position of ``data`` (uint8)."""
    base, size = _BASES[family], len(data) - q + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    block, length, found, have = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        power = np.uint64(pow(base, length, 1 << 64))
        if q & length:
            found = block[:size].copy() if found is None else found * power + block[have : have + size]
            have += length
        if have == q:
            return _mix(found)
        block = block[:-length] * power + block[length:]
        length *= 2


def span_names(grams: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    """The name of the 4q bytes at the given positions, refined twice."""
    return _pair(_pair(grams[at], grams[at + q]), _pair(grams[at + 2 * q], grams[at + 3 * q]))


def anchors(data: np.ndarray, starts: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    """Anchors of texts that lie side by side in ``data``, text i from
    ``starts[i]`` to ``starts[i + 1]``: q-gram name, name of the surrounding,
    text, first window (inside the text) and number of further windows."""
    q = span // 4
    width = span - q + 1
    windows = len(data) - span + 1
    if windows <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    grams = gram_names(data, q)
    keys = (grams >> np.uint64(_POSITION) << np.uint64(_POSITION)) | np.arange(len(grams), dtype=np.uint64)
    rows = -(-len(keys) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max)
    padded[: len(keys)] = keys
    padded = padded.reshape(rows, width)
    later = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()[:windows]
    earlier = np.minimum.accumulate(padded, axis=1).ravel()[width - 1 : width - 1 + windows]
    smallest = (np.minimum(later, earlier) & np.uint64((1 << _POSITION) - 1)).astype(np.int64)
    inside = np.concatenate([np.arange(a, max(a, b - span + 1)) for a, b in zip(starts[:-1], starts[1:])])
    if not len(inside):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    smallest = smallest[inside]
    first = np.flatnonzero(np.diff(smallest, prepend=-1))
    last = np.append(first[1:], len(inside)) - 1
    low, high, at = inside[first], inside[last], smallest[first]
    around = _pair(span_names(grams, low, q), span_names(grams, high, q))
    around = _pair(around, ((high - low) << 32 | (at - low)).astype(np.uint64))
    text = np.searchsorted(starts, at, side="right") - 1
    return grams[at].view(np.int64), around.view(np.int64), text, low - starts[text], high - low


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _buffers(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts) for slices of a batch's texts, as they lie in the batch."""
    texts = batch.column(column).fill_null("").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE, side="right")) - 1)
        yield at, data[ends[at] : ends[to]], ends[at : to + 1] - ends[at]
        at = to


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _same_document(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])


def _surroundings(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Rows (wide, gram, doc_id, text_hash, at, bytes) of (doc_id, text_hash, text,
    anchors): the bytes of all windows of each anchor. Of ``at``, 2 bits are the
    weight (2: the surrounding occurs elsewhere), 16 the number of further windows."""
    names = ["wide", "gram", "doc_id", "text_hash", "at", "bytes"]
    types = [pa.bool_(), *[pa.int64()] * 4, pa.binary()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in _parts(batches, ROWS):
        rows = []
        for doc_id, text_hash, text, own in zip(*(batch.column(k).to_pylist() for k in range(4))):
            data = text.encode()
            for a in own:
                low, more = a["at"] >> 18, a["at"] >> 2 & 0xFFFF
                rows.append((a["wide"], a["gram"], doc_id, text_hash, a["at"], data[low : low + more + span]))
            if len(rows) > 5_000:
                yield out(rows)
                rows = []
        if rows:
            yield out(rows)


def _window_names(batch: pa.RecordBatch, span: int) -> tuple[np.ndarray, ...]:
    """Of rows (gram, doc_id, text_hash, at, bytes), for every window: its names in
    both families, its row, its first byte in the text."""
    found = []
    for first in range(0, batch.num_rows, SURROUNDINGS):
        rows = batch.slice(first, SURROUNDINGS)
        at, parts = np.array(rows.column(3)), rows.column(4).to_pylist()
        q, low, more = span // 4, at >> 18, at >> 2 & 0xFFFF
        data = np.frombuffer(b"".join(parts), np.uint8)
        row = np.repeat(np.arange(len(at)), more + 1)
        inside = np.arange(len(row)) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
        begins = np.cumsum(more + span) - more - span
        names = [span_names(gram_names(data, q, family), begins[row] + inside, q) for family in (0, 1)]
        found.append((*names, row + first, low[row] + inside))
    return tuple(np.concatenate(c) for c in zip(*found))


def _repeated_inside(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Spans (doc_id, text_hash, span) of rows (gram, doc_id, text_hash, at, bytes)
    sorted by gram: whole buckets are compared in memory."""

    def spans(rows: pa.RecordBatch) -> pa.RecordBatch:
        first, second, row, start = _window_names(rows, span)
        weight = np.array(rows.column(3))[row] & 3
        order = np.lexsort((second, first))
        new = np.r_[True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)]
        total = np.add.reduceat(weight[order], np.flatnonzero(new))
        found = np.zeros(len(row), bool)
        found[order] = total[np.cumsum(new) - 1] > 1
        found &= weight == 1
        row, start = row[found], start[found]
        begin = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(start, prepend=-9) != 1))
        end = np.append(begin[1:], len(row)) - 1
        packed = start[begin] << 32 | start[end] + span if len(row) else np.zeros(0, np.int64)
        at = pa.array(row[begin] if len(row) else np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([rows.column(1).take(at), rows.column(2).take(at), pa.array(packed)], ["doc_id", "text_hash", "span"])

    held: list[pa.RecordBatch] = []
    for batch in _parts(batches, SURROUNDINGS):
        gram = np.array(batch.column(0))
        changes = np.flatnonzero(np.diff(gram)) + 1
        if held and len(gram) and held[-1].column(0)[-1].as_py() != gram[0]:
            changes = np.append(0, changes)
        if len(changes):
            cut = int(changes[-1])
            whole = pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()
            for some in whole:
                yield spans(some)
            held = [batch.slice(cut)]
        elif batch.num_rows:
            held.append(batch)
    if held:
        for some in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield spans(some)


def _each_window(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    names = ["first_name", "second_name", "weight", "doc_id", "text_hash", "start"]
    for rows in _parts(batches, SURROUNDINGS):
        first, second, row, start = _window_names(rows, span)
        key = [rows.column(c).take(pa.array(row)) for c in (1, 2)]
        weight = np.array(rows.column(3))[row] & 3
        arrays = [pa.array(first.view(np.int64)), pa.array(second.view(np.int64)), pa.array(weight), *key, pa.array(start)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def repeated_spans(docs: DataFrame, span: int = SPAN, class_size: int = CLASS) -> DataFrame:
    """doc_id, text_hash and ``spans``: first byte << 32 | end, unordered and
    overlapping, of all repeated strings of a document that has any."""
    if span < 8 or span % 4:
        raise ValueError("span must be a multiple of 4, 8 or more")
    q = span // 4
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    texts = _keyed(docs)

    def first_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_encoders()
        for batch in batches:
            for _, data, starts in _buffers(batch, 0):
                grams, counts = np.unique(anchors(data, starts, span)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(counts)], ["gram", "n"])

    def all_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, starts in _buffers(batch, 2):
                gram, around, text, low, more = anchors(data, starts, span)
                key = [batch.column(k).take(pa.array(row + text)) for k in (0, 1)]
                arrays = [pa.array(gram), pa.array(around), *key, pa.array(low << 16 | more)]
                yield pa.RecordBatch.from_arrays(arrays, ["gram", "around", "doc_id", "text_hash", "at"])

    shared = texts.select("text").mapInArrow(first_buckets, "gram long, n long")
    shared = scratch.write(shared.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"), "shared")
    found = texts.mapInArrow(all_anchors, f"gram long, around long, {_KEY}, at long").join(shared, "gram")
    found = scratch.write(found, "anchors")

    groups = found.groupBy("gram", "around").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "at")).alias("one")
    )
    groups = scratch.write(groups, "groups")
    mixed = groups.groupBy("gram").count().where("count > 1").select("gram", F.expr(f"count > {class_size}").alias("wide"))
    mixed = scratch.write(mixed, "mixed")
    place = F.expr("one.at * 4 + least(n, 2)").alias("at")
    apart = groups.join(mixed, "gram").select("one.doc_id", "one.text_hash", F.struct("wide", "gram", place).alias("anchor"))
    apart = apart.groupBy("doc_id", "text_hash").agg(F.collect_list("anchor").alias("anchors"))
    texts_apart = texts.join(apart, _same_document(texts, apart)).select(texts["doc_id"], texts["text_hash"], "text", "anchors")
    around = texts_apart.mapInArrow(lambda b: _surroundings(b, span), f"wide boolean, gram long, {_KEY}, at long, bytes binary")
    around = scratch.write(around, "surroundings")

    inside = around.where("NOT wide").drop("wide").repartition("gram").sortWithinPartitions("gram")
    inside = inside.mapInArrow(lambda b: _repeated_inside(b, span), f"{_KEY}, span long")

    each = around.where("wide").drop("wide").mapInArrow(lambda b: _each_window(b, span), f"first_name long, second_name long, weight long, {_KEY}, start long")
    each = scratch.write(each, "windows")
    twice = each.groupBy("first_name", "second_name").agg(F.sum("weight").alias("n")).where("n > 1").select("first_name", "second_name")
    twice = scratch.write(twice, "twice")

    agreeing = found.join(groups.where("n > 1").select("gram", "around"), ["gram", "around"])
    packed = "shiftleft(at div 65536, 32) + at div 65536 + at % 65536"
    agreeing = agreeing.selectExpr("doc_id", "text_hash", f"{packed} + {span} AS span")
    single = each.where("weight = 1").join(twice, ["first_name", "second_name"])
    single = single.selectExpr("doc_id", "text_hash", f"shiftleft(start, 32) + start + {span} AS span")
    return agreeing.unionByName(inside).unionByName(single).groupBy("doc_id", "text_hash").agg(F.collect_set("span").alias("spans"))


def merged(spans: list[int] | None) -> list[tuple[int, int]]:
    """Ascending, maximal runs."""
    runs: list[tuple[int, int]] = []
    for packed in sorted(spans or []):
        a, b = packed >> 32, packed & 0xFFFFFFFF
        if runs and a <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(b, runs[-1][1])
        else:
            runs.append((a, b))
    return runs


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def removal_report(docs: DataFrame, span: int = SPAN, class_size: int = CLASS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and the
    SHA-256 of the bytes that remain."""
    texts, spans = _keyed(docs), repeated_spans(docs, span, class_size)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, ROWS):
            rows = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data, runs = (text or "").encode(), merged(own)
                digest = hashlib.sha256(without(data, runs)).hexdigest()
                rows.append((len(data), sum(b - a for a, b in runs), len(runs), digest))
            a, b, c, d = zip(*rows) if rows else ((),) * 4
            arrays = [batch.column(0), *(pa.array(x, pa.int64()) for x in (a, b, c)), pa.array(d, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = texts.join(spans, _same_document(texts, spans), "left").select(texts["doc_id"], "text", "spans")
    return joined.mapInArrow(report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with every repeated string cut out of ``text``. Bytes of a
    character that a cut went through go with it; ``n_chars``, if there, follows."""
    spans = repeated_spans(docs, span)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    joined = texts.join(spans, _same_document(texts, spans), "left")
    joined = joined.select("doc", F.col("doc.text").cast("string").alias("text"), "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, ROWS):
            new = []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                new.append(without(text.encode(), merged(own)).decode(errors="ignore") if own else text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.string())], ["doc", "left"])

    schema = StructType([StructField("doc", joined.schema["doc"].dataType), StructField("left", StringType())])
    done = joined.mapInArrow(cut, schema)
    new = {"text": F.col("left"), "n_chars": F.length("left").cast(LongType())}
    return done.select(*[(new[c] if c in new else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
