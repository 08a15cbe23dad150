"""Near-duplicate documents by SimHash, found with a byte-position inverted index.

Two 64-bit fingerprints that differ in at most 3 bits share at least 5 of their
8 positional bytes: the guaranteed minimum of the count filter. Of 5 positions,
3 lie in the first or in the last half, so posting lists are kept for every 3
positions of a half with their bytes (8 lists for a fingerprint) and every pair
that reaches the minimum meets in one. Inside a list the shared bytes of a pair
are tallied, pairs below the minimum go, and the rest are verified by their bit
distance. A list of more than ``LONG`` fingerprints is replaced by lists for 2
more positions each, the minimum itself, which hold 2**24 at most.

Copies count once: lists hold distinct fingerprints. A list never gives its
pairs, only its components, as stars around their smallest member, found by a
breadth-first search over packed arrays; in a very long list a fingerprint
looks up its possible neighbours instead of all others, so the work for each is
bounded. The stars of all lists together have the components of all links.

Null and empty texts have fingerprint zero and are linked like any other. A
null ``doc_id`` belongs to its component but never names it (a component whose
ids are all null has a null ``component_id``). Repeated rows share a
fingerprint. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch
from .components import components
from .exact_dedup import first_of

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
_BYTES = 8
LONG = 1 << 20  # fingerprints of a list that one task takes
SEARCH_FROM = 1 << 16  # list length from which neighbours are looked up


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: A-Z lower-cased, words between white space, word
    shingles hashed with XXH64; a bit is set if it is in over half the hashes."""
    from xxhash import xxh64_digest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(end + 1 for end in ends[: len(words) - k])]
    hashes = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :])])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, _BYTES), axis=1)
    over_half = 2 * bits.sum(axis=0, dtype=np.uint32) > len(bits)
    return int.from_bytes(np.packbits(over_half).tobytes(), "big")


def _masks(sets: list[tuple[int, ...]]) -> list[int]:
    return [sum(0xFF << 8 * p for p in positions) for positions in sets]


def list_masks(max_distance: int) -> list[int]:
    """Masks of the lists: every set of positions inside one half that a pair with
    the minimum of shared bytes is sure to share."""
    shared = -(-(_BYTES - max_distance) // 2)
    halves = range(_BYTES // 2), range(_BYTES // 2, _BYTES)
    return _masks([chosen for half in halves for chosen in combinations(half, shared)])


def long_masks(mask: int, max_distance: int) -> list[int]:
    """Masks that stand in for one that is shared too often: with as many more
    positions as the minimum asks for."""
    have = [p for p in range(_BYTES) if mask >> 8 * p & 1]
    free = [p for p in range(_BYTES) if p not in have]
    return _masks([(*have, *more) for more in combinations(free, _BYTES - max_distance - len(have))])


def near(differing: np.ndarray, max_distance: int) -> np.ndarray:
    """Which XORs belong to links: tally the shared bytes, then count the bits."""
    shared = (differing.view(np.uint8).reshape(-1, _BYTES) == 0).sum(axis=1)
    found = shared >= _BYTES - max_distance
    found[found] = np.bitwise_count(differing[found]) <= max_distance
    return found


def _flips(mask: int, max_distance: int) -> np.ndarray:
    free = [1 << b for b in range(64) if not mask >> b & 1]
    return np.array([sum(c) for k in range(1, max_distance + 1) for c in combinations(free, k)], np.uint64)


def stars(members: np.ndarray, mask: int, max_distance: int) -> list[tuple[int, int]]:
    """The components of the links among the sorted, distinct fingerprints of a
    list, as pairs (smallest member, other member)."""
    edges: list[tuple[int, int]] = []
    if len(members) > SEARCH_FROM:
        flips, seen = _flips(mask, max_distance), np.zeros(len(members), bool)
        for root in range(len(members)):
            queue = [] if seen[root] else [root]
            seen[root] = True
            while queue:
                wanted = members[queue.pop()] ^ flips
                place = np.minimum(np.searchsorted(members, wanted), len(members) - 1)
                found = place[(members[place] == wanted) & ~seen[place]]
                seen[found] = True
                queue.extend(found.tolist())
                edges.extend((int(members[root]), int(members[f])) for f in found)
        return edges
    left = members
    while len(left) > 1:
        root, queue, left = int(left[0]), [left[0]], left[1:]
        while queue and len(left):
            linked = near(left ^ queue.pop(), max_distance)
            if linked.any():
                queue.extend(left[linked])
                edges.extend((root, f) for f in left[linked].tolist())
                left = left[~linked]
    return edges


def _links(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, fingerprint), sorted by mask, masked bytes and fingerprint."""
    held_mask, held = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def runs(masks: np.ndarray, prints: np.ndarray, whole: bool) -> tuple[list, int]:
        key = prints & masks
        new = np.flatnonzero((masks[1:] != masks[:-1]) | (key[1:] != key[:-1])) + 1
        begins = np.append(0, new)
        ends = np.append(new, len(masks))
        if not whole:
            begins, ends = begins[:-1], ends[:-1]
        edges: list[tuple[int, int]] = []
        pairs = begins[ends - begins == 2]
        close = pairs[near(prints[pairs] ^ prints[pairs + 1], max_distance)]
        edges.extend(zip(prints[close].tolist(), prints[close + 1].tolist()))
        for a, b in zip(begins[ends - begins > 2].tolist(), ends[ends - begins > 2].tolist()):
            edges.extend(stars(np.sort(prints[a:b]), int(masks[a]), max_distance))
        return edges, int(ends[-1]) if len(ends) else 0

    def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = np.array(edges, np.uint64).view(np.int64).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        masks = np.append(held_mask, batch.column(0).to_numpy().view(np.uint64))
        prints = np.append(held, batch.column(1).to_numpy().view(np.uint64))
        edges, done = runs(masks, prints, False)
        held_mask, held = masks[done:], prints[done:]
        if edges:
            yield out(edges)
    if len(held):
        edges, _ = runs(held_mask, held, True)
        if edges:
            yield out(edges)


def fingerprints(rows: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, row, print) of (doc_id, row, text); the print is a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle_words) for t in batch.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "row", "print"])

    wanted = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "row", F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(hashed, "doc_id long, row long, print long")


def groups(rows: DataFrame, scratch: Scratch, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE, long_list: int = LONG) -> DataFrame:
    """(doc_id, row, print, first) of (doc_id, row, text): ``first`` is the smallest
    (no_id, doc_id, row) of the row's component."""
    prints = scratch.write(fingerprints(rows, shingle_words), "prints")
    distinct = prints.groupBy("print").agg(first_of(F.col("doc_id"), F.col("row")).alias("own"))
    distinct = scratch.write(distinct, "distinct")

    signed = [np.uint64(m).astype(np.int64).item() for m in list_masks(max_distance)]
    postings = distinct.select(F.explode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("mask"), "print")
    key = F.col("mask").bitwiseAND(F.col("print"))
    lengthy = postings.groupBy("mask", key.alias("key")).count().where(F.col("count") > long_list).select("mask", "key")
    lengthy = scratch.write(lengthy, "long-lists")
    keyed = postings.withColumn("key", key)
    short = keyed.join(lengthy, ["mask", "key"], "left_anti").select("mask", "print")
    more = F.create_map(*[x for m, s in zip(list_masks(max_distance), signed) for x in (
        F.lit(s).cast("long"), F.array(*[F.lit(np.uint64(n).astype(np.int64).item()).cast("long") for n in long_masks(m, max_distance)]))])
    split = keyed.join(lengthy, ["mask", "key"], "left_semi").select(F.explode(F.element_at(more, F.col("mask"))).alias("mask"), "print").distinct()
    ordered = short.unionByName(split).repartition("mask", key).sortWithinPartitions("mask", key, "print")
    edges = ordered.mapInArrow(lambda batches: _links(batches, max_distance), "a long, b long")

    nodes = components(edges, scratch)
    nodes = scratch.write(nodes.join(distinct, F.col("node") == F.col("print")).select("print", "label", "own"), "nodes")
    best = scratch.write(nodes.groupBy("label").agg(F.min("own").alias("first")), "best")
    linked = nodes.join(best, "label").select("print", "first")
    named = distinct.join(linked, "print", "left").select("print", F.coalesce("first", "own").alias("first"))
    named = scratch.write(named, "named")
    return prints.join(named, "print")


def near_duplicate_groups(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    found = groups(rows, scratch, **options)
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with their columns, that come first in their component."""
    scratch = Scratch(docs.sparkSession, "simhash")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    staged = scratch.write(docs.select(whole, F.monotonically_increasing_id().alias("row")), "rows")
    found = groups(staged.select("doc.doc_id", "row", "doc.text"), scratch, **options)
    return staged.join(found.where("first.row = row").select("row"), "row", "left_semi").select("doc.*")
