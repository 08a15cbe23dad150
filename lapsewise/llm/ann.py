"""Approximate nearest neighbours by cross-polytope hashing with multiprobe.

A vector is normalised and sent through three rounds of random signs and a fast
Hadamard transform (a pseudo-rotation); its cell in a table is the signed axis
it lies nearest to. Every vector is indexed in every table. A query looks into
the cells of its ``probes`` nearest signed axes in each table, and what it
finds there is ranked by exact Euclidean distance in double precision. A query
that finds fewer than k identifiers so is compared with all vectors of its length.

Cells are cut into blocks of bounded size by a hash of the identifier, so a
cell that holds a third of all vectors (a very common vector) is many blocks;
the block's vectors are one matrix of a task, the queries that probe the cell
stream past it, and only a query's best few leave the task. No pair of query
and candidate becomes a row.

Vectors that are null, zero, or hold a null or non-finite component take no
part, nor do rows without an identifier. Vectors of another length than the
query's are no candidates. Ties go to the smaller identifier; equal rows count
once, and of different vectors of one identifier the nearest is the candidate. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import Scratch

TABLES = 4
PROBES = 32  # of the 2 * dimension cells of a table; recall is measured in the tests
BLOCK = 16_384  # vectors
NEIGHBOURS = 10
SEED = 20_240_607
_BATCH = 256  # queries compared with a block at once


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row (length a power of two), unscaled."""
    rows, size = x.shape
    step = 1
    while step < size:
        x = x.reshape(rows, -1, 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, size)
        step *= 2
    return x


def rotated(vectors: np.ndarray, table: int, seed: int = SEED) -> np.ndarray:
    """Pseudo-rotated unit vectors, padded with zeros to a power of two."""
    size = 1 << max(1, (vectors.shape[1] - 1).bit_length())
    x = np.zeros((len(vectors), size))
    x[:, : vectors.shape[1]] = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    signs = np.random.default_rng([seed, table, size]).choice([-1.0, 1.0], (3, size))
    for s in signs:
        x = hadamard(x * s) / np.sqrt(size)
    return x


def cells(x: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first: axis i is
    cell 2 i, its opposite 2 i + 1."""
    sides = np.stack([x, -x], axis=2).reshape(len(x), -1)
    probes = min(probes, sides.shape[1])
    found = np.argpartition(-sides, probes - 1, axis=1)[:, :probes]
    order = np.argsort(-np.take_along_axis(sides, found, axis=1), axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of a batch's usable vectors, one length at a time."""
    ids, rows = batch.column(0), batch.column(1)
    lengths = np.array(rows.value_lengths().fill_null(0))
    flat = rows.flatten()
    missing = np.array(flat.is_null())
    values = np.array(flat.fill_null(0).cast(pa.float64()))
    begins = np.cumsum(lengths) - lengths
    ids_valid = np.array(ids.is_valid())
    ids = np.array(ids.fill_null(0))
    for length in np.unique(lengths[lengths > 0]):
        own = np.flatnonzero((lengths == length) & ids_valid)
        if not len(own):
            continue
        at = begins[own][:, None] + np.arange(length)
        matrix = values[at]
        good = ~missing[at].any(axis=1) & np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        if good.any():
            yield ids[own[good]], matrix[good]


def _cell_rows(vectors: DataFrame, tables: int, probes: int, seed: int) -> DataFrame:
    """(cell, id, vector) for the ``probes`` nearest cells of each table. A cell's
    number holds vector length, table and axis."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in _by_length(batch):
                rows = pa.array(list(matrix), pa.list_(pa.float64()))
                for table in range(tables):
                    found = cells(rotated(matrix, table, seed), probes)
                    cell = (matrix.shape[1] << 32) + (table << 24) + found.ravel().astype(np.int64)
                    at = pa.array(np.repeat(np.arange(len(ids)), found.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ids).take(at), rows.take(at)], ["cell", "id", "vector"])

    return vectors.mapInArrow(place, "cell long, id long, vector array<double>")


def _best(ids: np.ndarray, block: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query, id, distance) of each query's k nearest identifiers of a block, which
    is sorted by identifier. A matrix product finds all rows that can be among
    them, differences give their distance."""
    square = (block * block).sum(axis=1)
    near = square - 2 * queries @ block.T + (queries * queries).sum(axis=1, keepdims=True)
    own = query_ids[:, None] == ids
    near[own] = np.inf
    out = []
    slack = 1e-9 * (1 + square.max() + (queries * queries).sum(axis=1).max())
    firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    by_id = near if len(firsts) == len(ids) else np.minimum.reduceat(near, firsts, axis=1)
    last = np.partition(by_id, min(k, by_id.shape[1]) - 1, axis=1)[:, min(k, by_id.shape[1]) - 1]
    for q, row, bound in zip(range(len(queries)), near, last):
        at = np.flatnonzero((row <= bound + slack) & ~own[q])
        distance = np.sqrt(((block[at] - queries[q]) ** 2).sum(axis=1))
        order = np.lexsort((ids[at], distance))
        if by_id is not near:
            order = order[np.sort(np.unique(ids[at][order], return_index=True)[1])]
        order = order[:k]
        out.extend(zip([int(query_ids[q])] * len(order), ids[at][order].tolist(), distance[order].tolist()))
    return out


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (cell, block, is_query, id, vector) sorted so: a block's vectors come
    before the queries that probe it. One block is held at a time."""
    at, ids, rows = None, [], []
    held: tuple | None = None

    for batch in batches:
        keys = np.stack([np.array(batch.column(c)).astype(np.int64) for c in range(3)])
        begins = np.flatnonzero(np.r_[True, (np.diff(keys) != 0).any(axis=0)])
        ends = np.append(begins[1:], batch.num_rows)
        found = []
        for a, b in zip(begins.tolist(), ends.tolist()):
            key, is_query = (int(keys[0, a]), int(keys[1, a])), keys[2, a]
            part = batch.slice(a, b - a)
            matrix = np.array(part.column(4).flatten()).reshape(b - a, -1)
            part_ids = np.array(part.column(3))
            if not is_query:
                if key != at:
                    at, ids, rows, held = key, [], [], None
                ids.append(part_ids)
                rows.append(matrix)
            elif key == at:
                if held is None:
                    order = np.argsort(np.concatenate(ids), kind="stable")
                    held = np.concatenate(ids)[order], np.concatenate(rows)[order]
                for c in range(0, len(part_ids), _BATCH):
                    found.extend(_best(*held, part_ids[c : c + _BATCH], matrix[c : c + _BATCH], k))
        if found:
            q, i, d = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(d)], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, tables: int = TABLES, probes: int = PROBES,
            block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row of
    ``queries`` among ``vectors``, both (id, vector); rows with the query's own
    identifier are no candidates."""
    scratch = Scratch(vectors.sparkSession, "ann")
    vectors, queries = vectors.distinct(), queries.distinct()
    index = scratch.write(_cell_rows(vectors, tables, 1, seed), "index")
    found = scratch.write(_ranked(index, _cell_rows(queries, tables, probes, seed), k, block, scratch, "sizes"), "found")
    columns = ["query_id", "rank", "vec_id", "score"]
    length = F.shiftleft(F.shiftright("cell", 32), 32)
    enough = found.where(F.col("found") >= k).select(*columns)
    few = queries.toDF("id", "vector").join(enough.where("rank = 1").select(F.col("query_id").alias("id")), "id", "left_anti")
    few = scratch.write(_cell_rows(few, 1, 1, seed).withColumn("cell", length), "few")
    if few.isEmpty():
        return enough
    # Every vector is in one cell of table 0: a length's vectors are one cell now.
    whole = index.where(F.shiftright("cell", 24).bitwiseAND(0xFF) == 0).withColumn("cell", length)
    whole = whole.join(few.select("cell").distinct(), "cell", "left_semi")
    return enough.unionByName(_ranked(whole, few, k, block, scratch, "lengths").select(*columns))


def _ranked(index: DataFrame, probing: DataFrame, k: int, block: int, scratch: Scratch, name: str) -> DataFrame:
    """(query_id, vec_id, score, found, rank): each query's k nearest of the cells it
    probes, and how many identifiers its blocks gave; both are (cell, id, vector)."""
    # One row a cell: 2 * dimension * tables for each vector length.
    sizes = index.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    sizes = scratch.write(sizes, name)
    placed = index.join(sizes, "cell")
    placed = placed.select("cell", F.pmod(F.xxhash64("id", "vector"), F.col("blocks")).cast("int").alias("block"), F.lit(False).alias("is_query"), "id", "vector")
    probing = probing.join(sizes, "cell")
    probing = probing.select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("is_query"), "id", "vector")
    both = placed.unionByName(probing).repartition("cell", "block").sortWithinPartitions("cell", "block", "is_query")
    found = both.mapInArrow(lambda batches: _search(batches, k), "query_id long, vec_id long, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    of_query = Window.partitionBy("query_id")
    found = found.withColumn("found", F.count(F.lit(1)).over(of_query))
    return found.withColumn("rank", F.row_number().over(of_query.orderBy("score", "vec_id"))).where(F.col("rank") <= k)
