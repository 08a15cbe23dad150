"""Prefix trie of conversations by SQL ROLLUP over positional turns.

A conversation is cut into blocks of ``width`` turns, one row a block, with a
column group for each position: the turn's digest (128 bits over position, role
and text) and the bytes of its text. A block's key is the prefix before it, the
exclusive-or of its digests: the node of the prior block in which it continues.
So one ``GROUP BY block, key, ROLLUP (positions)`` aggregates all prefixes of
all conversations together, however long, and the bits of ``grouping_id`` give a
node's place in its block.

Subtrees need no descent. A conversation is the smallest member of the nodes of
its path below some depth, its fork, and of none above: the first rollup finds
the nodes it owns, hence its fork, and whether it ends in a leaf that it owns.
The second one sums over the members of a node: leaves are the members that end
in a leaf of their own, children the members whose path goes on while their fork
is not below the node, and of a turn's copies each member but the smallest saves
what lies between the node and its fork.

Turns are numbered by sorting ranges, not by collecting a conversation, and
prefixes are combined block by block, so a conversation with most of all rows
spreads over tasks. A node's members that end there are joined in chunks of ids
and hashed as a stream.

Order is by turn, null first, then by the turn's digest. Null role or text
counts as empty. Rows without conv_id belong to no conversation. Repeated rows
are turns of their own. An empty table has no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import Scratch

WIDTH = 4  # turns a block
RUN = 4096  # blocks whose prefixes one window combines
CHUNK_BITS = 12  # of the ids joined into one row before hashing


def _signed(digest: Column, first: int) -> Column:
    """16 hexadecimal digits as a signed 64-bit integer."""
    return F.conv(F.substring(digest, first, 16), 16, -10).cast("long")


def numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos from 1, hi, lo: digest of role and text, bytes of the text)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"), text.alias("text"))
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turns = turns.select("conv_id", "turn", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes"))
    turns = turns.select("conv_id", "turn", _signed(F.col("digest"), 1).alias("hi"), _signed(F.col("digest"), 17).alias("lo"), "bytes")
    order = [F.col("turn").asc_nulls_first(), F.col("hi"), F.col("lo")]
    # The row number tells repeated rows apart, so that they need not share a range.
    ranged = turns.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange("conv_id", *order, "copy")
    ranged = scratch.write(ranged.withColumn("shard", F.spark_partition_id()), "ranged")
    before = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("conv_id", "shard").agg(F.count(F.lit(1)).alias("n"))  # a row a shard and conversation
    counts = counts.select("conv_id", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("conv_id", "shard").orderBy(*order, "copy"))
    placed = ranged.withColumn("place", place).join(counts, ["conv_id", "shard"])
    return scratch.write(placed.select("conv_id", (F.col("before") + F.col("place")).alias("pos"), "hi", "lo", "bytes"), "numbered")


def rebuilt_turns(turns: DataFrame, group: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation c after the first h = crc32(c) % ``heads`` turns of
    conversation c - c % ``group`` and without its own first h turns. Also a row
    with null pos for every conversation, so that none is lost without turns."""
    all_ids = turns.select("conv_id").distinct()
    convs = all_ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int").alias("h"))
    first = turns.where(F.col("pos") < heads).groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "hi", "lo", "bytes"))).alias("first"))
    convs = convs.join(first, "base", "left").select("conv_id", "h", F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast(first.schema["first"].dataType)).alias("head"))
    shared = convs.select("conv_id", F.inline("head"))
    own = turns.join(convs.select("conv_id", "h", F.size("head").alias("shift")), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("shift")).alias("pos"), "hi", "lo", "bytes")
    marks = all_ids.select("conv_id", *[F.lit(None).cast("long").alias(c) for c in ("pos", "hi", "lo", "bytes")])
    return shared.unionByName(own).unionByName(marks)


def _blocks(turns: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """One row a block: its positions, the prefix before it and the whole path."""
    digest = F.sha2(F.concat_ws(":", "pos", "hi", "lo"), 256)
    turns = turns.select("conv_id", "pos", F.when(F.col("pos").isNotNull(), digest).alias("digest"), "bytes")
    turns = turns.select("conv_id", "pos", _signed(F.col("digest"), 1).alias("h"), _signed(F.col("digest"), 17).alias("l"), F.col("bytes").alias("n"))
    block = F.coalesce(F.floor((F.col("pos") - 1) / width), F.lit(0)).cast("long")
    slots = [F.max(F.when((F.col("pos") - 1) % width == s, F.col(c))).alias(f"{c}{s + 1}") for s in range(width) for c in "hln"]
    zero = F.lit(0).cast("long")
    sums = [F.coalesce(F.bit_xor("h"), zero).alias("xh"), F.coalesce(F.bit_xor("l"), zero).alias("xl"), F.coalesce(F.sum("n"), zero).alias("xn"), F.count("pos").alias("xt")]
    blocks = turns.groupBy("conv_id", block.alias("block")).agg(*slots, *sums)
    blocks = scratch.write(blocks.withColumn("run", F.floor(F.col("block") / RUN)), "blocks")
    # Prefixes in two levels: runs of blocks, then blocks within their run.
    runs = blocks.groupBy("conv_id", "run").agg(F.bit_xor("xh").alias("xh"), F.bit_xor("xl").alias("xl"), F.sum("xn").alias("xn"), F.sum("xt").alias("xt"))
    whole, up_to = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)

    def before(window: Window, prefix: str) -> list[Column]:
        return [F.coalesce(f(c).over(window), zero).alias(prefix + c) for f, c in ((F.bit_xor, "xh"), (F.bit_xor, "xl"), (F.sum, "xn"))]

    ends = [F.bit_xor("xh").over(whole).alias("end_h"), F.bit_xor("xl").over(whole).alias("end_l"), F.sum("xn").over(whole).alias("total"), F.sum("xt").over(whole).alias("len")]
    runs = runs.select("conv_id", "run", *before(up_to, "run_"), *ends)
    inside = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("*", *before(inside, "in_")).join(runs, ["conv_id", "run"])
    key = [F.col("run_xh").bitwiseXOR(F.col("in_xh")).alias("key_h"), F.col("run_xl").bitwiseXOR(F.col("in_xl")).alias("key_l"), (F.col("run_xn") + F.col("in_xn")).alias("key_n")]
    return scratch.write(blocks.select("conv_id", "block", *key, *[f"{c}{s + 1}" for s in range(width) for c in "hln"], "len", "total", "end_h", "end_l"), "paths")


def _rollup(paths: DataFrame, width: int, aggregates: str) -> DataFrame:
    """The aggregates of every node, with its depth, id, the bytes of its last turn
    and those above it (from key_n, if aggregated)."""
    slots = range(1, width + 1)
    positions = ", ".join(f"(h{s}, l{s}, n{s})" for s in slots)
    rolled = paths.sparkSession.sql(
        f"""
        SELECT block, key_h, key_l, {", ".join(f"h{s}, l{s}, n{s}" for s in slots)},
               {width} - bit_count(grouping_id()) DIV 3 AS level, {aggregates}
        FROM {{paths}} GROUP BY block, key_h, key_l, ROLLUP ({positions})
        """,
        paths=paths,
    )

    def last(c: str) -> Column:
        return F.coalesce(*[F.when(F.col("level") == s, F.col(f"{c}{s}")) for s in slots])

    def node(c: str) -> Column:
        found = F.col(f"key_{c}")
        for s in slots:
            found = found.bitwiseXOR(F.coalesce(F.col(f"{c}{s}"), F.lit(0).cast("long")))
        return found

    # A conversation that ends within a block has null positions; the node before a
    # block is the last one of the prior block.
    rolled = rolled.where(((F.col("level") == 0) & (F.col("block") == 0)) | last("h").isNotNull())
    inner = sum((F.coalesce(F.col(f"n{s}"), F.lit(0)) for s in slots), F.lit(0).cast("long"))
    return rolled.select(
        "*", (F.col("block") * width + F.col("level")).cast("long").alias("depth"), node("h").alias("node_h"), node("l").alias("node_l"),
        last("h").alias("last_h"), last("l").alias("last_l"), F.coalesce(last("n"), F.lit(0)).cast("long").alias("last_n"), inner.alias("inner_n"),
    )


def _end_digests(convs: DataFrame) -> DataFrame:
    """(depth, node_h, node_l, ends_sha256) of nodes where conversations end."""
    key = ["depth", "node_h", "node_l"]
    ids = convs.groupBy(*key, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = ids.select(*key, "chunk", F.array_join(F.transform("ids", lambda c: c.cast("string")), ",").alias("joined"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sha = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([v], pa.int64()) for v in current], pa.array([sha.hexdigest()])], [*key, "ends_sha256"])

        for got in batches:
            for *node, joined in zip(*(got.column(k).to_pylist() for k in (0, 1, 2, 4))):
                if node != current:
                    if current is not None:
                        yield row()
                    current, sha = node, hashlib.sha256(joined.encode())
                else:
                    sha.update(b"," + joined.encode())
        if current is not None:
            yield row()

    sorted_chunks = chunks.repartition(*key).sortWithinPartitions(*key, "chunk")
    return sorted_chunks.mapInArrow(digest, "depth long, node_h long, node_l long, ends_sha256 string")


def prefix_trie(turns: DataFrame, scratch: Scratch, width: int = WIDTH) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. ``turns`` has conv_id, pos
    (from 1, without gaps; null for a conversation as such), hi, lo and bytes."""
    paths = _blocks(turns, width, scratch)
    convs = paths.where("block = 0").select("conv_id", "len", "total", F.col("len").alias("depth"), F.col("end_h").alias("node_h"), F.col("end_l").alias("node_l"))
    first = _rollup(paths, width, "min(conv_id) AS conv_id, max(len) AS longest")
    owned = first.groupBy("conv_id").agg(
        (F.min("depth") - 1).alias("fork"), F.sum("last_n").alias("owned"), F.max(F.when(F.col("depth") == F.col("longest"), 1).otherwise(0)).alias("leaf")
    )
    owned = scratch.write(owned, "owned")
    known = paths.join(owned, "conv_id", "left").select(
        *[c for c in paths.columns if c not in ("total", "end_h", "end_l")],
        F.coalesce("fork", "len").alias("fork"), (F.col("total") - F.coalesce("owned", F.lit(0))).alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
    )
    here = [f"block * {width} + {s}" for s in range(width + 1)]
    children = ", ".join(f"count_if(fork <= {d} AND {d} < len) AS c{s}" for s, d in enumerate(here))
    sums = "min(conv_id) AS conv_id, count(*) AS n_convs, sum(leaf) AS n_leaves, sum(shared) AS shared, min(shared) AS least, min(fork) AS fork, max(key_n) AS key_n"
    nodes = _rollup(known, width, f"{sums}, {children}")
    above = F.col("key_n") + F.col("inner_n") - F.col("last_n")
    zero = F.lit(0).cast("long")
    nodes = nodes.select(
        "conv_id", "depth", "node_h", "node_l", "n_convs", "n_leaves", "fork",
        F.element_at(F.array(*[f"c{s}" for s in range(width + 1)]), (F.col("level") + 1).cast("int")).alias("n_children"),
        (F.col("shared") - F.col("least") - (F.col("n_convs") - 1) * above).alias("saved_tokens"),
        F.col("node_h").bitwiseXOR(F.coalesce("last_h", zero)).alias("up_h"), F.col("node_l").bitwiseXOR(F.coalesce("last_l", zero)).alias("up_l"),
    )
    nodes = scratch.write(nodes, "nodes")
    # Below its fork a path's smallest member is the same; at the fork the parent has another.
    forks = nodes.where("fork = depth - 1")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node_h").alias("up_h"), F.col("node_l").alias("up_l"), F.col("conv_id").alias("parent_conv_id"))
    forks = forks.join(up, ["depth", "up_h", "up_l"], "left")
    nodes = forks.unionByName(nodes.where("fork < depth - 1").withColumn("parent_conv_id", F.col("conv_id")))
    nodes = nodes.join(_end_digests(convs), ["depth", "node_h", "node_l"], "left")
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame, group: int = 5, heads: int = 9, width: int = WIDTH) -> DataFrame:
    """The trie of the conversations rebuilt upon shared heads (see ``rebuilt_turns``)."""
    scratch = Scratch(conversations.sparkSession, "conversation-trie")
    turns = scratch.write(rebuilt_turns(numbered_turns(conversations, scratch), group, heads), "rebuilt")
    return prefix_trie(turns, scratch, width)
