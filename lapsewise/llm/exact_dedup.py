"""Exact deduplication as a stateful stream, without Python on the data path.

Every row's normalised text gets a SHA-256 digest. The digests run through a
Structured Streaming aggregation whose keyed state lives in RocksDB, is
checkpointed to the shared folder and never expires: per digest it retains the
smallest stable identifier, the content locator of that row (its number in the
staged copy: part file and position) and how many rows had the digest. Copies
meet in map-side partial aggregates first, so a group that holds a third of
all rows costs one row a task. The state itself is then read as a table.

A digest seen more than once is a hit: each such row's full normalised text is
compared with the text at the retained locator. Rows that differ (a digest
collision) are grouped again by their full text.

Null text counts as empty. Equal texts are ordered by ``doc_id``, nulls last,
then by row, so of repeated rows one stays; a group whose ids are all null has
a null ``keep_id``. An empty table gives an empty result. Other columns, of any
name, are carried inside a struct and never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import Scratch

WHITE_SPACE = r"[\x20\x09-\x0D]+"
# Input of one micro-batch: bounds what a restarted batch repeats.
TRIGGER_BYTES = 16 << 30
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Many small stores: files take the space they need, none in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, " ")


def first_of(doc_id: Column, row: Column) -> Column:
    """Smallest doc_id (nulls last), then smallest row."""
    return F.min(F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"), row.alias("row")))


def digest_index(spark: SparkSession, path: str, scratch: Scratch, trigger_bytes: int = TRIGGER_BYTES) -> DataFrame:
    """Stream (digest, doc_id, row) files through keyed state; the state as a table:
    digest, first (no_id, doc_id, row), group_size."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        stream = (
            spark.readStream.schema("digest binary, doc_id long, row long")
            .option("maxBytesPerTrigger", trigger_bytes)
            .parquet(path)
            .groupBy("digest")
            .agg(first_of(F.col("doc_id"), F.col("row")).alias("first"), F.count(F.lit(1)).alias("group_size"))
        )
        query = (
            stream.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .option("checkpointLocation", scratch.path("state")).start()
        )
        query.awaitTermination()
        progressed = query.lastProgress is not None and spark.read.format("state-metadata").load(scratch.path("state")).count() > 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not progressed:  # an empty table starts no batch
        return spark.createDataFrame([], "digest binary, first struct<no_id: boolean, doc_id: long, row: long>, group_size long")
    state = spark.read.format("statestore").load(scratch.path("state"))
    first, size = [f.name for f in state.schema["value"].dataType.fields][:2]
    state = state.select("key.digest", F.col(f"value.`{first}`").alias("first"), F.col(f"value.`{size}`").alias("group_size"))
    return scratch.write(state, "index")


def decisions(docs: DataFrame, digest_bits: int = 256, trigger_bytes: int = TRIGGER_BYTES) -> tuple[DataFrame, DataFrame]:
    """The staged rows (doc, row, digest) and, per row: row, doc_id, keep_id,
    group_size, kept, text_sha256. ``digest_bits`` shorter than 256 shortens the
    state's key only; hits are told apart by their full text all the same."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact-dedup")
    sha = F.sha2(normalised(F.col("text")), 256)
    staged = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        sha.alias("text_sha256"),
        F.unhex(F.substring(sha, 1, digest_bits // 4)).alias("digest"),
    )
    staged = scratch.write(staged, "rows")
    scratch.write(staged.select("digest", "doc_id", "row"), "digests")
    index = digest_index(spark, scratch.path("digests"), scratch, trigger_bytes)

    shared = index.where("group_size > 1").select("digest", F.col("first.row").alias("keep_row"))
    text = normalised(F.col("doc.text")).alias("text")
    hits = scratch.write(staged.select("digest", "doc_id", "row", text).join(shared, "digest"), "hits")
    held = hits.where("row = keep_row").select("digest", F.col("text").alias("held_text"))
    collided = scratch.write(hits.join(held, "digest").where("text <> held_text").select("digest").distinct(), "collided")
    apart = hits.join(collided, "digest", "left_semi")
    classes = apart.groupBy("digest", "text").agg(first_of(F.col("doc_id"), F.col("row")).alias("own_first"), F.count(F.lit(1)).alias("own_size"))
    classes = scratch.write(classes, "classes")
    apart = scratch.write(apart.join(classes, ["digest", "text"]).select("row", "own_first", "own_size"), "apart")

    found = staged.select("row", "doc_id", "digest", "text_sha256").join(index, "digest").join(apart, "row", "left")
    first = F.coalesce("own_first", "first")
    return staged, found.select(
        "row", "doc_id", first["doc_id"].alias("keep_id"), F.coalesce("own_size", "group_size").alias("group_size"),
        (F.col("row") == first["row"]).alias("kept"), "text_sha256",
    )


def duplicate_groups(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    return decisions(docs, **options)[1].drop("row")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    staged, found = decisions(docs, **options)
    return staged.join(found.where("kept").select("row"), "row", "left_semi").select("doc.*")
