"""Activation sync as a micro-batch stream (T-14).

``writeStream.foreachBatch`` applies the set-based sync (T-5..T-9) to each
micro-batch and commits it to the versioned destination
(``sources/versioned.py``): the batch's log and the rows it created or updated
become visible together, under the stream's own identity and the batch number. A
batch that is delivered again is found in the newest commit and changes nothing;
one that died before its commit left nothing that a reader sees. A stream started
over with a new checkpoint has a new identity and logs beside the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activation import classify, empty_destination, run_summary
from ..session import ensure_checkpoint_dir
from ..sources.versioned import FAN_IN, MembershipStore, sync_into, touched
from ..spec import CampaignSpec


def current_state(spark: SparkSession, root: str, campaigns: list[str] | None = None,
                  buckets: list[int] | None = None) -> DataFrame:
    """The destination, or the given campaigns' and buckets' share of it."""
    return MembershipStore(spark, root).snapshot(campaigns, buckets)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return MembershipStore(spark, root).log()


def sync_batch(spark: SparkSession, batch: DataFrame, stream: str, epoch_id: int, root: str, spec: CampaignSpec,
               fan_in: int = FAN_IN) -> DataFrame:
    """Sync one batch; returns its run summary (of the first delivery)."""
    store = MembershipStore(spark, root, fan_in)
    if store.latest().applied.get(stream, -1) < epoch_id:
        if "seq" not in batch.columns:
            batch = batch.withColumn("seq", F.lit(0).cast("bigint"))
        staged = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lapsewise-stream/{stream}/{epoch_id}/classified"
        # Keys do not depend on the destination.
        current = store.snapshot(*touched(classify(batch, empty_destination(spark), spec)))
        classify(batch, current, spec).write.mode("overwrite").parquet(staged)
        sync_into(store, spark.read.parquet(staged), current, spec, stream, epoch_id, f"{stream}-{epoch_id}")
        store.compact()
    return run_summary(store.log(stream, epoch_id))


def start_sync_stream(records: DataFrame, root: str, checkpoint: str, spec: CampaignSpec, trigger: dict | None = None,
                      fan_in: int = FAN_IN):
    """Start the streaming sync into the destination below ``root``; ``records`` is a
    streaming DataFrame of activation records (optionally with ``seq``)."""
    spark = records.sparkSession

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # the identity that the checkpoint gave the query
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        sync_batch(spark, batch, stream, epoch_id, root, spec, fan_in)

    writer = records.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
