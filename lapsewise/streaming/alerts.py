"""Monitoring signals as streams: unsubscribes (N-3) and conversion freshness (N-4).

Touches and conversions arrive in files of any order. Hour buckets are a stateful
aggregation by event time: a late row updates its bucket as long as the watermark
has not passed it, and ``delay`` says how long that is. Every micro-batch commits
the buckets it changed to a versioned table whose newest row counts, so readers see
whole batches and a batch that comes again changes nothing. The signals are read
from the buckets by the batch forms' own arithmetic.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ts
from ..operators.monitoring import (CUMULATIVE_UNSUBSCRIBE_LIMIT, FRESHNESS_LIMIT_HOURS, conversion_freshness,
                                    cumulative_rates)
from ..sources.versioned import VersionedStore
from ..spec import CampaignSpec


class HourStore(VersionedStore):
    """Counts by campaign and hour; of several versions the newest counts."""

    partition, cluster = "campaign_id", ("bucket",)
    schema = T.StructType([
        T.StructField("bucket", T.TimestampNTZType()), T.StructField("sent", T.LongType()), T.StructField("unsubscribed", T.LongType()),
        T.StructField("version", T.LongType()), T.StructField("campaign_id", T.StringType()),
    ])

    def merge(self, rows: DataFrame) -> DataFrame:
        values = [F.max_by(c, "version").alias(c) for c in ("sent", "unsubscribed")]
        return rows.groupBy("bucket", "campaign_id").agg(*values, F.max("version").alias("version"))


class FeedStore(VersionedStore):
    """The newest record's time of every feed."""

    partition = "feed"
    schema = T.StructType([T.StructField("latest", T.TimestampNTZType()), T.StructField("version", T.LongType()), T.StructField("feed", T.StringType())])

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("feed").agg(F.max("latest").alias("latest"), F.max("version").alias("version"))


def _start(updates: DataFrame, store: VersionedStore, checkpoint: str, trigger: dict | None):
    spark = updates.sparkSession

    def handle(batch: DataFrame, epoch_id: int) -> None:
        store.commit(batch, spark.sparkContext.getLocalProperty("sql.streaming.queryId"), epoch_id)
        store.compact()

    writer = updates.writeStream.outputMode("update").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def start_unsubscribe_stream(touches: DataFrame, root: str, checkpoint: str, spec: CampaignSpec, delay: str, trigger: dict | None = None):
    """Count the campaign's sends and unsubscribes by hour; ``touches`` is a stream."""
    moments = touches.filter(F.col("campaign_id") == spec.campaign_id).select("campaign_id", F.inline(F.array(
        F.struct(F.col("sent_at").alias("moment"), F.lit(1).alias("sent"), F.lit(0).alias("unsubscribed")),
        F.struct(F.col("unsubscribed_at").alias("moment"), F.lit(0).alias("sent"), F.lit(1).alias("unsubscribed")))))
    # Watermarks need instants: wall-clock times stand for themselves in UTC, whatever
    # the session's zone is, and come back from the windows the same way.
    epoch = ts("1970-01-01 00:00:00")
    moments = moments.filter("moment IS NOT NULL").withColumn("moment", F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, F.col("moment"))))
    hours = moments.withWatermark("moment", delay).groupBy("campaign_id", F.window("moment", "1 hour").alias("hour")).agg(
        F.sum("sent").cast("bigint").alias("sent"), F.sum("unsubscribed").cast("bigint").alias("unsubscribed"))
    start = F.timestamp_add("MICROSECOND", F.unix_micros(F.col("hour.start")), epoch)
    buckets = hours.select("campaign_id", start.alias("bucket"), "sent", "unsubscribed")
    return _start(buckets, HourStore(touches.sparkSession, root), checkpoint, trigger)


def unsubscribe_alerts(spark: SparkSession, root: str, limit: float = CUMULATIVE_UNSUBSCRIBE_LIMIT) -> DataFrame:
    """The cumulative rates of ``cumulative_unsubscribe`` from what has arrived."""
    return cumulative_rates(HourStore(spark, root).read().select("campaign_id", "bucket", "sent", "unsubscribed"), limit)


def start_freshness_stream(conversions: DataFrame, time_col: str, feed: str, root: str, checkpoint: str, until: datetime | None = None,
                           trigger: dict | None = None):
    """Keep the time of a feed's newest record (not after ``until``, if given)."""
    rows = conversions if until is None else conversions.filter(F.col(time_col) <= F.lit(until).cast("timestamp_ntz"))
    latest = rows.groupBy(F.lit(feed).alias("feed")).agg(F.max(time_col).alias("latest"))
    return _start(latest, FeedStore(conversions.sparkSession, root), checkpoint, trigger)


def freshness_alert(spark: SparkSession, root: str, feed: str, as_of: datetime, limit_hours: int = FRESHNESS_LIMIT_HOURS) -> DataFrame:
    """``conversion_freshness`` from what has arrived; a feed never seen is a breach."""
    return conversion_freshness(FeedStore(spark, root).read(F.col("feed") == feed), "latest", as_of, limit_hours)
