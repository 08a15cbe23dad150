"""Incremental event rollup for member 360 (N-6 applied to A-2 / J-15).

Re-reading every raw event for each campaign run is the heaviest step at
scale. The hourly rollup keeps one row per (member, hour) with the partial
aggregates the event features need. It is refreshed by date partition
(dynamic partition overwrite) as events land, and ``event_features_from_rollup``
answers the features from it. The result is exact: every hour lying wholly
inside a window is read from the rollup, and the partial hours at the
window edges (when the instant is not on the hour) come from a slice of raw
events that pushes down to the scan. A member with many events collapses to
one row per active hour.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ts
from ..sources.versioned import VersionedStore
from ..spec import CampaignSpec
from .monitoring import hour_bucket, write_incremental

WATCH, PURCHASE = "watchlist_added", "purchase_completed"


def _latest_category(cond=None):
    """max over struct(ts, id, category) of categorised events = the latest one."""
    named = F.col("category") != ""  # neither missing nor empty
    c = named if cond is None else named & cond
    return F.max(F.when(c, F.struct("event_ts", "event_id", "category")))


def event_hourly_rollup(events: DataFrame) -> DataFrame:
    """(member_id, hour) -> counts, last event time, latest categorised event."""
    return events.groupBy("member_id", hour_bucket("event_ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("event_name") == WATCH).alias("n_watchlist"),
        F.count_if(F.col("event_name") == PURCHASE).alias("n_purchase"),
        F.max("event_ts").alias("last_event_ts"),
        _latest_category().alias("latest_category"),
    )


def refresh_rollup(events: DataFrame, path: str, dates: list[str] | None = None) -> None:
    """Recompute the rollup for the given event dates (all when None) and
    overwrite only those date partitions."""
    if dates is None:
        rollup = event_hourly_rollup(events).withColumn("event_date", F.to_date("hour"))
        rollup.write.mode("overwrite").partitionBy("event_date").parquet(path)
        return
    ev = events.filter(F.to_date("event_ts").isin(*dates))
    write_incremental(event_hourly_rollup(ev), path, "hour", date_col="event_date", dates=dates)


class RollupStore(VersionedStore):
    """The rollup fed by new event files only (N-6).

    A batch adds the partial aggregates of its own events, of whatever dates they
    are: counts add up and maxima are maxima, so late events need no date to be read
    again. Events that are withdrawn need ``refresh_rollup`` of their dates instead.
    """

    partition, cluster = "event_date", ("hour",)
    schema = T.StructType([
        T.StructField("member_id", T.StringType()), T.StructField("hour", T.TimestampNTZType()),
        *[T.StructField(c, T.LongType()) for c in ("n_events", "n_watchlist", "n_purchase")],
        T.StructField("last_event_ts", T.TimestampNTZType()),
        T.StructField("latest_category", T.StructType([
            T.StructField("event_ts", T.TimestampNTZType()), T.StructField("event_id", T.StringType()), T.StructField("category", T.StringType())])),
        T.StructField("version", T.LongType()), T.StructField("event_date", T.DateType()),
    ])

    def merge(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("n_events", "n_watchlist", "n_purchase")]
        maxima = [F.max(c).alias(c) for c in ("last_event_ts", "latest_category", "version")]
        return rows.groupBy("member_id", "hour", "event_date").agg(*sums, *maxima)


def add_events(spark: SparkSession, events: DataFrame, writer: str, batch_id: int, root: str) -> None:
    """Add a batch of new events to the rollup, once however often it is delivered."""
    store = RollupStore(spark, root)
    store.commit(event_hourly_rollup(events).withColumn("event_date", F.to_date("hour")), writer, batch_id)
    store.compact()


def start_rollup_stream(events: DataFrame, root: str, checkpoint: str, trigger: dict | None = None):
    """Feed the rollup from a stream of event files: its checkpoint knows which files
    were read, so a refresh reads the new ones only and finds their dates itself."""
    spark = events.sparkSession

    def handle(batch: DataFrame, epoch_id: int) -> None:
        add_events(spark, batch, spark.sparkContext.getLocalProperty("sql.streaming.queryId"), epoch_id, root)

    writer = events.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _floor_hour(t: datetime) -> datetime:
    return t.replace(minute=0, second=0, microsecond=0)


def _ceil_hour(t: datetime) -> datetime:
    f = _floor_hour(t)
    return f if f == t else f + timedelta(hours=1)


def event_features_from_rollup(rollup: DataFrame, events: DataFrame, spec: CampaignSpec) -> DataFrame:
    """Same output as ``features.event_features``, computed from the rollup.

    Hours in ``[ceil(r), floor(t))`` (recent counts) and ``< floor(t)``
    (last activity, category) come from the rollup. Raw events fill only
    ``[r, ceil(r))`` and ``[floor(t), t)``. Both are empty when the instant is
    on the hour.
    """
    t, r = spec.campaign_at, spec.recent_start
    t0, r1 = _floor_hour(t), _ceil_hour(r)
    hours = rollup.filter(F.col("hour") < ts(t0))
    in_recent = F.col("hour") >= ts(r1)
    from_rollup = hours.select(
        "member_id",
        F.col("last_event_ts").alias("_last"),
        F.when(in_recent, F.col("n_events")).otherwise(0).alias("_n"),
        F.when(in_recent, F.col("n_watchlist")).otherwise(0).alias("_w"),
        F.when(in_recent, F.col("n_purchase")).otherwise(0).alias("_p"),
        F.col("latest_category").alias("_cat"),
    )
    # raw edges: [r, ceil(r)) counts as recent; [floor(t), t) counts and is history
    edge = events.filter(
        ((F.col("event_ts") >= ts(r)) & (F.col("event_ts") < ts(r1)))
        | ((F.col("event_ts") >= ts(t0)) & (F.col("event_ts") < ts(t)))
    )
    recent = F.col("event_ts") >= ts(r)
    late_edge = F.col("event_ts") >= ts(t0)
    from_edges = edge.groupBy("member_id").agg(
        F.max(F.when(late_edge, F.col("event_ts"))).alias("_last"),
        F.count_if(recent).alias("_n"),
        F.count_if(recent & (F.col("event_name") == WATCH)).alias("_w"),
        F.count_if(recent & (F.col("event_name") == PURCHASE)).alias("_p"),
        _latest_category(late_edge).alias("_cat"),
    )
    parts = from_rollup.unionByName(from_edges)
    agg = parts.groupBy("member_id").agg(
        F.max("_last").alias("last_activity_at"),
        F.sum("_n").alias("recent_event_count"),
        F.sum("_w").alias("recent_watchlist_count"),
        F.sum("_p").alias("recent_purchase_count"),
        F.max("_cat").alias("_cat"),
    )
    return agg.select(
        "member_id", "last_activity_at",
        *[F.col(c).cast("bigint").alias(c) for c in ("recent_event_count", "recent_watchlist_count",
                                                      "recent_purchase_count")],
        F.col("_cat.category").alias("preferred_category"),
    )
