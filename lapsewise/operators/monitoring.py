"""Documented operating policies (N-1..N-7): monitoring alerts, the tracking
plan, incremental writes and the send-time recheck.

Each check is an aggregate over the data it watches. None collects rows,
and none windows over an unbounded table: the cumulative unsubscribe rate
runs over hour buckets, one small table per campaign.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ts
from ..spec import CampaignSpec

# ---------------------------------------------------------------------------
# Alert thresholds and the tracking plan (required properties
# and identity requirement per event), as documented by the reference.
# ---------------------------------------------------------------------------
AUDIENCE_DEVIATION_LIMIT = 0.20
DESTINATION_REJECT_LIMIT = 0.005
CUMULATIVE_UNSUBSCRIBE_LIMIT = 0.01
FRESHNESS_LIMIT_HOURS = 2
TRACKING_PLAN = {
    "session_started": ("event_id", "event_ts", "anonymous_id", "platform"),
    "search_performed": ("event_id", "event_ts", "anonymous_id", "category", "platform"),
    "item_viewed": ("event_id", "event_ts", "anonymous_id", "category", "platform"),
    "watchlist_added": ("event_id", "event_ts", "member_id", "category", "platform"),
    "purchase_completed": ("event_id", "event_ts", "member_id", "category", "platform"),
    "listing_started": ("event_id", "event_ts", "member_id", "category", "platform"),
    "listing_created": ("event_id", "event_ts", "member_id", "category", "source"),
}
GOVERNED_CATEGORY_EVENTS = ("search_performed", "item_viewed", "watchlist_added", "purchase_completed",
                            "listing_started", "listing_created")
FUTURE_CHECK_EVENTS = ("session_started",)


def audience_size_alert(audience: DataFrame, approved_preview: int,
                        limit: float = AUDIENCE_DEVIATION_LIMIT) -> DataFrame:
    """N-1: audience size more than ``limit`` away from the approved preview."""
    n = audience.agg(F.count(F.lit(1)).alias("audience_size"))
    dev = F.abs(F.col("audience_size") - F.lit(approved_preview)) / F.lit(float(approved_preview))
    return n.select("audience_size", F.lit(approved_preview).alias("approved_preview"),
                    dev.alias("deviation"), (dev > limit).alias("alert"))


def destination_reject_alert(log: DataFrame, limit: float = DESTINATION_REJECT_LIMIT) -> DataFrame:
    """N-2: share of rejected records per sync run."""
    g = log.groupBy("run_id").agg(F.count(F.lit(1)).alias("attempted"),
                                  F.count_if(F.col("action") == "rejected").alias("rejected"))
    rate = F.try_divide(F.col("rejected").cast("double"), F.col("attempted"))
    return g.select("*", rate.alias("reject_rate"), F.coalesce(rate > limit, F.lit(False)).alias("alert"))


def exposure_alerts(touches: DataFrame, assignments: DataFrame, spec: CampaignSpec) -> DataFrame:
    """Sends beyond one per member, and touches of control members, in the target
    campaign; any one is an alert. Touches are counted by member before they meet
    the assignments."""
    sent = touches.filter(F.col("campaign_id") == spec.campaign_id).groupBy("campaign_id", "member_id").agg(F.count(F.lit(1)).alias("n"))
    arms = assignments.filter((F.col("experiment_id") == spec.experiment_id) & (F.col("variant") == spec.control_arm))
    known = sent.join(arms.select("member_id", F.lit(True).alias("is_control")).distinct(), "member_id", "left")
    found = known.groupBy("campaign_id").agg(F.sum(F.col("n") - 1).alias("duplicate_sends"),
                                             F.sum(F.when(F.col("is_control"), F.col("n")).otherwise(0)).alias("control_exposure"))
    rows = F.array(*[F.struct(F.lit(c).alias("signal"), F.col(c).alias("rows")) for c in ("duplicate_sends", "control_exposure")])
    return found.select("campaign_id", F.inline(rows)).withColumn("alert", F.col("rows") > 0)


def hour_bucket(c: str) -> Column:
    """Start of the hour of a timestamp_ntz, independent of the session time zone
    (``date_trunc`` would go through the session zone and return a zoned type)."""
    col = F.col(c)
    return F.make_timestamp_ntz(F.year(col), F.month(col), F.dayofmonth(col), F.hour(col), F.lit(0), F.lit(0))


def cumulative_unsubscribe(touches: DataFrame, spec: CampaignSpec,
                           limit: float = CUMULATIVE_UNSUBSCRIBE_LIMIT) -> DataFrame:
    """N-3: cumulative unsubscribe rate of the campaign's sends, per time bucket.

    Sends and unsubscribes are counted per (campaign, bucket) first; the
    running sums then run over that bucket table (bounded by the campaign's
    duration, partitioned by campaign), never over the sends themselves.
    """
    t = touches.filter(F.col("campaign_id") == spec.campaign_id)
    sends = t.groupBy("campaign_id", hour_bucket("sent_at").alias("bucket")).agg(
        F.count(F.lit(1)).alias("sent"))
    unsubs = t.filter(F.col("unsubscribed_at").isNotNull()).groupBy(
        "campaign_id", hour_bucket("unsubscribed_at").alias("bucket")).agg(
        F.count(F.lit(1)).alias("unsubscribed"))
    b = sends.join(unsubs, ["campaign_id", "bucket"], "full").select(
        "campaign_id", "bucket", F.coalesce("sent", F.lit(0)).alias("sent"),
        F.coalesce("unsubscribed", F.lit(0)).alias("unsubscribed"))
    return cumulative_rates(b, limit)


def cumulative_rates(buckets: DataFrame, limit: float = CUMULATIVE_UNSUBSCRIBE_LIMIT) -> DataFrame:
    """Running sends, unsubscribes and their rate from counts per campaign and bucket."""
    run = Window.partitionBy("campaign_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    cum = buckets.select("campaign_id", "bucket", F.sum("sent").over(run).alias("cumulative_sent"),
                   F.sum("unsubscribed").over(run).alias("cumulative_unsubscribed"))
    rate = F.try_divide(F.col("cumulative_unsubscribed").cast("double"), F.col("cumulative_sent"))
    return cum.select("*", rate.alias("cumulative_unsubscribe_rate"),
                      F.coalesce(rate > limit, F.lit(False)).alias("alert"))


def conversion_freshness(conversions: DataFrame, time_col: str, as_of: datetime,
                         limit_hours: int = FRESHNESS_LIMIT_HOURS) -> DataFrame:
    """N-4: hours between the newest conversion record and ``as_of``.

    A missing feed (no rows at all) is a breach, never a silent pass.
    """
    latest = conversions.filter(F.col(time_col) <= ts(as_of)).agg(F.max(time_col).alias("latest_conversion_at"))
    lag_h = F.timestamp_diff("MICROSECOND", F.col("latest_conversion_at"), ts(as_of)) / 3.6e9
    return latest.select("latest_conversion_at", ts(as_of).alias("as_of"), lag_h.alias("lag_hours"),
                         F.coalesce(lag_h > limit_hours, F.lit(True)).alias("breach"))


def tracking_plan_violations(events: DataFrame, as_of: datetime, taxonomy: tuple[str, ...],
                             listings: DataFrame | None = None) -> DataFrame:
    """N-5: per (event_name, check) violation counts in one scan of events.

    Checks: every required property is non-NULL; governed categories come
    from ``taxonomy``; session events are not in the future. With
    ``listings`` given, ``listing_created.source`` must name a listing
    (a keyed aggregate over both sides, no join).
    """
    checks: list[tuple[str, str, Column]] = []
    for name, props in TRACKING_PLAN.items():
        is_name = F.col("event_name") == name
        for p in props:
            checks.append((name, f"{p}_not_null", is_name & F.col(p).isNull()))
        if name in GOVERNED_CATEGORY_EVENTS:
            checks.append((name, "category_governed",
                           is_name & F.col("category").isNotNull() & ~F.col("category").isin(*taxonomy)))
        if name in FUTURE_CHECK_EVENTS:
            checks.append((name, "event_ts_not_in_future", is_name & (F.col("event_ts") > ts(as_of))))
    agg = events.agg(*[F.count_if(c).alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    stack = F.array(*[F.struct(F.lit(n).alias("event_name"), F.lit(k).alias("check_name"),
                               F.col(f"c{i}").alias("violations")) for i, (n, k, _) in enumerate(checks)])
    out = agg.select(F.inline(stack))
    if listings is not None:
        # anti-join as one keyed aggregate over the union of both sides: no
        # join operator, so no broadcast even if a side is constant-folded
        src = events.filter((F.col("event_name") == "listing_created") & F.col("source").isNotNull()).select(
            F.col("source").alias("_k"), F.lit(1).alias("n"), F.lit(False).alias("is_listing"))
        ids = listings.select(F.col("listing_id").alias("_k"), F.lit(0).alias("n"), F.lit(True).alias("is_listing"))
        per_key = src.unionByName(ids).groupBy("_k").agg(F.sum("n").alias("n"), F.max("is_listing").alias("known"))
        orphan = per_key.filter(~F.col("known"))
        out = out.unionByName(orphan.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit("listing_created").alias("event_name"), F.lit("source_resolves_to_listing").alias("check_name"),
            "violations"))
    return out.select("event_name", "check_name", F.col("violations").cast("bigint").alias("violations"))


def write_incremental(df: DataFrame, path: str, time_col: str, date_col: str = "event_date",
                      dates: list[str] | None = None) -> None:
    """N-6: incremental materialisation -- rewrite the dates present in ``df``.

    Dynamic partition overwrite replaces the touched date partitions and keeps
    every other date, so a late batch or a retry never rewrites history. Of the
    ``dates`` a refresh was asked for, those without a row any more (all
    withdrawn) are removed.
    """
    spark = df.sparkSession
    out = df.withColumn(date_col, F.to_date(time_col))
    # per-write option: no session-wide setting is changed
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)
    if not dates:
        return
    filled = {str(r[0]) for r in out.select(date_col).distinct().collect()}  # at most the requested dates
    jvm = spark.sparkContext._jvm
    for date in set(map(str, dates)) - filled:
        gone = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{date_col}={date}")
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)


def send_time_recheck(records: DataFrame, m360_at_send: DataFrame, spec: CampaignSpec) -> DataFrame:
    """N-7: re-validate activation records against member_360 rebuilt at send time.

    ``m360_at_send`` is ``member_360(..., spec.with_(campaign_at=send_at))``;
    its consent, suppression, pressure and conflict flags replace the ones
    captured at audience time, then the ordered validation (T-5) runs again.
    """
    from .activation import validation

    fresh = m360_at_send.select("member_id", "is_suppressed", "within_contact_cap", "has_no_campaign_conflict",
                                "email_consent", "push_consent")
    consent = (F.when(F.col("activation_channel") == "email", F.col("email_consent"))
               .when(F.col("activation_channel") == "push", F.col("push_consent")).otherwise(F.lit(False)))
    base = records.drop("is_suppressed", "within_contact_cap", "has_no_campaign_conflict", "has_channel_consent")
    j = base.join(fresh, "member_id", "left").withColumn("has_channel_consent", consent)
    v = validation(spec)
    return j.select(*base.columns, "is_suppressed", "within_contact_cap", "has_no_campaign_conflict",
                    "has_channel_consent", v["action"].alias("blocked_action"), v["reason"].alias("blocked_reason"),
                    v.isNull().alias("entry_allowed"))
