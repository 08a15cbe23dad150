"""Member 360 feature table (M-1) and its per-source aggregates (A-1..A-4).

Every feature source is filtered on raw columns (so the predicate reaches the
Parquet scan), aggregated to one row per ``member_id`` with partial
(map-side) aggregation, then left-joined to members. Each input is therefore
shuffled exactly once, on ``member_id``; the joins reuse that partitioning.
A member with a huge share of events only costs map-side combine work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import by_key, count_where, flag, ts
from ..spec import CampaignSpec


def listing_features(listings: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-1: history strictly before the campaign instant."""
    return (
        listings.filter(F.col("created_at") < ts(spec.campaign_at))
        .groupBy("member_id")
        .agg(
            F.count(F.lit(1)).alias("historical_listing_count"),
            F.max("created_at").alias("last_listing_at"),
            F.count_if(F.col("sold_at").isNotNull()).alias("historical_sales_count"),
            F.sum(F.coalesce(F.col("sale_value"), F.lit(0).cast("decimal(18,2)"))).alias("historical_gmv"),
        )
    )


def event_features(events: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-2 + J-15: last activity, 30-day counts and the latest category.

    All measures read only events before the instant, so the filter is pushed
    to the scan (last activity and category need the full history before it,
    so no tighter window is safe). The latest category is ``max_by`` over
    ``(event_ts, event_id)`` among categorised events, in the same pass.
    """
    t = ts(spec.campaign_at)
    recent = F.col("event_ts") >= ts(spec.recent_start)
    categorised = F.col("category") != ""  # neither missing nor empty
    return (
        events.filter(F.col("event_ts") < t)
        .groupBy("member_id")
        .agg(
            F.max("event_ts").alias("last_activity_at"),
            count_where(recent).alias("recent_event_count"),
            count_where(recent & (F.col("event_name") == "watchlist_added")).alias("recent_watchlist_count"),
            count_where(recent & (F.col("event_name") == "purchase_completed")).alias("recent_purchase_count"),
            F.max_by(
                F.col("category"),
                F.when(categorised, F.struct("event_ts", "event_id")),
            ).alias("preferred_category"),
        )
    )


def contact_features(touches: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-3: touches of any campaign in ``[t - contact_days, t)``.

    Filtering before the aggregate is safe because an absent member is
    coalesced to 0, exactly like a member whose touches are all outside.
    """
    return (
        touches.filter(
            (F.col("sent_at") >= ts(spec.contact_start)) & (F.col("sent_at") < ts(spec.campaign_at))
        )
        .groupBy("member_id")
        .agg(F.count(F.lit(1)).alias("marketing_contacts_7d"))
    )


def exclusion_features(exclusions: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-4: members with an exclusion interval containing the instant (closed)."""
    t = ts(spec.campaign_at)
    return (
        exclusions.filter((F.col("start_at") <= t) & (F.col("end_at") >= t))
        .groupBy("member_id")
        .agg(F.lit(True).alias("has_active_campaign_exclusion"))
    )


def member_360(
    members: DataFrame,
    listings: DataFrame,
    events: DataFrame,
    touches: DataFrame,
    exclusions: DataFrame,
    spec: CampaignSpec,
    event_rollup: DataFrame | None = None,
) -> DataFrame:
    """M-1..M-4: one row per member with features, six rule flags, status.

    With ``event_rollup`` (see ``rollup.py``) the event features are read
    from the hourly rollup plus the raw edge hours instead of all events.
    """
    from .rollup import event_features_from_rollup
    from .audience import eligibility_columns

    zero = F.lit(0).cast("bigint")
    base = (
        members.select(
            "member_id", "joined_at", "region", "preferred_channel",
            "email_consent", "push_consent", "is_suppressed",
        )
        .join(by_key(listing_features(listings, spec)), "member_id", "left")
        .join(by_key(event_features(events, spec) if event_rollup is None
                     else event_features_from_rollup(event_rollup, events, spec)), "member_id", "left")
        .join(by_key(contact_features(touches, spec)), "member_id", "left")
        .join(by_key(exclusion_features(exclusions, spec)), "member_id", "left")
    )
    feat = base.select(
        "member_id", "joined_at", "region", "preferred_channel",
        "email_consent", "push_consent", "is_suppressed",
        F.coalesce("historical_listing_count", zero).alias("historical_listing_count"),
        "last_listing_at",
        F.coalesce("historical_sales_count", zero).alias("historical_sales_count"),
        F.coalesce("historical_gmv", F.lit(0).cast("decimal(28,2)")).alias("historical_gmv"),
        "last_activity_at",
        F.coalesce("recent_event_count", zero).alias("recent_event_count"),
        F.coalesce("recent_watchlist_count", zero).alias("recent_watchlist_count"),
        F.coalesce("recent_purchase_count", zero).alias("recent_purchase_count"),
        F.coalesce("marketing_contacts_7d", zero).alias("marketing_contacts_7d"),
        flag(F.col("has_active_campaign_exclusion")).alias("has_active_campaign_exclusion"),
        "preferred_category",
    )
    cutoff = ts(spec.lapsed_cutoff)
    flags = feat.select(
        "*",
        (F.col("historical_listing_count") >= 1).alias("has_seller_history"),
        flag(F.col("last_listing_at") <= cutoff).alias("is_lapsed_seller"),
        (F.col("recent_event_count") >= 1).alias("has_recent_activity"),
        flag(F.col("email_consent") | F.col("push_consent")).alias("has_marketing_consent"),
        (F.col("marketing_contacts_7d") < spec.contact_cap).alias("within_contact_cap"),
        (~F.col("has_active_campaign_exclusion")).alias("has_no_campaign_conflict"),
    )
    return flags.select("*", *eligibility_columns())
