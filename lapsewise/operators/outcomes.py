"""Intention-to-treat outcomes (M-7, M-8) and per-arm results (M-9, M-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ts
from ..spec import CampaignSpec


def post_campaign_listings(listings: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-5: listings created in the closed outcome window ``[t, outcome_end]``."""
    return (
        listings.filter(
            (F.col("created_at") >= ts(spec.campaign_at)) & (F.col("created_at") <= ts(spec.outcome_end))
        )
        .groupBy("member_id")
        .agg(
            F.count(F.lit(1)).alias("listing_count_14d"),
            F.count_if(F.col("sold_at").isNotNull()).alias("sold_listing_count_14d"),
            F.sum(F.coalesce(F.col("sale_value"), F.lit(0).cast("decimal(18,2)"))).alias("observed_gmv_14d"),
        )
    )


def campaign_response(touches: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-6: sends and responses of the target campaign only."""
    return (
        touches.filter(F.col("campaign_id") == spec.campaign_id)
        .groupBy("member_id")
        .agg(
            F.count_if(F.col("sent_at").isNotNull()).alias("message_sent_count"),
            F.count_if(F.col("opened_at").isNotNull()).alias("message_open_count"),
            F.count_if(F.col("clicked_at").isNotNull()).alias("message_click_count"),
            F.count_if(F.col("unsubscribed_at").isNotNull()).alias("unsubscribe_count"),
        )
    )


OUTCOME_COUNTS = (
    "listing_count_14d", "sold_listing_count_14d", "message_sent_count",
    "message_open_count", "message_click_count", "unsubscribe_count",
)


def experiment_member_outcomes(
    audience: DataFrame,
    assignments: DataFrame,
    listings: DataFrame,
    touches: DataFrame,
    spec: CampaignSpec,
) -> DataFrame:
    """M-7: one row per assigned audience member (J-3 inner, J-4/J-5 left)."""
    zero = F.lit(0).cast("bigint")
    joined = (
        audience.select("member_id", "region", "activation_channel", "preferred_category")
        .join(
            assignments.filter(F.col("experiment_id") == spec.experiment_id).select(
                "member_id", "experiment_id", "variant", "assigned_at"
            ),
            "member_id",
        )
        .join(post_campaign_listings(listings, spec), "member_id", "left")
        .join(campaign_response(touches, spec), "member_id", "left")
    )
    return joined.select(
        "member_id", "region", "activation_channel", "preferred_category",
        "experiment_id", "variant", "assigned_at",
        (F.coalesce(F.col("listing_count_14d"), zero) >= 1).alias("converted_14d"),
        F.coalesce("listing_count_14d", zero).alias("listing_count_14d"),
        F.coalesce("sold_listing_count_14d", zero).alias("sold_listing_count_14d"),
        F.coalesce("observed_gmv_14d", F.lit(0).cast("decimal(28,2)")).alias("observed_gmv_14d"),
        *[F.coalesce(c, zero).alias(c) for c in OUTCOME_COUNTS[2:]],
    )


def _pct(num: F.Column, den: F.Column) -> F.Column:
    return F.round(F.lit(100.0) * num / F.nullif(den, F.lit(0)), 2)


def experiment_results(outcomes: DataFrame, spec: CampaignSpec | None = None) -> DataFrame:
    """M-9/M-10: one row per (experiment, arm). Rates are NULL without sends."""
    g = outcomes.groupBy("experiment_id", "variant").agg(
        F.count(F.lit(1)).alias("assigned_members"),
        F.count_if("converted_14d").alias("converted_members"),
        F.sum("listing_count_14d").alias("total_listings_14d"),
        F.sum("observed_gmv_14d").alias("observed_gmv_14d"),
        F.sum("message_sent_count").alias("message_sent_count"),
        F.sum("message_click_count").alias("message_click_count"),
        F.sum("unsubscribe_count").alias("unsubscribe_count"),
    )
    return g.select(
        "experiment_id", "variant", "assigned_members", "converted_members",
        _pct(F.col("converted_members"), F.col("assigned_members")).alias("conversion_rate_pct"),
        "total_listings_14d", "observed_gmv_14d", "message_sent_count", "message_click_count",
        _pct(F.col("message_click_count"), F.col("message_sent_count")).alias("click_rate_pct"),
        "unsubscribe_count",
        _pct(F.col("unsubscribe_count"), F.col("message_sent_count")).alias("unsubscribe_rate_pct"),
    )
