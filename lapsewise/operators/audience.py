"""Eligibility rules, activation channel and the eligible audience (M-2..M-6),
plus the funnel and category distribution report tables (R-1, R-2).

One ordered rule list drives ``eligibility_status`` (first failed rule),
``is_eligible`` (conjunction) and the funnel (running conjunction), so the
three can never diverge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import all_of, ts
from ..spec import CampaignSpec


@dataclass(frozen=True)
class Rule:
    stage: str  # funnel label once the rule is applied
    reason: str  # eligibility_status when this is the first failed rule
    predicate: str  # SQL over member_360 columns; true = passes

    def col(self) -> Column:
        return F.expr(self.predicate)


# Funnel labels and failure reasons, in rule order.
FIRST_STAGE = "All members"
ELIGIBILITY_RULES: tuple[Rule, ...] = (
    Rule("Seller history", "no_seller_history", "has_seller_history"),
    Rule("Lapsed 90+ days", "not_lapsed_90d", "is_lapsed_seller"),
    Rule("Recently active", "no_recent_activity_30d", "has_recent_activity"),
    Rule("Marketing consent", "no_marketing_consent", "has_marketing_consent"),
    Rule("Not suppressed", "suppressed", "NOT is_suppressed"),
    Rule("Within contact cap", "contact_cap_reached", "within_contact_cap"),
    Rule("No campaign conflict", "campaign_conflict", "has_no_campaign_conflict"),
)
ELIGIBLE = "eligible"
UNKNOWN_CATEGORY = "Unknown"


def eligibility_columns(rules: tuple[Rule, ...] = ELIGIBILITY_RULES) -> list[Column]:
    status = F.coalesce(*[F.when(~r.col(), F.lit(r.reason)) for r in rules], F.lit(ELIGIBLE))
    return [status.alias("eligibility_status"), all_of([r.col() for r in rules]).alias("is_eligible")]


def activation_channel(spec: CampaignSpec) -> Column:
    """M-5: preferred channel if consented, else email if consented, else push."""
    return (
        F.when((F.col("preferred_channel") == "email") & F.col("email_consent"), F.lit("email"))
        .when((F.col("preferred_channel") == "push") & F.col("push_consent"), F.lit("push"))
        .when(F.col("email_consent"), F.lit("email"))
        .otherwise(F.lit("push"))
    )


AUDIENCE_COLUMNS = (
    "member_id", "region", "activation_channel", "preferred_category",
    "historical_listing_count", "historical_sales_count", "historical_gmv",
    "last_listing_at", "last_activity_at", "recent_event_count",
    "recent_watchlist_count", "recent_purchase_count", "marketing_contacts_7d",
    "campaign_id", "audience_created_at",
)


def eligible_audience(m360: DataFrame, spec: CampaignSpec) -> DataFrame:
    """M-6: eligible members with channel and campaign constants (F-5, P-9)."""
    return (
        m360.filter(F.col("is_eligible"))
        .withColumn("activation_channel", activation_channel(spec))
        .withColumn("campaign_id", F.lit(spec.campaign_id))
        .withColumn("audience_created_at", ts(spec.campaign_at))
        .select(*AUDIENCE_COLUMNS)
    )


def audience_sample(audience: DataFrame, columns: tuple[str, ...], n: int = 50) -> DataFrame:
    """S-14 / O-1: the first ``n`` audience rows by member id (a top-k)."""
    return audience.select(*columns).orderBy("member_id").limit(n)


def funnel(m360: DataFrame, rules: tuple[Rule, ...] = ELIGIBILITY_RULES) -> DataFrame:
    """R-1 / A-14: members surviving each cumulative rule, in one scan.

    One aggregate with a ``count_if`` per running conjunction, then unpivot;
    the ``share_of_all`` ratio is computed on the one-row aggregate.
    """
    conds: list[Column] = [F.lit(True)]
    for r in rules:
        conds.append(conds[-1] & r.col())
    labels = [FIRST_STAGE] + [r.stage for r in rules]
    counts = m360.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(conds)])
    stages = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("stage_order"),
                F.lit(label).alias("stage"),
                F.col(f"n{i}").alias("members"),
            )
            for i, label in enumerate(labels)
        ]
    )
    rows = counts.select(F.col("n0").alias("_all"), F.inline(stages))
    return rows.select(
        "stage_order",
        "stage",
        "members",
        F.round(F.col("members") / F.nullif(F.col("_all"), F.lit(0)), 6).alias("share_of_all"),
    )


def category_distribution(audience: DataFrame) -> DataFrame:
    """R-2 / A-13: audience members per category (NULL -> 'Unknown'), share of largest."""
    counts = audience.groupBy(
        F.coalesce(F.col("preferred_category"), F.lit(UNKNOWN_CATEGORY)).alias("category")
    ).agg(F.count(F.lit(1)).alias("members"))
    # The largest count is a scalar subquery (one partial+final aggregate),
    # not a join: every category row just divides by one number.
    top = counts.agg(F.max("members"))
    return counts.select(
        "category", "members", F.round(F.col("members") / top.scalar(), 6).alias("share_of_largest")
    ).orderBy(F.col("members").desc(), F.col("category"))  # O-3 on a category-sized table


def eligibility_status_counts(m360: DataFrame) -> DataFrame:
    return m360.groupBy("eligibility_status").agg(F.count(F.lit(1)).alias("members"))
