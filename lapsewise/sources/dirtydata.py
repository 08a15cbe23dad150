"""A deliberately broken copy of the test warehouse.

Every rule and declared test must find something here. Each break is a filter or
a changed column on the rows of one of 18 buckets (``WIDTH`` of the 256 first
bytes of the MD5 of the row's key); the oracle breaks the same rows by its own SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import days
from ..operators.quality import Tables
from .testdata import TestWarehouse

WIDTH = 14
EARLY_DAYS = 20_000  # far before any member joined


def bucket_bounds(bucket: int) -> tuple[str, str]:
    """First and last MD5 prefix (two hex digits) of a bucket."""
    return f"{(bucket - 1) * WIDTH:02x}", f"{bucket * WIDTH - 1:02x}"


def hit(key: str, bucket: int) -> Column:
    return F.substring(F.md5(key), 1, 2).between(*bucket_bounds(bucket))


def _broken(df: DataFrame, key: str, changes: dict[str, Column], drop: int | None = None, twice: int | None = None) -> DataFrame:
    """``df`` with columns replaced, the rows of one bucket gone, those of another twice."""
    out = df.withColumns(changes) if changes else df
    if drop is not None:
        out = out.filter(~hit(key, drop))
    return out if twice is None else out.unionByName(out.filter(hit(key, twice)))


def dirty_tables(w: TestWarehouse) -> Tables:
    email, push = F.col("email_consent"), F.col("push_consent")
    spec = w.spec
    raw = {
        "members": _broken(w.members, "member_id", {
            "email_consent": F.when(hit("member_id", 1), ~email).otherwise(email),
            "push_consent": F.when(hit("member_id", 1), ~push).otherwise(push),
            "is_suppressed": F.col("is_suppressed") | hit("member_id", 2)}, drop=3, twice=4),
        "events": _broken(w.events, "event_id", {
            "event_name": F.when(hit("event_id", 1), F.lit("mystery")).otherwise(F.col("event_name")),
            "event_ts": F.when(hit("event_id", 2), F.col("event_ts") - days(EARLY_DAYS)).otherwise(F.col("event_ts")),
            "anonymous_id": F.when(hit("event_id", 3), F.lit("A-shared")).otherwise(F.col("anonymous_id"))}, twice=4),
        "listings": _broken(w.listings, "listing_id", {
            "sold_at": F.when(hit("listing_id", 1), F.col("created_at") - days(1)).otherwise(F.col("sold_at"))}, twice=2),
        "campaign_touches": _broken(w.campaign_touches, "touch_id", {}, twice=1),
        "consent_history": _broken(w.consent_history, "consent_id", {
            "status": F.when(hit("consent_id", 1), F.lit("perhaps")).otherwise(F.col("status"))}),
        "campaign_exclusions": w.campaign_exclusions,
        "experiment_assignments": _broken(w.experiment_assignments, "member_id", {
            "variant": F.when(hit("member_id", 5), F.lit("rogue")).otherwise(F.col("variant")),
            "assigned_at": F.when(hit("member_id", 6), F.col("assigned_at") + days(365)).otherwise(F.col("assigned_at"))},
            drop=7, twice=8),
    }
    audience = _broken(w.eligible_audience, "member_id", {
        "activation_channel": F.when(hit("member_id", 9), F.lit("pigeon")).otherwise(F.col("activation_channel"))}, drop=10, twice=11)
    m360 = _broken(w.member_360, "member_id", {
        "marketing_contacts_7d": F.when(hit("member_id", 12), spec.contact_cap).otherwise(F.col("marketing_contacts_7d")).cast("bigint"),
        "has_active_campaign_exclusion": F.col("has_active_campaign_exclusion") | hit("member_id", 13),
        "is_lapsed_seller": F.col("is_lapsed_seller") & ~hit("member_id", 14)})
    outcomes = _broken(w.member_outcomes, "member_id", {
        "message_sent_count": F.col("message_sent_count") + F.when(hit("member_id", 15) | hit("member_id", 16), 1).otherwise(0),
        "variant": F.when(hit("member_id", 17), F.lit("rogue")).otherwise(F.col("variant"))}, twice=18)
    results = w.experiment_results.withColumn("assigned_members", F.col("assigned_members") + 1)
    results = results.unionByName(results.filter(F.col("variant") == spec.control_arm))
    return Tables(raw, m360, audience, outcomes, results, spec)
