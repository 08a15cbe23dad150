"""Entity schemas, required columns and governed values."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, B, L = T.StringType(), T.TimestampNTZType(), T.BooleanType(), T.LongType()
MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# (name, type, nullable) -- nullable False marks a required column.
MEMBERS = _schema(
    ("member_id", S, False), ("joined_at", TS, False), ("region", S, False),
    ("preferred_channel", S, False), ("email_consent", B, False),
    ("push_consent", B, False), ("is_suppressed", B, False),
)
EVENTS = _schema(
    ("event_id", S, False), ("member_id", S, False), ("anonymous_id", S, False),
    ("event_name", S, False), ("event_ts", TS, False), ("category", S, True),
    ("platform", S, False), ("source", S, False),
)
LISTINGS = _schema(
    ("listing_id", S, False), ("member_id", S, False), ("category", S, False),
    ("created_at", TS, False), ("sold_at", TS, True), ("sale_value", MONEY, False),
)
TOUCHES = _schema(
    ("touch_id", S, False), ("member_id", S, False), ("campaign_id", S, False),
    ("variant", S, False), ("channel", S, False), ("sent_at", TS, False),
    ("opened_at", TS, True), ("clicked_at", TS, True), ("unsubscribed_at", TS, True),
)
CONSENT = _schema(
    ("consent_id", S, False), ("member_id", S, False), ("channel", S, False),
    ("status", S, False), ("effective_at", TS, False), ("source", S, False),
)
EXCLUSIONS = _schema(
    ("member_id", S, False), ("exclusion_reason", S, False),
    ("start_at", TS, False), ("end_at", TS, False),
)
ASSIGNMENTS = _schema(
    ("experiment_id", S, False), ("member_id", S, False),
    ("variant", S, False), ("assigned_at", TS, False),
)
DESTINATION = _schema(
    ("idempotency_key", S, False), ("member_id", S, False), ("campaign_id", S, False),
    ("variant", S, False), ("activation_channel", S, False),
    ("preferred_category", S, True), ("payload_hash", S, False),
    ("first_synced_at", TS, False), ("last_synced_at", TS, False),
)
SYNC_LOG = _schema(
    ("run_id", S, False), ("batch_id", L, True), ("seq", L, True),
    ("idempotency_key", S, True), ("member_id", S, True),
    ("action", S, False), ("reason", S, False),
)

RAW_TABLES: dict[str, T.StructType] = {
    "members": MEMBERS,
    "events": EVENTS,
    "listings": LISTINGS,
    "campaign_touches": TOUCHES,
    "consent_history": CONSENT,
    "campaign_exclusions": EXCLUSIONS,
    "experiment_assignments": ASSIGNMENTS,
}

# Columns whose values are parsed leniently (bad text -> NULL) in staging.
TOLERANT_TIMESTAMPS = {
    "listings": ("sold_at",),
    "campaign_touches": ("opened_at", "clicked_at", "unsubscribed_at"),
}


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# ---------------------------------------------------------------------------
# Fixed governed values (must equal the reference's tracking plan).
# ---------------------------------------------------------------------------
EVENT_NAMES = (
    "session_started",
    "search_performed",
    "item_viewed",
    "watchlist_added",
    "purchase_completed",
    "listing_started",
    "listing_created",
)
CONSENT_STATUSES = ("subscribed", "unsubscribed")
SUBSCRIBED = "subscribed"

# Activation payload, in the reference's field order.
DESTINATION_FIELDS = (
    "member_id",
    "campaign_id",
    "variant",
    "activation_channel",
    "preferred_category",
    "historical_listing_count",
    "marketing_contacts_7d",
    "audience_created_at",
)
IDEMPOTENCY_FIELDS = ("campaign_id", "member_id", "variant")
SYNC_ACTIONS = ("created", "updated", "unchanged", "suppressed", "rejected")

AUDIENCE_SAMPLE_COLUMNS = (
    "member_id",
    "campaign_id",
    "activation_channel",
    "preferred_category",
    "historical_listing_count",
    "marketing_contacts_7d",
    "audience_created_at",
)
