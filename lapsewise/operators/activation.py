"""Activation sync (T-1..T-13): records, validation, idempotent upsert, log,
run summary and reconciliation -- set-based.

The reference upserts row by row. Here a whole batch is classified in one
pass with the same sequential meaning: for a valid row, the destination's
hash "just before it" is the previous valid row of the same key in batch
order (``previous_in_key``), else the stored hash. NULL -> created,
equal -> unchanged, different -> updated. The next destination snapshot is
the old one with each touched key replaced by its last payload
(``max_by(seq)``). Cost is proportional to batch + destination; partitions
are keyed by the idempotency key, so no task sees more than its keys.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import by_key, ts
from ..schemas import DESTINATION, DESTINATION_FIELDS, IDEMPOTENCY_FIELDS, SYNC_ACTIONS
from ..spec import CampaignSpec

REQUIRED_FIELDS = ("member_id", "campaign_id", "variant", "activation_channel")
# action/reason vocabulary of the sync log.
CREATED = ("created", "new_membership")
UNCHANGED = ("unchanged", "idempotent_replay")
UPDATED = ("updated", "payload_changed")
PAYLOAD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# How a missing natural-key part is rendered (the reference formats None as text).
NULL_KEY_TEXT = "None"
# Sequence numbers that one task orders for a key.
SEQ_BLOCK = 1 << 16


def activation_records(audience: DataFrame, assignments: DataFrame, m360: DataFrame, spec: CampaignSpec) -> DataFrame:
    """T-1/T-2: treatment-only records with the internal safety fields."""
    a = audience.select(
        "member_id", "campaign_id", "activation_channel", "preferred_category",
        "historical_listing_count", "marketing_contacts_7d", "audience_created_at",
    )
    x = assignments.filter(
        (F.col("experiment_id") == spec.experiment_id) & F.col("variant").isin(*spec.treatments)
    ).select("member_id", "variant")
    m = m360.select(
        "member_id", "is_suppressed", "within_contact_cap", "has_no_campaign_conflict", "email_consent", "push_consent"
    )
    consent = (
        F.when(F.col("activation_channel") == "email", F.col("email_consent"))
        .when(F.col("activation_channel") == "push", F.col("push_consent"))
        .otherwise(F.lit(False))
    )
    return a.join(by_key(x), "member_id").join(by_key(m), "member_id").select(
        "member_id", "campaign_id", "variant", "activation_channel", "preferred_category",
        "historical_listing_count", "marketing_contacts_7d", "audience_created_at",
        "is_suppressed", "within_contact_cap", "has_no_campaign_conflict",
        consent.alias("has_channel_consent"),
    )


def in_member_order(records: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """O-4: adds ``seq``, the 0-based place in member order.

    Ranges of members are numbered apart and offset by the sizes of the ranges
    before them (one row a range). ``stage`` materialises the ranges, so that both
    see the same ones."""
    order = ["member_id", "campaign_id", "variant"]
    ranged = stage(records.repartitionByRange("member_id").withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
    return placed.join(sizes, "_range").select(*records.columns, (F.col("_before") + F.col("_place") - 1).alias("seq"))


def idempotency_key(cols: tuple[str, ...] = IDEMPOTENCY_FIELDS) -> Column:
    """T-3: first 24 hex of sha256('campaign|member|variant')."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_KEY_TEXT)) for c in cols]
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)


def payload(fields: tuple[str, ...] = DESTINATION_FIELDS) -> Column:
    """P-8: the destination payload (internal safety fields dropped)."""
    def field(c: str) -> Column:
        if c == "audience_created_at":
            return F.date_format(F.col(c), PAYLOAD_TIME_FORMAT).alias(c)
        return F.col(c).alias(c)

    return F.struct(*[field(c) for c in fields])


def payload_hash(fields: tuple[str, ...] = DESTINATION_FIELDS) -> Column:
    """T-4: sha256 of the payload as compact JSON with sorted keys, NULLs kept."""
    ordered = tuple(sorted(fields))
    return F.sha2(F.to_json(payload(ordered), {"ignoreNullFields": "false"}), 256)


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c).cast("string") == "")


def validation(spec: CampaignSpec) -> Column:
    """T-5: first failed check as struct(action, reason); NULL when valid."""
    def out(action: str, reason: str) -> Column:
        return F.struct(F.lit(action).alias("action"), F.lit(reason).alias("reason"))

    truthy = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False))
    return (
        F.when(F.greatest(*[_blank(c) for c in REQUIRED_FIELDS]), out("rejected", "missing_required_field"))
        .when(F.col("variant") == spec.control_arm, out("rejected", "control_not_activatable"))
        .when(~F.col("variant").isin(*spec.treatments), out("rejected", "unknown_variant"))
        .when(~F.col("activation_channel").isin(*spec.channels), out("rejected", "unsupported_channel"))
        .when(truthy("is_suppressed"), out("suppressed", "member_suppressed"))
        .when(~truthy("has_channel_consent"), out("suppressed", "channel_consent_missing"))
        .when(~truthy("within_contact_cap"), out("suppressed", "contact_cap_reached"))
        .when(~truthy("has_no_campaign_conflict"), out("suppressed", "campaign_conflict"))
    )


def empty_destination(spark) -> DataFrame:
    """T-6: an empty destination snapshot."""
    return spark.createDataFrame([], DESTINATION)


@dataclass
class SyncResult:
    log: DataFrame  # one row per attempted record (T-9)
    destination: DataFrame  # next snapshot (T-8)
    summary: DataFrame  # one row per run (T-10)


def previous_in_key(df: DataFrame, key: str, seq: str, tie: str, value: str, out: str, block: int = SEQ_BLOCK) -> DataFrame:
    """Adds ``out``: ``value`` of the row before in the same ``key``, in the order
    of (``seq``, ``tie``); NULL for a key's first row. ``value`` is never NULL.

    Rows are windowed by key *and* block of ``seq``, so a hot key spreads over
    as many tasks as it has blocks. A block's first row takes the last value of
    the key's block before it, from a table of one row per key and block. All
    of it follows from the data; nothing depends on how rows are partitioned.
    """
    blocked = df.withColumn("_block", F.coalesce(F.expr(f"{seq} div {block}"), F.lit(0).cast("bigint")))
    in_block = Window.partitionBy(key, "_block").orderBy(seq, tie)
    local = blocked.select("*", F.lag(value).over(in_block).alias("_before"), F.row_number().over(in_block).alias("_n"))
    last = blocked.groupBy(key, "_block").agg(F.max_by(value, F.struct(seq, tie)).alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy(key).orderBy("_block"))
    carry = last.select(key, "_block", carried.alias("_carry"))
    previous = F.when(F.col("_n") > 1, F.col("_before")).otherwise(F.col("_carry"))
    return local.join(by_key(carry), [key, "_block"], "left").select(*[local[c] for c in df.columns], previous.alias(out))


def classify(batch: DataFrame, destination: DataFrame, spec: CampaignSpec) -> DataFrame:
    """T-5 + T-7: every batch row with key, payload hash, action and reason.

    ``batch`` needs the record columns and a ``seq`` column giving its order
    (ties are broken by payload hash, so the result is deterministic).
    """
    rows = batch.select(
        "*",
        F.when(~_blank("member_id"), idempotency_key()).alias("idempotency_key"),
        payload_hash().alias("payload_hash"),
        validation(spec).alias("_failure"),
    )
    valid = rows.filter(F.col("_failure").isNull())
    dest = destination.select("idempotency_key", F.col("payload_hash").alias("_stored_hash"))
    prev = previous_in_key(valid, "idempotency_key", "seq", "payload_hash", "payload_hash", "_prev_in_batch")
    prev = prev.join(by_key(dest), "idempotency_key", "left")
    before = F.coalesce(F.col("_prev_in_batch"), F.col("_stored_hash"))
    act = (
        F.when(before.isNull(), F.struct(F.lit(CREATED[0]).alias("action"), F.lit(CREATED[1]).alias("reason")))
        .when(before == F.col("payload_hash"), F.struct(F.lit(UNCHANGED[0]).alias("action"), F.lit(UNCHANGED[1]).alias("reason")))
        .otherwise(F.struct(F.lit(UPDATED[0]).alias("action"), F.lit(UPDATED[1]).alias("reason")))
    )
    classified = prev.select(*rows.columns, act.alias("_outcome")).drop("_failure")
    failed = rows.filter(F.col("_failure").isNotNull()).withColumnRenamed("_failure", "_outcome")
    both = classified.unionByName(failed.select(*classified.columns))
    return both.select(
        *[c for c in both.columns if c != "_outcome"],
        F.col("_outcome.action").alias("action"), F.col("_outcome.reason").alias("reason"),
    )


def snapshot_changes(classified: DataFrame, destination: DataFrame, synced_at: datetime) -> DataFrame:
    """Rows this batch created or updated, in destination form (a delta).

    Cost is proportional to the batch: keys that were only ``unchanged`` or
    failed validation produce nothing.
    """
    return next_snapshot(classified, destination, synced_at, changes_only=True)


def next_snapshot(classified: DataFrame, destination: DataFrame, synced_at: datetime,
                  changes_only: bool = False) -> DataFrame:
    """T-8: insert created keys, update 4 fields of updated keys, keep the rest."""
    touched = classified.filter(F.col("action").isin(CREATED[0], UPDATED[0], UNCHANGED[0]))
    last = F.struct("seq", "payload_hash")
    latest = touched.groupBy("idempotency_key").agg(
        F.max_by("member_id", last).alias("member_id"),
        F.max_by("campaign_id", last).alias("campaign_id"),
        F.max_by("variant", last).alias("variant"),
        F.max_by("activation_channel", last).alias("activation_channel"),
        F.max_by("preferred_category", last).alias("preferred_category"),
        F.max_by("payload_hash", last).alias("payload_hash"),
        F.max(F.col("action").isin(CREATED[0], UPDATED[0])).alias("_written"),
    )
    old = destination.select(
        "idempotency_key",
        *[F.col(c).alias(f"_old_{c}") for c in ("member_id", "campaign_id", "variant", "first_synced_at", "last_synced_at")],
    )
    at = ts(synced_at)
    merged = latest.join(by_key(old), "idempotency_key", "left").select(
        "idempotency_key",
        F.coalesce("_old_member_id", "member_id").alias("member_id"),
        F.coalesce("_old_campaign_id", "campaign_id").alias("campaign_id"),
        F.coalesce("_old_variant", "variant").alias("variant"),
        "activation_channel", "preferred_category", "payload_hash",
        F.coalesce("_old_first_synced_at", at).alias("first_synced_at"),
        F.when(F.col("_written"), at).otherwise(F.col("_old_last_synced_at")).alias("last_synced_at"),
        "_written",
    )
    if changes_only:
        return merged.filter(F.col("_written")).select(*DESTINATION.fieldNames())
    kept = destination.join(by_key(latest.select("idempotency_key")), "idempotency_key", "left_anti")
    return kept.select(*DESTINATION.fieldNames()).unionByName(merged.select(*DESTINATION.fieldNames()))


def run_summary(log: DataFrame) -> DataFrame:
    """T-10 / A-19: attempted plus zero-filled counts of the five actions."""
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("attempted"),
        *[F.count_if(F.col("action") == a).alias(a) for a in SYNC_ACTIONS],
    )


def sync(batch: DataFrame, destination: DataFrame, spec: CampaignSpec, run_id: str,
         synced_at: datetime | None = None, batch_id: int = 0,
         stage: Callable[[DataFrame], DataFrame] | None = None) -> SyncResult:
    """One sync run: classify, log, next snapshot, summary.

    ``stage`` materialises the classified batch once (e.g. writes it) so the
    log and the snapshot are both derived from it instead of classifying
    twice. The returned snapshot is lazy; materialise it (write it, or
    ``checkpoint()``) before it becomes the next run's ``destination`` --
    ``CampaignRun`` and the stream write one snapshot (or change set) per run.
    """
    if "seq" not in batch.columns:
        batch = batch.withColumn("seq", F.lit(0).cast("bigint"))
    c = classify(batch, destination, spec)
    if stage is not None:
        c = stage(c)
    log = c.select(
        F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("seq").cast("bigint").alias("seq"), "idempotency_key", "member_id", "action", "reason",
    )
    snap = next_snapshot(c, destination, synced_at or spec.campaign_at)
    return SyncResult(log=log, destination=snap, summary=run_summary(log))


def reconciliation(audience: DataFrame, assignments: DataFrame, records: DataFrame, destination: DataFrame,
                   replay_summary: DataFrame, spec: CampaignSpec) -> DataFrame:
    """T-12 / T-13: one row of counts and three checks (scalar subqueries)."""
    spark = audience.sparkSession
    eligible = audience.agg(F.count(F.lit(1))).scalar()
    control = assignments.agg(F.count_if(F.col("variant") == spec.control_arm)).scalar()
    treatment = records.agg(F.count(F.lit(1))).scalar()
    dest = destination.agg(F.count(F.lit(1)), F.count_if(F.col("variant") == spec.control_arm))
    dest_active = dest.select(F.col(dest.columns[0])).scalar()
    dest_control = dest.select(F.col(dest.columns[1])).scalar()
    dups = (
        destination.groupBy("idempotency_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        .agg(F.count(F.lit(1))).scalar()
    )
    replay_created = replay_summary.agg(F.sum("created")).scalar()
    replay_unchanged = replay_summary.agg(F.sum("unchanged")).scalar()
    row = spark.range(1).select(
        eligible.alias("eligible_source_count"),
        control.alias("control_excluded_count"),
        treatment.alias("treatment_source_count"),
        dest_active.alias("destination_active_count"),
        (treatment - dest_active).alias("source_destination_delta"),
        dups.alias("duplicate_idempotency_keys"),
        dest_control.alias("destination_control_count"),
        replay_created.alias("_rc"), replay_unchanged.alias("_ru"),
    )
    status = lambda ok: F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))
    return row.select(
        "eligible_source_count", "control_excluded_count", "treatment_source_count",
        "destination_active_count", "source_destination_delta", "duplicate_idempotency_keys",
        "destination_control_count",
        status(F.col("source_destination_delta") == 0).alias("treatment_source_matches_destination"),
        status(F.col("destination_control_count") == 0).alias("control_never_activated"),
        status((F.col("_rc") == 0) & (F.col("_ru") == F.col("treatment_source_count"))
               & (F.col("duplicate_idempotency_keys") == 0)).alias("idempotent_replay_creates_no_duplicates"),
    )


def sample_payloads(records: DataFrame, n: int = 5) -> DataFrame:
    """S-18 / O-7: first ``n`` payloads in member order (a top-k report)."""
    return records.orderBy("member_id").limit(n).select(payload().alias("payload")).select("payload.*")
