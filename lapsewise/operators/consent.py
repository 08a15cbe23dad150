"""As-of consent reconciliation (W-1).

The latest consent change per (member, channel) strictly before an instant,
ties broken by ``consent_id``. Expressed as ``max_by`` over a struct order
key rather than ``row_number() = 1``: the aggregate combines map-side, so a
member with millions of consent rows ships one row per map task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import latest, ts
from ..schemas import SUBSCRIBED


def latest_consent(consent: DataFrame, at: datetime) -> DataFrame:
    """(member_id, channel) -> status, effective_at of the latest change before ``at``."""
    order = F.struct("effective_at", "consent_id")
    return (
        consent.filter(F.col("effective_at") < ts(at))
        .groupBy("member_id", "channel")
        .agg(
            F.max_by("status", order).alias("status"),
            F.max("effective_at").alias("effective_at"),
        )
    )


def latest_consent_by_window(consent: DataFrame, at: datetime) -> DataFrame:
    """Same result via ``row_number`` -- kept as an independent test oracle."""
    w = Window.partitionBy("member_id", "channel").orderBy(
        F.col("effective_at").desc(), F.col("consent_id").desc()
    )
    return (
        consent.filter(F.col("effective_at") < ts(at))
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .select("member_id", "channel", "status", "effective_at")
    )


def consent_snapshot(consent: DataFrame, at: datetime, channels: tuple[str, ...]) -> DataFrame:
    """One row per member: ``<channel>_consent`` booleans as of ``at``.

    A single aggregation keyed by ``member_id`` (per-channel ``FILTER``), so
    joining it to members reuses the same hash partitioning.
    """
    filtered = consent.filter(F.col("effective_at") < ts(at))
    aggs = [
        latest(F.when(F.col("channel") == ch, F.col("status")), F.when(F.col("channel") == ch, F.struct("effective_at", "consent_id")))
        .alias(f"_{ch}_status")
        for ch in channels
    ]
    snap = filtered.groupBy("member_id").agg(*aggs)
    return snap.select(
        "member_id",
        *[F.coalesce(F.col(f"_{ch}_status") == SUBSCRIBED, F.lit(False)).alias(f"{ch}_consent") for ch in channels],
    )
