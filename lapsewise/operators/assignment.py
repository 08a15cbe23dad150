"""Exact, balanced, reproducible arm assignment (X-14).

Members are ordered by ``md5(salt|member_id), member_id`` and arm ``k`` gets
positions ``k, k+K, k+2K, ...`` -- arm sizes differ by at most one. A global
``row_number()`` would pull the whole audience into one task, so the rank is
computed distributed:

1. ``bucket`` = the first ``d`` hex digits of the hash. The prefix of a hex
   string orders like the string, so bucket order agrees with hash order.
2. Per-bucket counts: at most ``16**d`` rows (65,536 for d = 4) -- a size
   bound independent of the data, so their running offsets are computed in
   one small window and broadcast.
3. ``row_number`` inside each bucket (hash-spread, so no bucket is hot) plus
   the bucket offset gives the exact global rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import ts
from ..spec import CampaignSpec


def salted_hash(member_id: F.Column, salt: str) -> F.Column:
    return F.md5(F.concat(F.lit(salt), F.lit("|"), member_id))


def exact_rank(df: DataFrame, hash_col: str, tie_col: str, digits: int) -> DataFrame:
    """Adds ``rank`` = 1-based position in ``(hash_col, tie_col)`` order."""
    bucketed = df.withColumn("_bucket", F.substring(F.col(hash_col), 1, digits))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # Bounded by 16**digits rows: a single-partition window here is safe.
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bucket", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_bucket").orderBy(hash_col, tie_col)
    ranked = bucketed.withColumn("_rn", F.row_number().over(within))
    return ranked.join(F.broadcast(offsets), "_bucket").select(
        *df.columns, (F.col("_offset") + F.col("_rn")).alias("rank")
    )


def assign_arms(audience: DataFrame, spec: CampaignSpec) -> DataFrame:
    hashed = audience.select("member_id", salted_hash(F.col("member_id"), spec.assignment_salt).alias("_h"))
    ranked = exact_rank(hashed, "_h", "member_id", spec.assignment_bucket_digits)
    arms = F.array(*[F.lit(a) for a in spec.arms])
    return ranked.select(
        F.lit(spec.experiment_id).alias("experiment_id"),
        "member_id",
        F.element_at(arms, (F.pmod(F.col("rank") - 1, F.lit(len(spec.arms))) + 1).cast("int")).alias("variant"),
        ts(spec.assigned_at).alias("assigned_at"),
    )
