"""Sinks (S-11..S-18): full-refresh table writes and small report files.

Raw tables and marts are written with ``mode("overwrite")`` (full refresh,
as the reference recreates its tables). Report outputs are tiny (rules,
arms, gates, scenarios, one reconciliation row), so they are coalesced to a
single JSON/CSV file; member-grain data is never coalesced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.audience import audience_sample
from ..schemas import AUDIENCE_SAMPLE_COLUMNS

# Fixed order in which marts are (re)built (S-12).
MART_ORDER = ("member_360", "eligible_audience", "member_outcomes", "experiment_results")


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """S-11/S-12: full refresh of one table (Parquet)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_marts(marts: dict[str, DataFrame], root: str) -> None:
    for name in MART_ORDER:
        if name in marts:
            write_table(marts[name], f"{root.rstrip('/')}/{name}")


def write_audience_sample(audience: DataFrame, path: str, n: int = 50) -> None:
    """S-14: 7 contract columns, first ``n`` members, header CSV."""
    audience_sample(audience, AUDIENCE_SAMPLE_COLUMNS, n).coalesce(1).write.mode("overwrite").option(
        "header", "true"
    ).csv(path)


def write_report_json(df: DataFrame, path: str) -> None:
    """S-15..S-18: a small report table as one JSON-lines file."""
    df.coalesce(1).write.mode("overwrite").json(path)
