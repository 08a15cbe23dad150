"""Declared warehouse tests (Q-27..Q-30) and the row-count manifest (S-13).

Generic tests -- not_null, unique, accepted_values, relationships -- are
declared per (model, column) and evaluated so that each model is read once
for all its row-local tests (one aggregate of ``count_if``s). ``unique`` is a
two-phase ``groupBy``; ``relationships`` pre-aggregates the child per key
before the anti-join, so a hot key crosses the shuffle once per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import duplicate_keys


@dataclass(frozen=True)
class SchemaTest:
    model: str
    column: str
    test: str  # not_null | unique | accepted_values | relationships
    values: tuple[str, ...] = ()
    parent: str | None = None  # relationships: parent model (same column name)

    @property
    def test_id(self) -> str:
        return f"{self.test}__{self.model}__{self.column}"


def declared_tests(arms: tuple[str, ...], channels: tuple[str, ...]) -> tuple[SchemaTest, ...]:
    """The source and mart tests the reference declares (fixed list)."""
    nn = lambda m, c: SchemaTest(m, c, "not_null")
    uq = lambda m, c: SchemaTest(m, c, "unique")
    return (
        nn("members", "member_id"), uq("members", "member_id"),
        nn("events", "event_id"), uq("events", "event_id"), nn("events", "member_id"),
        SchemaTest("events", "member_id", "relationships", parent="members"),
        nn("listings", "listing_id"), uq("listings", "listing_id"), nn("listings", "member_id"),
        SchemaTest("listings", "member_id", "relationships", parent="members"),
        nn("campaign_touches", "touch_id"), uq("campaign_touches", "touch_id"),
        nn("experiment_assignments", "member_id"), uq("experiment_assignments", "member_id"),
        nn("eligible_audience", "member_id"), uq("eligible_audience", "member_id"),
        nn("eligible_audience", "activation_channel"),
        SchemaTest("eligible_audience", "activation_channel", "accepted_values", values=channels),
        nn("eligible_audience", "campaign_id"), nn("eligible_audience", "audience_created_at"),
        nn("member_outcomes", "member_id"), uq("member_outcomes", "member_id"),
        nn("member_outcomes", "experiment_id"), nn("member_outcomes", "variant"),
        SchemaTest("member_outcomes", "variant", "accepted_values", values=arms),
        nn("experiment_results", "variant"), uq("experiment_results", "variant"),
        SchemaTest("experiment_results", "variant", "accepted_values", values=arms),
        nn("experiment_results", "assigned_members"),
    )


def run_schema_tests(models: dict[str, DataFrame], tests: tuple[SchemaTest, ...]) -> DataFrame:
    """One row per test: test_id, model, column, test, failures, status."""
    parts: list[DataFrame] = []
    local: dict[str, list[SchemaTest]] = {}
    for t in tests:
        if t.test in ("not_null", "accepted_values"):
            local.setdefault(t.model, []).append(t)
        elif t.test == "unique":
            # NULLs are the not_null test's business here (dbt semantics)
            d = duplicate_keys(models[t.model].filter(F.col(t.column).isNotNull()), t.column)
            parts.append(d.agg(F.coalesce(F.sum("excess"), F.lit(0)).alias("failures")).select(
                F.lit(t.test_id).alias("test_id"), "failures"))
        elif t.test == "relationships":
            child = models[t.model].filter(F.col(t.column).isNotNull()).groupBy(t.column).agg(F.count(F.lit(1)).alias("n"))
            orphans = child.join(models[t.parent].select(t.column), t.column, "left_anti")
            parts.append(orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")).select(
                F.lit(t.test_id).alias("test_id"), "failures"))
    for model, ts_ in local.items():
        conds = []
        for t in ts_:
            if t.test == "not_null":
                conds.append(F.col(t.column).isNull())
            else:  # accepted_values ignores NULLs
                conds.append(F.col(t.column).isNotNull() & ~F.col(t.column).isin(*t.values))
        agg = models[model].agg(*[F.count_if(c).alias(f"c{i}") for i, c in enumerate(conds)])
        stack = F.array(*[F.struct(F.lit(t.test_id).alias("test_id"), F.col(f"c{i}").alias("failures"))
                          for i, t in enumerate(ts_)])
        parts.append(agg.select(F.inline(stack)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    spark = out.sparkSession
    meta = spark.createDataFrame([(t.test_id, t.model, t.column, t.test) for t in tests],
                                 "test_id string, model string, column_name string, test string")
    return out.join(F.broadcast(meta), "test_id").select(
        "test_id", "model", "column_name", "test", F.col("failures").cast("bigint").alias("failures"),
        F.when(F.col("failures") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """S-13: one row per table with its row count (one aggregate per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
