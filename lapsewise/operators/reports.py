"""Report tables behind the reference's dashboard, charts and summary
(R-3..R-6, E-20, E-21). R-1 (funnel) and R-2 (categories) live with the
audience. Every input here is experiment- or arm-sized.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

P_DISPLAY_FLOOR = 0.0001
P_DISPLAY_BELOW = "<0.0001"


def display_p(p: Column) -> Column:
    """E-20: '<0.0001' below the floor, else four decimals."""
    return F.when(p < P_DISPLAY_FLOOR, F.lit(P_DISPLAY_BELOW)).otherwise(F.format_string("%.4f", p))


def display_pct(x: Column) -> Column:
    """E-21: two decimals and a percent sign."""
    return F.concat(F.format_string("%.2f", x), F.lit("%"))


def treatment_table(comparisons: DataFrame) -> DataFrame:
    """R-3: one row per treatment arm, as the dashboard shows it."""
    return comparisons.select(
        "experiment_id", "variant", "assigned_members",
        (F.col("treatment_rate") * 100.0).alias("conversion_rate_pct"),
        "absolute_uplift_pp", "ci_95_low_pp", "ci_95_high_pp",
        display_p(F.col("bonferroni_p_value")).alias("bonferroni_p_display"),
        display_pct(F.col("treatment_rate") * 100.0).alias("conversion_rate_display"),
        "guardrail_unsubscribe_rate_pct", "estimated_roi_pct",
    )


def conversion_by_arm(results: DataFrame) -> DataFrame:
    """R-4: conversion rate of every arm (x / n as a percentage)."""
    return results.select(
        "experiment_id", "variant", "assigned_members", "converted_members",
        (F.try_divide(F.col("converted_members").cast("double"), F.col("assigned_members")) * 100.0)
        .alias("conversion_rate_pct"),
    ).orderBy("experiment_id", "variant")  # O-2 on an arm-sized table


def headline(results: DataFrame, decision: DataFrame, quality: DataFrame) -> DataFrame:
    """R-5: audience, best arm and uplift, incremental units, rules passed."""
    audience = results.groupBy("experiment_id").agg(F.sum("assigned_members").alias("randomized_audience"))
    rules = quality.agg(F.count_if(F.col("status") == "PASS").alias("rules_passed"),
                        F.count(F.lit(1)).alias("rules_total"))
    d = decision.select("experiment_id", "best_variant", "absolute_uplift_pp", "incremental_listings_estimate",
                        "rollout_ready")
    return audience.join(d, "experiment_id", "left").select(
        "*", rules.select("rules_passed").scalar().alias("rules_passed"),
        rules.select("rules_total").scalar().alias("rules_total"),
    )


# Labels of the metrics report.
ASSUMPTION_NOTE = "Synthetic scenario assumption; not real company financial data."
PRIMARY_METRIC = "member created at least one listing within 14 days"
METHODOLOGY = (
    ("test", "two-sided pooled two-proportion z-test"),
    ("confidence_interval", "95% Newcombe score interval for absolute difference"),
    ("multiple_comparison_control", "Bonferroni correction for two treatment arms"),
    ("estimand", "intention-to-treat incremental conversion"),
    ("randomization_validation", "sample-ratio-mismatch test plus pre-treatment standardized mean differences"),
)


def commercial_assumptions(spark, spec) -> DataFrame:
    """S-16: the value and costs that the economics rest on, labelled as assumptions."""
    rows = [(spec.experiment_id, "value_per_incremental_unit", None, spec.value_per_unit)]
    for variant, (fixed, message) in sorted(spec.costs.items()):
        rows += [(spec.experiment_id, "fixed_cost", variant, fixed), (spec.experiment_id, "cost_per_message", variant, message)]
    schema = "experiment_id string, assumption string, variant string, value double"
    return spark.createDataFrame(rows, schema).withColumn("note", F.lit(ASSUMPTION_NOTE))


def methodology(spark, spec) -> DataFrame:
    """S-16: how the numbers of the report were made."""
    rows = [(spec.experiment_id, "primary_metric", PRIMARY_METRIC), *((spec.experiment_id, *m) for m in METHODOLOGY)]
    return spark.createDataFrame(rows, "experiment_id string, aspect string, text string")


def evidence(results: DataFrame, decision: DataFrame, srm: DataFrame, balance: DataFrame,
             power: DataFrame, spec) -> DataFrame:
    """R-6: the executive evidence row per experiment."""
    ctrl = results.filter(F.col("variant") == spec.control_arm).select(
        "experiment_id", F.col("converted_members").alias("control_converted"),
        F.col("assigned_members").alias("control_assigned"))
    arms = results.select("experiment_id", F.col("variant").alias("best_variant"),
                          F.col("converted_members").alias("_bx"), F.col("assigned_members").alias("_bn"))
    total = results.groupBy("experiment_id").agg(F.sum("assigned_members").alias("randomized_audience"))
    d = decision.select("experiment_id", "best_variant", "recommendation", "absolute_uplift_pp",
                        "relative_uplift_pct", "ci_95_low_pp", "ci_95_high_pp", "bonferroni_p_value",
                        "incremental_listings_estimate", "guardrail_unsubscribe_rate_pct", "estimated_roi_pct")
    j = (d.join(total, "experiment_id").join(ctrl, "experiment_id", "left")
         .join(arms, ["experiment_id", "best_variant"], "left")
         .join(srm.select("experiment_id", F.col("p_value").alias("srm_p_value")), "experiment_id", "left")
         .join(balance.select("experiment_id", "max_absolute_smd"), "experiment_id", "left")
         .join(power.select("experiment_id", "required_members_per_arm", "observed_members_per_arm"),
               "experiment_id", "left"))
    return j.select(
        "experiment_id", "recommendation", "randomized_audience",
        (F.col("control_converted") / F.col("control_assigned") * 100.0).alias("control_conversion_pct"),
        "control_converted", "control_assigned", "best_variant",
        (F.col("_bx") / F.col("_bn") * 100.0).alias("best_conversion_pct"),
        "absolute_uplift_pp", "relative_uplift_pct", "ci_95_low_pp", "ci_95_high_pp",
        display_p(F.col("bonferroni_p_value")).alias("bonferroni_p_display"),
        display_p(F.col("srm_p_value")).alias("srm_p_display"),
        "max_absolute_smd", "required_members_per_arm", "observed_members_per_arm",
        "incremental_listings_estimate", "guardrail_unsubscribe_rate_pct", "estimated_roi_pct",
    )
