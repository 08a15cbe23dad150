"""Experiment measurement (X-1..X-15), one row per (experiment, arm).

Every statistic is a function of grouped counts or moments, so thousands of
experiments are measured by the same job; member rows never leave the
executors (the reference collects them to Python for the SMD). Tables joined
here are sized by experiments x arms (arm, control and cost tables), which
is what makes their broadcast safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import stats as S
from ..spec import CampaignSpec


def arm_order(spec: CampaignSpec) -> Column:
    """Declared position of ``variant`` (ties in best-arm selection)."""
    return F.coalesce(
        *[F.when(F.col("variant") == a, F.lit(i)) for i, a in enumerate(spec.arms)], F.lit(len(spec.arms))
    )


def arm_rates(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """X-1: conversion rate x/n and unsubscribe rate (0.0 without sends)."""
    return results.select(
        "*",
        F.try_divide(F.col("converted_members").cast("double"), F.col("assigned_members")).alias("conversion_rate"),
        F.when(
            F.col("message_sent_count") > 0,
            F.col("unsubscribe_count").cast("double") / F.col("message_sent_count"),
        ).otherwise(F.lit(0.0)).alias("unsubscribe_rate"),
        arm_order(spec).alias("arm_order"),
    )


def cost_table(spark: SparkSession, spec: CampaignSpec) -> DataFrame:
    rows = [(v, float(f), float(m)) for v, (f, m) in spec.costs.items()]
    return spark.createDataFrame(rows, "variant string, fixed_cost double, cost_per_message double")


def comparisons(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """X-15: each treatment arm vs its experiment's control arm (J-18)."""
    arms = arm_rates(results, spec)
    control = arms.filter(F.col("variant") == spec.control_arm).select(
        "experiment_id",
        F.col("assigned_members").alias("control_members"),
        F.col("converted_members").alias("control_converted"),
        F.col("conversion_rate").alias("control_rate"),
    )
    treat = arms.filter(F.col("variant") != spec.control_arm)
    # experiment-sized on both sides; the cost table has one row per declared arm
    j = treat.join(control, "experiment_id").join(
        F.broadcast(cost_table(results.sparkSession, spec)), "variant", "left"
    )
    xt, nt, xc, nc = (F.col(c) for c in ("converted_members", "assigned_members", "control_converted", "control_members"))
    rt, rc = F.col("conversion_rate"), F.col("control_rate")
    diff = rt - rc
    wt = S.wilson_interval(xt, nt, spec.wilson_z)
    wc = S.wilson_interval(xc, nc, spec.wilson_z)
    z = S.pooled_z(xt, nt, xc, nc)
    base = j.select(
        "experiment_id", "variant", "arm_order", "assigned_members", "converted_members",
        "message_sent_count", "unsubscribe_rate", "fixed_cost", "cost_per_message",
        "control_members", "control_converted", rt.alias("treatment_rate"), rc.alias("control_rate"),
        (diff * 100.0).alias("absolute_uplift_pp"),
        F.when(rc != 0, diff / rc * 100.0).alias("relative_uplift_pct"),
        (diff - F.sqrt(F.pow(rt - wt["low"], 2) + F.pow(wc["high"] - rc, 2))).alias("_ci_low"),
        (diff + F.sqrt(F.pow(wt["high"] - rt, 2) + F.pow(rc - wc["low"], 2))).alias("_ci_high"),
        z.alias("z_score"),
    )
    with_p = base.select("*", S.two_sided_p(F.col("z_score")).alias("p_value"))
    incremental = F.col("absolute_uplift_pp") / 100.0 * F.col("assigned_members")
    cost = F.col("fixed_cost") + F.col("cost_per_message") * F.col("message_sent_count")
    value = incremental * spec.value_per_unit
    return with_p.select(
        "experiment_id", "variant", "arm_order", "assigned_members", "converted_members",
        "treatment_rate", "control_rate", "absolute_uplift_pp", "relative_uplift_pct",
        (F.col("_ci_low") * 100.0).alias("ci_95_low_pp"),
        (F.col("_ci_high") * 100.0).alias("ci_95_high_pp"),
        "z_score", "p_value",
        F.least(F.lit(1.0), F.col("p_value") * spec.comparisons).alias("bonferroni_p_value"),
        incremental.alias("incremental_listings_estimate"),
        value.alias("assumed_incremental_value"),
        cost.alias("assumed_campaign_cost"),
        F.try_divide(value - cost, cost).alias("_roi"),
        (F.col("unsubscribe_rate") * 100.0).alias("guardrail_unsubscribe_rate_pct"),
        (F.col("unsubscribe_rate") <= spec.unsubscribe_rate_limit).alias("passes_unsubscribe_guardrail"),
    ).withColumn("estimated_roi_pct", F.col("_roi") * 100.0).drop("_roi")


# --- randomisation diagnostics ------------------------------------------------

def covariate_stats(assignments: DataFrame, m360: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-15: per (experiment, arm, covariate): n, mean, sample variance.

    One aggregate computes all covariates' moments (partial aggregation on
    the executors); the unpivot runs on the arm-sized result. NULL
    covariates count as 0; variance is 0 for a single member.
    """
    cov = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in spec.covariates]
    rows = assignments.select("experiment_id", "member_id", "variant").join(
        m360.select("member_id", *cov), "member_id"
    )
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in spec.covariates:
        aggs += [F.avg(c).alias(f"m__{c}"), F.var_samp(c).alias(f"v__{c}")]
    g = rows.groupBy("experiment_id", "variant").agg(*aggs)
    stack = F.array(*[
        F.struct(
            F.lit(c).alias("covariate"),
            F.col(f"m__{c}").alias("mean"),
            F.when(F.col("n") > 1, F.coalesce(F.col(f"v__{c}"), F.lit(0.0))).otherwise(F.lit(0.0)).alias("variance"),
        )
        for c in spec.covariates
    ])
    return g.select("experiment_id", "variant", "n", F.inline(stack))


def covariate_balance(assignments: DataFrame, m360: DataFrame, spec: CampaignSpec) -> DataFrame:
    """X-8: standardised mean difference of every covariate vs control."""
    st = covariate_stats(assignments, m360, spec)
    ctrl = st.filter(F.col("variant") == spec.control_arm).select(
        "experiment_id", "covariate", F.col("mean").alias("control_mean"), F.col("variance").alias("control_variance")
    )
    treat = st.filter(F.col("variant") != spec.control_arm)
    j = treat.join(ctrl, ["experiment_id", "covariate"])
    pooled_sd = F.sqrt((F.col("variance") + F.col("control_variance")) / 2.0)
    return j.select(
        "experiment_id", "variant", "covariate",
        F.col("mean").alias("treatment_mean"), "control_mean",
        F.col("variance").alias("treatment_variance"), "control_variance",
        F.when(pooled_sd != 0, (F.col("mean") - F.col("control_mean")) / pooled_sd).otherwise(F.lit(0.0)).alias("smd"),
    )


def balance_summary(balance: DataFrame, spec: CampaignSpec) -> DataFrame:
    """A-16 / X-9: largest |SMD| per experiment and the balance gate."""
    return balance.groupBy("experiment_id").agg(F.max(F.abs("smd")).alias("max_absolute_smd")).select(
        "*", (F.col("max_absolute_smd") < spec.smd_threshold).alias("balance_passes")
    )


def declared_arm_counts(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """Assigned members per declared arm; a declared arm with nobody is 0."""
    exps = results.select("experiment_id").distinct()
    declared = exps.select("experiment_id", F.explode(F.array(*[F.lit(a) for a in spec.arms])).alias("variant"))
    observed = results.select("experiment_id", "variant", F.col("assigned_members").cast("bigint").alias("n"))
    return (
        observed.unionByName(declared.withColumn("n", F.lit(0).cast("bigint")))
        .groupBy("experiment_id", "variant")
        .agg(F.sum("n").alias("n"))
    )


def sample_ratio_mismatch(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """X-10 / A-17: chi-square vs equal allocation, survival p for k-1 df."""
    counts = declared_arm_counts(results, spec)
    by_exp = Window.partitionBy("experiment_id")  # arm-sized partitions
    expected = F.sum("n").over(by_exp) / F.count(F.lit(1)).over(by_exp)
    terms = counts.select("experiment_id", "n", expected.alias("e"))
    out = terms.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("arms"),
        F.sum("n").alias("total_members"),
        F.first("e").alias("expected_per_arm"),
        F.sum((F.col("n") - F.col("e")) * (F.col("n") - F.col("e")) / F.col("e")).alias("chi_square"),
    ).select("*", (F.col("arms") - 1).alias("df"))
    return out.select("*", S.chi2_sf(F.col("chi_square"), F.col("df")).alias("p_value")).select(
        "*", (F.col("p_value") >= spec.srm_p_threshold).alias("srm_passes")
    )


def power_plan(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """X-11 / X-12: required members per arm vs the smallest observed arm."""
    p1 = F.lit(spec.power_baseline_rate)
    mde = F.lit(spec.power_mde)
    p2 = p1 + mde
    avg = (p1 + p2) / 2.0
    z_alpha = S.norm_ppf(F.lit(1.0 - spec.power_alpha / 2.0))
    z_power = S.norm_ppf(F.lit(spec.power_target))
    numerator = F.pow(
        z_alpha * F.sqrt(2.0 * avg * (1.0 - avg)) + z_power * F.sqrt(p1 * (1.0 - p1) + p2 * (1.0 - p2)), 2
    )
    required = F.ceil(numerator / (mde * mde)).cast("bigint")
    smallest = declared_arm_counts(results, spec).groupBy("experiment_id").agg(
        F.min("n").alias("observed_members_per_arm")
    )
    return smallest.select(
        "experiment_id",
        p1.alias("assumed_baseline_rate"),
        (mde * 100.0).alias("minimum_detectable_effect_pp"),
        F.lit(spec.power_alpha).alias("alpha_per_comparison"),
        F.lit(spec.power_target).alias("target_power"),
        required.alias("required_members_per_arm"),
        "observed_members_per_arm",
    ).select("*", (F.col("observed_members_per_arm") >= F.col("required_members_per_arm")).alias("power_passes"))


def arm_set_check(results: DataFrame, spec: CampaignSpec) -> DataFrame:
    """U-1: observed arms must equal the declared arms (per experiment).

    The reference raises an error; here each experiment gets its missing and
    unexpected arms and a flag, so one bad experiment does not stop the rest.
    The arm set per experiment is bounded by the arms present, never by members.
    """
    declared = F.array(*[F.lit(a) for a in spec.arms])
    per_exp = results.groupBy("experiment_id").agg(F.array_sort(F.collect_set("variant")).alias("observed_arms"))
    return per_exp.select(
        "experiment_id",
        "observed_arms",
        F.array_sort(F.array_except(declared, F.col("observed_arms"))).alias("missing_arms"),
        F.array_sort(F.array_except(F.col("observed_arms"), declared)).alias("unexpected_arms"),
    ).select("*", ((F.size("missing_arms") == 0) & (F.size("unexpected_arms") == 0)).alias("arms_match"))
