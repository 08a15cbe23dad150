"""Rollout decision (D-1..D-4), one row per experiment.

Each gate's ``passes`` is recomputed from its observed value and the spec's
threshold, so a policy sweep only overrides observations (the reference sets
both by hand). The sweep emits its scenarios with a generator over a
spec-sized array literal -- no join, nothing collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import CampaignSpec

# ---------------------------------------------------------------------------
# Gate names and requirement texts, recommendation wording,
# and the stress scenarios with their overrides (must equal the reference).
# ---------------------------------------------------------------------------
GATES = (
    ("data_quality", "all blocking data and campaign-safety checks pass"),
    ("sample_ratio_mismatch", "p-value >= {srm:.2f}"),
    ("pre_treatment_balance", "maximum absolute SMD < {smd:.2f}"),
    ("statistical_significance", "Bonferroni-adjusted p-value < {p:.2f}"),
    ("confidence_interval", "95% confidence interval lower bound > 0"),
    ("unsubscribe_guardrail", "unsubscribe rate <= {unsubscribe:g}%"),
    ("commercial_viability", "scenario ROI > 0%"),
    ("statistical_power", "observed members per arm >= required members per arm"),
)
READY_TEXT = (
    "Roll out {variant} to a staged 50% audience, retain a 10% holdout, and monitor "
    "unsubscribe and listing quality."
)
BLOCKED_PREFIX = "Do not roll out; investigate failed gates: "
QUALITY_PASS_TEXT, QUALITY_FAIL_TEXT = "pass", "failure detected"


@dataclass(frozen=True)
class Scenario:
    scenario_id: str
    description: str
    quality_passed: bool | None = None
    srm_p_value: float | None = None
    max_absolute_smd: float | None = None
    bonferroni_p_value: float | None = None
    ci_95_low_pp: float | None = None
    unsubscribe_rate_pct: float | None = None
    estimated_roi_pct: float | None = None
    underpowered: bool = False  # observed = required - 1


SCENARIOS = (
    Scenario("baseline", "All pre-analysis, statistical, customer and commercial gates pass."),
    Scenario("control_contamination", "A control member receives a target-campaign message.", quality_passed=False),
    Scenario("sample_ratio_mismatch", "Observed assignment counts are inconsistent with the allocation plan.",
             srm_p_value=0.0005),
    Scenario("pre_treatment_imbalance", "A pre-treatment covariate exceeds the balance threshold.",
             max_absolute_smd=0.16),
    Scenario("no_confirmatory_lift", "The treatment point estimate is positive but confirmatory evidence fails.",
             bonferroni_p_value=0.18, ci_95_low_pp=-0.65),
    Scenario("unsubscribe_breach", "The treatment exceeds the one-percent unsubscribe guardrail.",
             unsubscribe_rate_pct=1.35),
    Scenario("negative_roi", "Approved unit economics produce a negative scenario ROI.", estimated_roi_pct=-18.0),
    Scenario("underpowered_test", "The available audience is below the pre-specified sample requirement.",
             underpowered=True),
)

INPUT_COLUMNS = (
    "quality_passed", "srm_p_value", "max_absolute_smd", "bonferroni_p_value", "ci_95_low_pp",
    "guardrail_unsubscribe_rate_pct", "estimated_roi_pct", "observed_members_per_arm",
    "required_members_per_arm",
)


def best_variant(comparisons: DataFrame) -> DataFrame:
    """D-3 / O-6: greatest uplift per experiment; ties -> earlier declared arm."""
    cols = [c for c in comparisons.columns if c != "experiment_id"]
    best = comparisons.groupBy("experiment_id").agg(
        F.max_by(F.struct(*cols), F.struct(F.col("absolute_uplift_pp"), -F.col("arm_order"))).alias("b")
    )
    return best.select("experiment_id", F.col("b.variant").alias("best_variant"), *[F.col(f"b.{c}").alias(c) for c in cols if c != "variant"])


def decision_inputs(
    comparisons: DataFrame, srm: DataFrame, balance: DataFrame, power: DataFrame, quality_passed: DataFrame
) -> DataFrame:
    """One row per experiment with every value a gate reads.

    ``quality_passed`` is the one-row Q-35 table; it enters as a scalar
    subquery. All other inputs are experiment-sized.
    """
    best = best_variant(comparisons)
    q = quality_passed.select("quality_passed")
    return (
        best.join(srm.select("experiment_id", F.col("p_value").alias("srm_p_value")), "experiment_id", "left")
        .join(balance.select("experiment_id", "max_absolute_smd"), "experiment_id", "left")
        .join(power.select("experiment_id", "observed_members_per_arm", "required_members_per_arm"), "experiment_id", "left")
        .select(
            "experiment_id", "best_variant",
            F.coalesce(q.scalar(), F.lit(False)).alias("quality_passed"),
            "srm_p_value", "max_absolute_smd", "bonferroni_p_value", "ci_95_low_pp",
            "guardrail_unsubscribe_rate_pct", "estimated_roi_pct",
            "observed_members_per_arm", "required_members_per_arm",
        )
    )


def requirements(spec: CampaignSpec) -> list[tuple[str, str]]:
    """(gate, what it asks for) with the spec's thresholds."""
    limits = {"srm": spec.srm_p_threshold, "smd": spec.smd_threshold, "p": spec.adjusted_p_threshold,
              "unsubscribe": spec.unsubscribe_rate_limit * 100}
    return [(name, text.format(**limits)) for name, text in GATES]


def gate_columns(spec: CampaignSpec) -> list[tuple[str, str, Column, Column]]:
    """(name, requirement, observed value, passes) for the eight gates."""
    c = F.col
    flag = lambda e: F.coalesce(e, F.lit(False))  # noqa: E731 -- a missing observation fails
    passes = {
        "data_quality": flag(c("quality_passed")),
        "sample_ratio_mismatch": flag(c("srm_p_value") >= spec.srm_p_threshold),
        "pre_treatment_balance": flag(c("max_absolute_smd") < spec.smd_threshold),
        "statistical_significance": flag(c("bonferroni_p_value") < spec.adjusted_p_threshold),
        "confidence_interval": flag(c("ci_95_low_pp") > 0),
        "unsubscribe_guardrail": flag(c("guardrail_unsubscribe_rate_pct") / 100.0 <= spec.unsubscribe_rate_limit),
        "commercial_viability": flag(c("estimated_roi_pct") > 0),
        "statistical_power": flag(c("observed_members_per_arm") >= c("required_members_per_arm")),
    }
    observed = {
        "data_quality": F.lit(None).cast("double"),
        "sample_ratio_mismatch": c("srm_p_value"),
        "pre_treatment_balance": c("max_absolute_smd"),
        "statistical_significance": c("bonferroni_p_value"),
        "confidence_interval": c("ci_95_low_pp"),
        "unsubscribe_guardrail": c("guardrail_unsubscribe_rate_pct"),
        "commercial_viability": c("estimated_roi_pct"),
        "statistical_power": c("observed_members_per_arm").cast("double"),
    }
    return [(name, requirement, observed[name], passes[name]) for name, requirement in requirements(spec)]


def evaluate(inputs: DataFrame, spec: CampaignSpec) -> DataFrame:
    """D-1/D-2: gates array, failed gate names, readiness and recommendation."""
    gates = F.array(*[
        F.struct(
            F.lit(i + 1).alias("gate_order"),
            F.lit(name).alias("name"),
            F.lit(req).alias("requirement"),
            obs.alias("observed_value"),
            (F.when(F.col("quality_passed"), F.lit(QUALITY_PASS_TEXT)).otherwise(F.lit(QUALITY_FAIL_TEXT))
             if name == "data_quality" else obs.cast("string")).alias("observed"),
            ok.alias("passes"),
        )
        for i, (name, req, obs, ok) in enumerate(gate_columns(spec))
    ])
    with_gates = inputs.select("*", gates.alias("gates"))
    failed = F.transform(F.filter("gates", lambda g: ~g["passes"]), lambda g: g["name"])
    with_failed = with_gates.select("*", failed.alias("failed_gates"))
    ready = F.size("failed_gates") == 0
    head, tail = READY_TEXT.split("{variant}")
    ready_text = F.concat(F.lit(head), F.col("best_variant"), F.lit(tail))
    blocked_text = F.concat(F.lit(BLOCKED_PREFIX), F.array_join("failed_gates", ", "), F.lit("."))
    return with_failed.select(
        "*", ready.alias("rollout_ready"), F.when(ready, ready_text).otherwise(blocked_text).alias("recommendation")
    )


def _override(value, column: str) -> Column:
    return F.coalesce(F.lit(value), F.col(column)) if value is not None else F.col(column)


def scenario_sweep(inputs: DataFrame, spec: CampaignSpec, scenarios: tuple[Scenario, ...] = SCENARIOS) -> DataFrame:
    """D-4: every experiment re-evaluated under every named override."""
    arr = F.array(*[
        F.struct(
            F.lit(i + 1).alias("scenario_order"),
            F.lit(s.scenario_id).alias("scenario_id"),
            F.lit(s.description).alias("scenario_description"),
            F.lit(s.quality_passed).cast("boolean").alias("o_quality"),
            F.lit(s.srm_p_value).cast("double").alias("o_srm"),
            F.lit(s.max_absolute_smd).cast("double").alias("o_smd"),
            F.lit(s.bonferroni_p_value).cast("double").alias("o_p"),
            F.lit(s.ci_95_low_pp).cast("double").alias("o_ci"),
            F.lit(s.unsubscribe_rate_pct).cast("double").alias("o_unsub"),
            F.lit(s.estimated_roi_pct).cast("double").alias("o_roi"),
            F.lit(s.underpowered).alias("o_under"),
        )
        for i, s in enumerate(scenarios)
    ])
    x = inputs.select("*", F.inline(arr))
    over = x.select(
        "experiment_id", "scenario_order", "scenario_id", "scenario_description", "best_variant",
        F.coalesce("o_quality", "quality_passed").alias("quality_passed"),
        F.coalesce("o_srm", "srm_p_value").alias("srm_p_value"),
        F.coalesce("o_smd", "max_absolute_smd").alias("max_absolute_smd"),
        F.coalesce("o_p", "bonferroni_p_value").alias("bonferroni_p_value"),
        F.coalesce("o_ci", "ci_95_low_pp").alias("ci_95_low_pp"),
        F.coalesce("o_unsub", "guardrail_unsubscribe_rate_pct").alias("guardrail_unsubscribe_rate_pct"),
        F.coalesce("o_roi", "estimated_roi_pct").alias("estimated_roi_pct"),
        F.when(F.col("o_under"), F.col("required_members_per_arm") - 1)
        .otherwise(F.col("observed_members_per_arm")).alias("observed_members_per_arm"),
        "required_members_per_arm",
    )
    return evaluate(over, spec)


def gates_table(decisions: DataFrame, keys: tuple[str, ...] = ("experiment_id",)) -> DataFrame:
    """One row per gate (flat form of the gates array)."""
    return decisions.select(*keys, F.inline("gates"))
