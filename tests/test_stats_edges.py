"""Statistics and decision edge rows (FIXTURES §4)."""

import math

import pytest
from pyspark.sql import functions as F

from lapsewise.functions import stats as S
from lapsewise.operators import decision as D
from lapsewise.operators import experiment as X
from lapsewise.spec import CampaignSpec

RES = ("experiment_id string, variant string, assigned_members long, converted_members long, "
       "message_sent_count long, message_click_count long, unsubscribe_count long")


def test_wilson_n_zero_and_control_rate_zero(spark, spec):
    r = spark.range(1).select(S.wilson_interval(F.lit(0), F.lit(0), 1.96).alias("w")).first().w
    assert (r.low, r.high) == (0.0, 0.0)
    df = spark.createDataFrame([("e", "control", 100, 0, 0, 0, 0), ("e", "generic", 100, 5, 100, 0, 0),
                                ("e", "personalized", 100, 0, 100, 0, 0)], RES)
    rows = {x.variant: x for x in X.comparisons(df, spec).collect()}
    assert rows["generic"].relative_uplift_pct is None  # control rate 0
    assert rows["personalized"].z_score == 0.0 and rows["personalized"].p_value == 1.0  # se = 0


def test_smd_zero_variance_and_single_member(spark, spec):
    asg = spark.createDataFrame([("e", "a", "control"), ("e", "b", "generic"), ("e", "c", "generic")],
                                "experiment_id string, member_id string, variant string")
    cols = {c: 1 for c in spec.covariates}
    m360 = spark.createDataFrame([dict(member_id=m, **cols) for m in "abc"])
    bal = X.covariate_balance(asg, m360.select("member_id", *[F.col(c).cast("long") for c in spec.covariates]), spec)
    assert all(r.smd == 0.0 and r.control_variance == 0.0 for r in bal.collect())  # n=1 and zero variance -> 0


@pytest.mark.parametrize("counts,df", [((50, 50), 1), ((40, 50, 60), 2), ((10, 20, 30, 40), 3)])
def test_srm_any_number_of_arms(spark, counts, df):
    arms = tuple(f"a{i}" for i in range(len(counts)))
    spec = CampaignSpec(arms=arms, control_arm=arms[0])
    res = spark.createDataFrame([("e", a, n, 0, 0, 0, 0) for a, n in zip(arms, counts)], RES)
    r = X.sample_ratio_mismatch(res, spec).first()
    e = sum(counts) / len(counts)
    chi = sum((n - e) ** 2 / e for n in counts)
    assert r.df == df and math.isclose(r.chi_square, chi, rel_tol=1e-12)
    expected_p = {1: math.erfc(math.sqrt(chi / 2)), 2: math.exp(-chi / 2),
                  3: math.erfc(math.sqrt(chi / 2)) + math.exp(-chi / 2) * math.sqrt(chi / 2) / (math.sqrt(math.pi) / 2)}[df]
    assert math.isclose(r.p_value, expected_p, rel_tol=1e-9)


def test_missing_arm_fails_srm_and_power(spark, spec):
    res = spark.createDataFrame([("e", "control", 1000, 10, 0, 0, 0), ("e", "generic", 1000, 10, 1000, 0, 0)], RES)
    assert not X.sample_ratio_mismatch(res, spec).first().srm_passes
    p = X.power_plan(res, spec).first()
    assert p.observed_members_per_arm == 0 and not p.power_passes


def _inputs(spark, **over):
    base = dict(experiment_id="e", best_variant="generic", quality_passed=True, srm_p_value=0.5,
                max_absolute_smd=0.01, bonferroni_p_value=0.01, ci_95_low_pp=1.0,
                guardrail_unsubscribe_rate_pct=0.5, estimated_roi_pct=10.0,
                observed_members_per_arm=2000, required_members_per_arm=972)
    base.update(over)
    return spark.createDataFrame([base]).select(*base.keys())


def test_each_gate_fails_alone_and_order_is_kept(spark, spec):
    cases = {
        "data_quality": dict(quality_passed=False), "sample_ratio_mismatch": dict(srm_p_value=0.001),
        "pre_treatment_balance": dict(max_absolute_smd=0.2), "statistical_significance": dict(bonferroni_p_value=0.05),
        "confidence_interval": dict(ci_95_low_pp=0.0), "unsubscribe_guardrail": dict(guardrail_unsubscribe_rate_pct=1.01),
        "commercial_viability": dict(estimated_roi_pct=0.0), "statistical_power": dict(observed_members_per_arm=971),
    }
    assert D.evaluate(_inputs(spark), spec).first().rollout_ready
    for gate, over in cases.items():
        d = D.evaluate(_inputs(spark, **over), spec).first()
        assert list(d.failed_gates) == [gate] and not d.rollout_ready
    d = D.evaluate(_inputs(spark, estimated_roi_pct=-1.0, quality_passed=False, ci_95_low_pp=-1.0), spec).first()
    assert list(d.failed_gates) == ["data_quality", "confidence_interval", "commercial_viability"]
    assert d.recommendation == ("Do not roll out; investigate failed gates: data_quality, confidence_interval, "
                                "commercial_viability.")
    d = D.evaluate(_inputs(spark, guardrail_unsubscribe_rate_pct=1.0), spec).first()
    assert d.rollout_ready  # exactly 1% passes (<=)


def test_uplift_tie_goes_to_earlier_declared_arm(spark, spec):
    res = spark.createDataFrame([("e", "control", 100, 10, 0, 0, 0), ("e", "personalized", 100, 20, 100, 0, 0),
                                 ("e", "generic", 100, 20, 100, 0, 0)], RES)
    assert D.best_variant(X.comparisons(res, spec)).first().best_variant == "generic"
