"""Published figures reproduced from the published counts alone."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from lapsewise.functions import stats as S
from lapsewise.operators import decision as D
from lapsewise.operators import experiment as X

EXP = "exp_seller_reactivation_2026_08"
# published arm counts: variant, assigned, converted, sent, clicks, unsubscribes
ARMS = [
    ("control", 1351, 107, 0, 0, 0),
    ("generic", 1350, 134, 1350, 121, 10),
    ("personalized", 1350, 153, 1350, 172, 3),
]


@pytest.fixture(scope="module")
def results(spark):
    rows = [(EXP, v, n, x, s, c, u) for v, n, x, s, c, u in ARMS]
    return spark.createDataFrame(
        rows,
        "experiment_id string, variant string, assigned_members long, converted_members long, "
        "message_sent_count long, message_click_count long, unsubscribe_count long",
    )


def close(a, b, rel=1e-9):
    return math.isclose(a, b, rel_tol=rel, abs_tol=1e-12)


def test_comparisons_match_published(results, spec):
    rows = {r.variant: r for r in X.comparisons(results, spec).collect()}
    g, p = rows["generic"], rows["personalized"]
    assert close(g.absolute_uplift_pp, 2.005866710529923)
    assert close(g.relative_uplift_pct, 25.326410522672205)
    assert close(g.ci_95_low_pp, -0.14827206190638592)
    assert close(g.ci_95_high_pp, 4.168728797736034)
    assert close(g.z_score, 1.8284489813965055)
    assert close(g.p_value, 0.06748219593315241)
    assert close(g.bonferroni_p_value, 0.13496439186630482)
    assert round(g.incremental_listings_estimate, 4) == 27.0792
    assert round(g.assumed_incremental_value, 4) == 148.9356
    assert round(g.assumed_campaign_cost, 2) == 100.25
    assert round(g.estimated_roi_pct, 4) == 48.5642
    assert close(p.absolute_uplift_pp, 3.41327411793733)
    assert close(p.relative_uplift_pct, 43.096573208722745)
    assert close(p.ci_95_low_pp, 1.1895786287261825)
    assert close(p.ci_95_high_pp, 5.649076626579727)
    assert close(p.z_score, 3.007166362144219)
    assert close(p.p_value, 0.002636954085714534)
    assert close(p.bonferroni_p_value, 0.005273908171429068)
    assert round(p.incremental_listings_estimate, 4) == 46.0792
    assert round(p.assumed_incremental_value, 4) == 253.4356
    assert round(p.assumed_campaign_cost, 2) == 147.0
    assert round(p.estimated_roi_pct, 4) == 72.4052
    assert round(g.guardrail_unsubscribe_rate_pct, 2) == 0.74
    assert round(p.guardrail_unsubscribe_rate_pct, 2) == 0.22


def test_srm_matches_published(results, spec):
    r = X.sample_ratio_mismatch(results, spec).collect()[0]
    assert close(r.chi_square, 0.0004937052579609973)
    assert close(r.p_value, 0.9997531778366229)
    assert r.srm_passes and r.df == 2


def test_power_plan_matches_published(results, spec):
    r = X.power_plan(results, spec).collect()[0]
    assert r.required_members_per_arm == 972
    assert r.observed_members_per_arm == 1350
    assert r.power_passes


def test_interval_contains_estimate(spark, spec):
    # the reference's single unit test: (162/1358) vs (93/1358)
    df = spark.createDataFrame([(EXP, "control", 1358, 93, 0, 0, 0), (EXP, "generic", 1358, 162, 1358, 0, 0)],
                               "experiment_id string, variant string, assigned_members long, converted_members long, "
                               "message_sent_count long, message_click_count long, unsubscribe_count long")
    r = X.comparisons(df, spec).collect()[0]
    assert r.ci_95_low_pp < r.absolute_uplift_pp < r.ci_95_high_pp


def test_baseline_decision_ready_and_sweep_blocks_expected_gate(spark, results, spec):
    cmp = X.comparisons(results, spec)
    srm = X.sample_ratio_mismatch(results, spec)
    # published max |SMD| 0.0474546630870764
    balance = spark.createDataFrame([(EXP, 0.0474546630870764)], "experiment_id string, max_absolute_smd double")
    power = X.power_plan(results, spec)
    q = spark.createDataFrame([(True,)], "quality_passed boolean")
    inputs = D.decision_inputs(cmp, srm, balance, power, q)
    d = D.evaluate(inputs, spec).collect()[0]
    assert d.best_variant == "personalized"
    assert d.rollout_ready and list(d.failed_gates) == []
    assert d.recommendation.startswith("Roll out personalized to a staged 50% audience")
    sweep = {r.scenario_id: r for r in D.scenario_sweep(inputs, spec).collect()}
    expected = {
        "control_contamination": "data_quality",
        "sample_ratio_mismatch": "sample_ratio_mismatch",
        "pre_treatment_imbalance": "pre_treatment_balance",
        "no_confirmatory_lift": "statistical_significance",
        "unsubscribe_breach": "unsubscribe_guardrail",
        "negative_roi": "commercial_viability",
        "underpowered_test": "statistical_power",
    }
    assert sweep["baseline"].rollout_ready
    for sid, gate in expected.items():
        assert not sweep[sid].rollout_ready
        assert gate in sweep[sid].failed_gates
    assert sum(r.rollout_ready for r in sweep.values()) == 1


def test_erfc_chi2_ppf(spark):
    xs = [0.0, 0.3, 1.0, 1.99, 2.0, 3.5, 5.0, -1.2]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", S.erfc(F.col("x")).alias("e")).collect()
    for r in rows:
        assert math.isclose(r.e, math.erfc(r.x), rel_tol=1e-12)
    ps = [0.5, 0.8, 0.9875, 0.025]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", S.norm_ppf(F.col("p")).alias("q")).collect()
    for r in rows:
        assert abs(r.q - statistics.NormalDist().inv_cdf(r.p)) < 1e-12
    # 5% critical values for df 1..5
    crit = {1: 3.841458820694124, 2: 5.991464547107979, 3: 7.814727903251178, 4: 9.487729036781154, 5: 11.070497693516351}
    df = spark.createDataFrame([(x, k) for k, x in crit.items()], "x double, k int")
    for r in df.select(S.chi2_sf(F.col("x"), F.col("k")).alias("p")).collect():
        assert abs(r.p - 0.05) < 1e-9
