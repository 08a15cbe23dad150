"""Each of Q-1..Q-26 passes on a clean world and fails by exactly one row
when one violating row is introduced; NULL results and missing arms fail."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapsewise.operators.quality import RULE_BY_NAME, RULES, Tables, quality_passed, quality_results, violations
from lapsewise.plans.pipeline import CampaignRun
from lapsewise.schemas import ASSIGNMENTS, CONSENT, EVENTS, EXCLUSIONS, LISTINGS, MEMBERS, TOUCHES

T = datetime(2026, 8, 1, 9, 0, 0)
D = timedelta(days=1)
CAMP = "seller_reactivation_2026_08"
EXP = "exp_seller_reactivation_2026_08"


def raw_rows():
    ms = ["m1", "m2", "m3"]
    arms = {"m1": "control", "m2": "generic", "m3": "personalized"}
    return {
        "members": [(m, datetime(2020, 1, 1), "R", "email", True, False, False) for m in ms],
        "events": [(f"e{i}", m, f"a{i}", "item_viewed", T - D, "Fashion", "web", "src") for i, m in enumerate(ms, 1)],
        "listings": [(f"l{i}", m, "c", T - 100 * D, None, Decimal("0.00")) for i, m in enumerate(ms, 1)],
        "campaign_touches": [(f"t{m}", m, CAMP, arms[m], "email", T + timedelta(minutes=30), None, None, None)
                             for m in ms if arms[m] != "control"],
        "consent_history": [(f"c{i}", m, "email", "subscribed", T - 10 * D, "pc") for i, m in enumerate(ms, 1)],
        "campaign_exclusions": [],
        "experiment_assignments": [(EXP, m, arms[m], T - timedelta(hours=1)) for m in ms],
    }


SCHEMAS = {"members": MEMBERS, "events": EVENTS, "listings": LISTINGS, "campaign_touches": TOUCHES,
           "consent_history": CONSENT, "campaign_exclusions": EXCLUSIONS, "experiment_assignments": ASSIGNMENTS}


def world(spark, spec, mutate=None, marts=None):
    rows = raw_rows()
    if mutate:
        mutate(rows)
    raw = {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in rows.items()}
    run = CampaignRun(spark, spec, raw)
    clean = CampaignRun(spark, spec, {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in raw_rows().items()})
    m = {"m360": clean.member_360, "audience": clean.eligible_audience, "outcomes": clean.member_outcomes,
         "results": clean.experiment_results}
    if marts:
        m.update(marts(m))
    return Tables(run.raw(), m["m360"], m["audience"], m["outcomes"], m["results"], spec)


def actual(t, name):
    r = RULE_BY_NAME[name]
    if r.scope is not None:
        v = violations(t, name)
        return v.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    return r.count(t).first()["actual"]


def add(table, row):
    return lambda rows: rows[table].append(row)


def edit(table, idx, **changes):
    fields = {"members": MEMBERS, "experiment_assignments": ASSIGNMENTS}[table].fieldNames()

    def f(rows):
        r = list(rows[table][idx])
        for k, v in changes.items():
            r[fields.index(k)] = v
        rows[table][idx] = tuple(r)
    return f


def mart_edit(name, **cols):
    def f(m):
        df = m[name]
        for c, v in cols.items():
            df = df.withColumn(c, F.when(F.col("member_id") == "m1", F.lit(v)).otherwise(F.col(c)))
        return {name: df}
    return f


CASES = {
    "member_primary_key_unique": dict(mutate=add("members", ("m1", datetime(2020, 1, 1), "R", "email", True, False, False))),
    "event_primary_key_unique": dict(mutate=add("events", ("e1", "m1", "a1", "item_viewed", T - D, None, "web", "s"))),
    "listing_primary_key_unique": dict(mutate=add("listings", ("l1", "m1", "c", T - 100 * D, None, Decimal("0")))),
    "event_member_referential_integrity": dict(mutate=add("events", ("e9", "zz", "a9", "item_viewed", T - D, None, "web", "s"))),
    "anonymous_identity_maps_to_one_member": dict(mutate=add("events", ("e9", "m2", "a1", "item_viewed", T - D, None, "web", "s"))),
    "accepted_event_names": dict(mutate=add("events", ("e9", "m1", "a1", "bogus", T - D, None, "web", "s"))),
    "events_not_before_member_join": dict(mutate=add("events", ("e9", "m1", "a1", "item_viewed", datetime(2019, 1, 1), None, "web", "s"))),
    "listing_member_referential_integrity": dict(mutate=add("listings", ("l9", "zz", "c", T - D, None, Decimal("0")))),
    "listing_sale_after_creation": dict(mutate=add("listings", ("l9", "m1", "c", T - D, T - 2 * D, Decimal("5")))),
    "touch_member_referential_integrity": dict(mutate=add("campaign_touches", ("t9", "zz", "old", "historical", "email", T - 30 * D, None, None, None))),
    "accepted_consent_statuses": dict(mutate=add("consent_history", ("c9", "m1", "push", "maybe", T - 20 * D, "pc"))),
    "campaign_date_consent_snapshot_reconciles": dict(mutate=add("consent_history", ("c9", "m1", "email", "unsubscribed", T - D, "pc"))),
    "audience_has_channel_consent": dict(marts=mart_edit("audience", activation_channel="push")),
    "audience_has_no_suppressed_members": dict(mutate=edit("members", 0, is_suppressed=True)),
    "audience_respects_contact_cap": dict(marts=mart_edit("m360", marketing_contacts_7d=2)),
    "audience_has_no_campaign_conflict": dict(marts=mart_edit("m360", has_active_campaign_exclusion=True)),
    "audience_is_lapsed_and_recently_active": dict(marts=mart_edit("m360", is_lapsed_seller=False)),
    "experiment_assignment_unique": dict(mutate=add("experiment_assignments", (EXP, "m1", "generic", T - D))),
    "accepted_experiment_variants": dict(mutate=edit("experiment_assignments", 0, variant="holdout")),
    "assignment_precedes_campaign": dict(mutate=edit("experiment_assignments", 0, assigned_at=T)),
    "all_audience_members_randomized": dict(mutate=lambda rows: rows["experiment_assignments"].pop(0)),
    "no_ineligible_member_randomized": dict(mutate=add("experiment_assignments", (EXP, "m9", "control", T - D))),
    "control_receives_no_campaign_message": dict(marts=mart_edit("outcomes", message_sent_count=1)),
    "treatments_receive_one_campaign_message": dict(
        marts=lambda m: {"outcomes": m["outcomes"].withColumn(
            "message_sent_count", F.when(F.col("member_id") == "m2", F.lit(2)).otherwise(F.col("message_sent_count")))}),
    "experiment_groups_balanced": dict(mutate=lambda rows: rows["experiment_assignments"].extend(
        [(EXP, "m8", "control", T - D), (EXP, "m9", "control", T - D)])),
    "experiment_results_reconcile": dict(marts=lambda m: {"results": m["results"].filter("variant <> 'control'")}),
}


def test_every_rule_has_a_violating_case():
    assert set(CASES) == {r.name for r in RULES}


def test_clean_world_passes_every_rule(spark, spec):
    t = world(spark, spec)
    res = {r.name: r for r in quality_results(t).collect()}
    assert len(res) == 26
    assert all(r.status == "PASS" and r.actual == 0 for r in res.values()), [r for r in res.values() if r.status != "PASS"]
    assert quality_passed(quality_results(t)).first().quality_passed


@pytest.mark.parametrize("name", sorted(CASES))
def test_one_violation_fails_exactly_that_rule(spark, spec, name):
    t = world(spark, spec, **CASES[name])
    assert actual(t, name) == 1


def test_empty_results_and_missing_arm_fail(spark, spec):
    t = world(spark, spec, marts=lambda m: {"results": m["results"].limit(0)})
    assert actual(t, "experiment_results_reconcile") is None
    res = {r.name: r.status for r in quality_results(t).collect()}
    assert res["experiment_results_reconcile"] == "FAIL"
    def drop_arm(rows):
        rows["experiment_assignments"].pop(2)
        rows["experiment_assignments"].extend([(EXP, "m8", "control", T - D), (EXP, "m9", "generic", T - D)])

    t2 = world(spark, spec, mutate=drop_arm)
    assert actual(t2, "experiment_groups_balanced") == 1  # 2/2/0: personalized has nobody
