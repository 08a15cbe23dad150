"""member_360 edge rows: window bounds, NULLs, ties, rule order, channel."""

from datetime import datetime, timedelta

import pytest

from lapsewise.operators.audience import ELIGIBILITY_RULES, activation_channel, eligible_audience, funnel
from lapsewise.operators.consent import latest_consent, latest_consent_by_window
from lapsewise.operators.features import member_360
from lapsewise.schemas import CONSENT, EVENTS, EXCLUSIONS, LISTINGS, MEMBERS, TOUCHES

T = datetime(2026, 8, 1, 9, 0, 0)
D = timedelta(days=1)
S = timedelta(seconds=1)


def frames(spark, members, listings=(), events=(), touches=(), exclusions=()):
    return (spark.createDataFrame(list(members), MEMBERS), spark.createDataFrame(list(listings), LISTINGS),
            spark.createDataFrame(list(events), EVENTS), spark.createDataFrame(list(touches), TOUCHES),
            spark.createDataFrame(list(exclusions), EXCLUSIONS))


def member(mid, email=True, push=False, suppressed=False, pref="email"):
    return (mid, datetime(2020, 1, 1), "R", pref, email, push, suppressed)


def listing(lid, mid, at, sold=None, value="10.00"):
    from decimal import Decimal
    return (lid, mid, "cat", at, sold, Decimal(value))


def event(eid, mid, at, name="item_viewed", category="Fashion"):
    return (eid, mid, "a", name, at, category, "web", "src")


def touch(tid, mid, at):
    return (tid, mid, "old", "historical", "email", at, None, None, None)


def m360(spark, spec, **kw):
    return {r.member_id: r for r in member_360(*frames(spark, **kw), spec).collect()}


def test_window_bounds(spark, spec):
    lapse = T - 90 * D
    r = m360(spark, spec,
             members=[member("lapsed"), member("fresh"), member("none"), member("post")],
             listings=[listing("l1", "lapsed", lapse), listing("l2", "fresh", lapse + S),
                       listing("l3", "post", T), listing("l4", "post", T + 3 * D)],
             events=[event("e1", "lapsed", T - 30 * D), event("e2", "lapsed", T), event("e3", "fresh", T - 30 * D - S)],
             touches=[touch("t1", "lapsed", T - 7 * D), touch("t2", "lapsed", T), touch("t3", "fresh", T - 7 * D),
                      touch("t4", "fresh", T - 7 * D + S)],
             exclusions=[("fresh", "hold", T, T), ("none", "hold", T - 2 * D, T - S)])
    assert r["lapsed"].is_lapsed_seller and r["lapsed"].recent_event_count == 1
    assert r["lapsed"].marketing_contacts_7d == 1 and r["lapsed"].within_contact_cap
    assert not r["fresh"].is_lapsed_seller and r["fresh"].recent_event_count == 0
    assert r["fresh"].marketing_contacts_7d == 2 and not r["fresh"].within_contact_cap
    assert r["fresh"].has_active_campaign_exclusion and not r["none"].has_active_campaign_exclusion
    # listings at/after the instant are outcome, never history
    assert r["post"].historical_listing_count == 0 and not r["post"].has_seller_history
    # a member with nothing anywhere: zeros, NULL timestamps, flags never NULL
    n = r["none"]
    assert n.historical_listing_count == 0 and n.last_listing_at is None and n.last_activity_at is None
    assert n.is_lapsed_seller is False and n.eligibility_status == "no_seller_history" and n.is_eligible is False
    assert r["lapsed"].last_activity_at == T - 30 * D  # event at T is excluded


def test_latest_category_ties_and_nulls(spark, spec):
    r = m360(spark, spec, members=[member("m")],
             events=[event("E1", "m", T - D, category="A"), event("E2", "m", T - D, category="B"),
                     event("E3", "m", T - S, category=None), event("E4", "m", T + D, category="Z")])
    assert r["m"].preferred_category == "B"  # same instant: greatest event_id wins


def test_status_walks_rules_in_order(spark, spec):
    """One member failing everything, repaired one rule at a time."""
    base = dict(hist=False, lapsed=False, active=False, consent=False, suppressed=True, cap=False, conflict=True)
    order = ["hist", "lapsed", "active", "consent", "suppressed", "cap", "conflict"]
    expected = [r.reason for r in ELIGIBILITY_RULES] + ["eligible"]
    seen = []
    state = dict(base)
    for step in range(len(order) + 1):
        mem = member("m", email=state["consent"], suppressed=state["suppressed"])
        listings = [] if not state["hist"] else [listing("l", "m", T - (100 if state["lapsed"] else 10) * D)]
        events = [event("e", "m", T - D)] if state["active"] else []
        touches = [] if state["cap"] else [touch("t1", "m", T - D), touch("t2", "m", T - D)]
        excl = [("m", "hold", T - D, T + D)] if state["conflict"] else []
        r = m360(spark, spec, members=[mem], listings=listings, events=events, touches=touches, exclusions=excl)["m"]
        seen.append(r.eligibility_status)
        assert r.is_eligible == (r.eligibility_status == "eligible")
        if step < len(order):
            k = order[step]
            state[k] = not base[k]
    assert seen == expected


def test_activation_channel_matrix(spark, spec):
    rows = [("email", True, True), ("email", False, True), ("email", True, False), ("email", False, False),
            ("push", True, True), ("push", True, False), ("push", False, True), ("push", False, False)]
    df = spark.createDataFrame(rows, "preferred_channel string, email_consent boolean, push_consent boolean")
    got = [r.c for r in df.select(activation_channel(spec).alias("c")).collect()]
    assert got == ["email", "push", "email", "push", "push", "email", "push", "push"]


def test_consent_as_of_matches_window_oracle(spark, spec):
    rows = [("c1", "m", "email", "subscribed", T - 2 * D, "s"), ("c2", "m", "email", "unsubscribed", T - D, "s"),
            ("c3", "m", "email", "subscribed", T, "s"),  # at T: not before -> ignored
            ("c4", "m", "push", "subscribed", T - D, "s"), ("c5", "m", "push", "unsubscribed", T - D, "s")]
    df = spark.createDataFrame(rows, CONSENT)
    a = sorted((r.member_id, r.channel, r.status) for r in latest_consent(df, T).collect())
    b = sorted((r.member_id, r.channel, r.status) for r in latest_consent_by_window(df, T).collect())
    assert a == b == [("m", "email", "unsubscribed"), ("m", "push", "unsubscribed")]


def test_features_of_members_are_not_sent_through_the_driver(spark, spec, tmp_path):
    rows = dict(members=[member("m1"), member("m2")], listings=[listing("l", "m1", T - 400 * D)], events=[event("e", "m1", T - D)],
                touches=[touch("t", "m2", T - D)])
    sources = []
    for k, df in enumerate(frames(spark, **rows)):  # files: their small sizes are known
        df.write.parquet(str(tmp_path / str(k)))
        sources.append(spark.read.parquet(str(tmp_path / str(k))))
    assert "Broadcast" not in member_360(*sources, spec)._jdf.queryExecution().executedPlan().toString()
    got = m360(spark, spec, **rows)
    assert (got["m1"].historical_listing_count, got["m1"].recent_event_count, got["m2"].marketing_contacts_7d) == (1, 1, 1)


def test_audience_equals_eligible_members_and_funnel_ends_there(spark, spec):
    r = member_360(*frames(spark, members=[member("a"), member("b", email=False)],
                           listings=[listing("l1", "a", T - 100 * D), listing("l2", "b", T - 100 * D)],
                           events=[event("e1", "a", T - D), event("e2", "b", T - D)]), spec)
    aud = eligible_audience(r, spec)
    assert [x.member_id for x in aud.collect()] == ["a"]
    f = [x.members for x in funnel(r).orderBy("stage_order").collect()]
    assert f == [2, 2, 2, 2, 1, 1, 1, 1]
