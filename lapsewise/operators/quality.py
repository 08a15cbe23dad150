"""Blocking data-quality and campaign-safety rules (Q-1..Q-35).

Every rule keeps its violating rows (``violations``) and reports a count
(``quality_results``). The runner never issues one query per rule: rules that
are row-local over the same input form a *scope* and are counted together in
one aggregate (one scan, one optional join). Duplicate keys are found by a
two-phase ``groupBy`` (duplicates collapse map-side), identity conflicts by
``min <> max`` instead of ``count(distinct)``, and orphan touches by
pre-aggregating per member before the anti-join.

Intentional differences from the reference: a NULL result (e.g. an empty
results table) is a FAIL, and a declared arm with no members fails balance.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ts
from ..schemas import CONSENT_STATUSES, EVENT_NAMES, SUBSCRIBED
from ..spec import CampaignSpec
from .consent import latest_consent


class Tables:
    """The inputs the rules read: raw entities plus the marts built from them."""

    def __init__(self, raw: dict[str, DataFrame], member_360: DataFrame, audience: DataFrame,
                 outcomes: DataFrame, results: DataFrame, spec: CampaignSpec):
        self.raw, self.m360, self.audience = raw, member_360, audience
        self.outcomes, self.results, self.spec = outcomes, results, spec

    def __getitem__(self, name: str) -> DataFrame:
        return self.raw[name]

    # Rules on a table's own columns count its rows alone. Rules about members
    # aggregate per member first, so no raw row crosses a shuffle for them.
    @cached_property
    def events(self) -> DataFrame:
        return self["events"].select("member_id", "event_name", "event_ts", F.lit(1).alias("_w"))

    @cached_property
    def listings(self) -> DataFrame:
        return self["listings"].select("member_id", "created_at", "sold_at", F.lit(1).alias("_w"))

    def _unknown(self, table: str) -> DataFrame:
        """Member ids of ``table`` that no member has (NULL among them), with their rows."""
        per_member = self[table].groupBy("member_id").agg(F.count(F.lit(1)).alias("_w"))
        return per_member.join(self["members"].select("member_id"), "member_id", "left_anti")

    @cached_property
    def events_unknown(self) -> DataFrame:
        return self._unknown("events")

    @cached_property
    def listings_unknown(self) -> DataFrame:
        return self._unknown("listings")

    @cached_property
    def touches_unknown(self) -> DataFrame:
        return self._unknown("campaign_touches")

    @cached_property
    def events_early(self) -> DataFrame:
        """Events before their member joined. Members with such an event show from
        the first event of each; only events before the latest of their join
        times are looked at again (none in a clean table)."""
        members = self["members"].select("member_id", "joined_at")
        first = self["events"].groupBy("member_id").agg(F.min("event_ts").alias("first_ts"))
        late = first.join(members, "member_id").filter("first_ts < joined_at").select("member_id", "joined_at")
        until = late.agg(F.max("joined_at")).scalar()
        events = self["events"].select("member_id", "event_name", "event_ts").filter(F.col("event_ts") < until)
        return events.join(late, "member_id").filter("event_ts < joined_at").select("*", F.lit(1).alias("_w"))

    @cached_property
    def consent(self) -> DataFrame:
        return self["consent_history"].select("status", F.lit(1).alias("_w"))

    @cached_property
    def consent_members(self) -> DataFrame:
        latest = latest_consent(self["consent_history"], self.spec.campaign_at)
        m = self["members"].select("member_id", "email_consent", "push_consent")
        return latest.join(m, "member_id").select("*", F.lit(1).alias("_w"))

    @cached_property
    def audience_members(self) -> DataFrame:
        m = self["members"].select("member_id", "email_consent", "push_consent", "is_suppressed")
        return self.audience.select("member_id", "activation_channel").join(m, "member_id").select("*", F.lit(1).alias("_w"))

    @cached_property
    def audience_m360(self) -> DataFrame:
        m = self.m360.select(
            "member_id", "marketing_contacts_7d", "has_active_campaign_exclusion",
            "is_lapsed_seller", "has_recent_activity",
        )
        return self.audience.select("member_id").join(m, "member_id").select("*", F.lit(1).alias("_w"))

    @cached_property
    def assignments(self) -> DataFrame:
        return self["experiment_assignments"].select("variant", "assigned_at", F.lit(1).alias("_w"))

    @cached_property
    def outcomes_scope(self) -> DataFrame:
        return self.outcomes.select("variant", "message_sent_count", F.lit(1).alias("_w"))

    def scope(self, name: str) -> DataFrame:
        return self.outcomes_scope if name == "outcomes" else getattr(self, name)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    description: str
    scope: str | None = None  # row-local rules: scope name + predicate
    predicate: Callable[[CampaignSpec], Column] | None = None
    # other rules: a function returning a one-row DataFrame with column "actual"
    count: Callable[[Tables], DataFrame] | None = None
    violations: Callable[[Tables], DataFrame] | None = None


# --- non-row-local rule building blocks -------------------------------------

def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys seen more than once (NULL keys always count), with their excess.

    Equals ``count(*) - count(distinct key)`` when summed: every NULL row is
    excess because ``count(distinct)`` ignores NULLs.
    """
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    excess = F.when(F.col(key).isNull(), F.col("n")).otherwise(F.col("n") - 1)
    return g.select(key, "n", excess.alias("excess")).filter("excess > 0")


def _dup_count(table: str, key: str):
    return lambda t: duplicate_keys(t[table], key).agg(F.coalesce(F.sum("excess"), F.lit(0)).alias("actual"))


def _dup_violations(table: str, key: str):
    return lambda t: duplicate_keys(t[table], key)


def identity_conflicts(events: DataFrame) -> DataFrame:
    """Anonymous ids that resolve to more than one member (min <> max)."""
    return (
        events.groupBy("anonymous_id")
        .agg(F.min("member_id").alias("min_member"), F.max("member_id").alias("max_member"))
        .filter(F.col("min_member") != F.col("max_member"))
    )


def orphan_touches(t: Tables) -> DataFrame:
    return t.touches_unknown.select("member_id", F.col("_w").alias("touches"))


def arm_balance(t: Tables) -> DataFrame:
    """0 if arm sizes differ by at most one, else 1. Declared arms enter with
    0 members, so an arm nobody was assigned to fails (the reference cannot
    see it). Both inputs are arm-sized: the union/regroup is tiny."""
    spark = t["experiment_assignments"].sparkSession
    declared = spark.createDataFrame([(a, 0) for a in t.spec.arms], "variant string, n bigint")
    counts = t["experiment_assignments"].groupBy("variant").agg(F.count(F.lit(1)).alias("n"))
    per_arm = counts.unionByName(declared).groupBy("variant").agg(F.sum("n").alias("n"))
    return per_arm.agg(
        F.when(F.max("n") - F.min("n") <= 1, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("actual")
    )


def results_reconcile(t: Tables) -> DataFrame:
    """|audience rows - sum(assigned_members)|; NULL when results are empty."""
    audience_n = t.audience.agg(F.count(F.lit(1)))
    assigned = t.results.agg(F.sum("assigned_members"))
    return t.results.sparkSession.range(1).select(
        F.abs(audience_n.scalar() - assigned.scalar()).cast("bigint").alias("actual")
    )


def _anti(left: str, right: str):
    def count(t: Tables) -> DataFrame:
        return violations(t).agg(F.count(F.lit(1)).alias("actual"))

    def violations(t: Tables) -> DataFrame:
        a = t.audience if left == "audience" else t[left]
        b = t.audience if right == "audience" else t[right]
        return a.select("member_id").join(b.select("member_id"), "member_id", "left_anti")

    return count, violations


# --- the rule list (fixed names, in the reference's order) ------------------

def _rules() -> tuple[Rule, ...]:
    names = list(EVENT_NAMES)
    statuses = list(CONSENT_STATUSES)
    aud_x, aud_x_v = _anti("audience", "experiment_assignments")
    asg_x, asg_x_v = _anti("experiment_assignments", "audience")
    return (
        Rule("Q-1", "member_primary_key_unique", "No member id occurs twice.",
             count=_dup_count("members", "member_id"), violations=_dup_violations("members", "member_id")),
        Rule("Q-2", "event_primary_key_unique", "No event id occurs twice.",
             count=_dup_count("events", "event_id"), violations=_dup_violations("events", "event_id")),
        Rule("Q-3", "listing_primary_key_unique", "No listing id occurs twice.",
             count=_dup_count("listings", "listing_id"), violations=_dup_violations("listings", "listing_id")),
        Rule("Q-4", "event_member_referential_integrity", "Events belong to members that exist.",
             scope="events_unknown", predicate=lambda s: F.lit(True)),
        Rule("Q-5", "anonymous_identity_maps_to_one_member",
             "One anonymous id is never seen with two members.",
             count=lambda t: identity_conflicts(t["events"]).agg(F.count(F.lit(1)).alias("actual")),
             violations=lambda t: identity_conflicts(t["events"])),
        Rule("Q-6", "accepted_event_names", "Event names are among those of the tracking plan.",
             scope="events", predicate=lambda s: ~F.col("event_name").isin(*names)),
        Rule("Q-7", "events_not_before_member_join", "Members have no event before they joined.",
             scope="events_early", predicate=lambda s: F.lit(True)),
        Rule("Q-8", "listing_member_referential_integrity", "Listings belong to members that exist.",
             scope="listings_unknown", predicate=lambda s: F.lit(True)),
        Rule("Q-9", "listing_sale_after_creation", "Listings are sold after they were created.",
             scope="listings",
             predicate=lambda s: F.col("sold_at").isNotNull() & (F.col("sold_at") < F.col("created_at"))),
        Rule("Q-10", "touch_member_referential_integrity", "Touches belong to members that exist.",
             scope="touches_unknown", predicate=lambda s: F.lit(True)),
        Rule("Q-11", "accepted_consent_statuses", "Consent statuses are among the allowed ones.",
             scope="consent", predicate=lambda s: ~F.col("status").isin(*statuses)),
        Rule("Q-12", "campaign_date_consent_snapshot_reconciles",
             "Consent flags agree with the last consent before the campaign.",
             scope="consent_members",
             predicate=lambda s: ((F.col("channel") == "email") & ((F.col("status") == SUBSCRIBED) != F.col("email_consent")))
             | ((F.col("channel") == "push") & ((F.col("status") == SUBSCRIBED) != F.col("push_consent")))),
        Rule("Q-13", "audience_has_channel_consent",
             "Audience members consented to their channel.",
             scope="audience_members",
             predicate=lambda s: ((F.col("activation_channel") == "email") & ~F.col("email_consent"))
             | ((F.col("activation_channel") == "push") & ~F.col("push_consent"))),
        Rule("Q-14", "audience_has_no_suppressed_members",
             "The audience holds no suppressed member.",
             scope="audience_members", predicate=lambda s: F.col("is_suppressed")),
        Rule("Q-15", "audience_respects_contact_cap",
             "Audience members are below the contact cap.",
             scope="audience_m360", predicate=lambda s: F.col("marketing_contacts_7d") >= s.contact_cap),
        Rule("Q-16", "audience_has_no_campaign_conflict", "Audience members have no campaign conflict.",
             scope="audience_m360", predicate=lambda s: F.col("has_active_campaign_exclusion")),
        Rule("Q-17", "audience_is_lapsed_and_recently_active",
             "Audience members lapsed as sellers and were active lately.",
             scope="audience_m360", predicate=lambda s: ~F.col("is_lapsed_seller") | ~F.col("has_recent_activity")),
        Rule("Q-18", "experiment_assignment_unique",
             "No member is assigned twice.",
             count=_dup_count("experiment_assignments", "member_id"),
             violations=_dup_violations("experiment_assignments", "member_id")),
        Rule("Q-19", "accepted_experiment_variants", "Assigned arms are among the declared ones.",
             scope="assignments", predicate=lambda s: ~F.col("variant").isin(*s.arms)),
        Rule("Q-20", "assignment_precedes_campaign", "Members are assigned before the campaign starts.",
             scope="assignments", predicate=lambda s: F.col("assigned_at") >= ts(s.campaign_at)),
        Rule("Q-21", "all_audience_members_randomized", "Every audience member is assigned.",
             count=aud_x, violations=aud_x_v),
        Rule("Q-22", "no_ineligible_member_randomized",
             "Every assigned member is in the audience.",
             count=asg_x, violations=asg_x_v),
        Rule("Q-23", "control_receives_no_campaign_message", "Control members receive no campaign message.",
             scope="outcomes",
             predicate=lambda s: (F.col("variant") == s.control_arm) & (F.col("message_sent_count") != 0)),
        Rule("Q-24", "treatments_receive_one_campaign_message",
             "Treated members receive one campaign message each.",
             scope="outcomes",
             predicate=lambda s: F.col("variant").isin(*s.treatments) & (F.col("message_sent_count") != 1)),
        Rule("Q-25", "experiment_groups_balanced",
             "Arm sizes differ by one member at most.", count=arm_balance),
        Rule("Q-26", "experiment_results_reconcile",
             "Members in the results add up to the audience.",
             count=results_reconcile),
    )


RULES: tuple[Rule, ...] = _rules()
RULE_BY_NAME = {r.name: r for r in RULES}


def violations(t: Tables, name: str) -> DataFrame:
    """The offending rows of one rule (kept, never just counted)."""
    r = RULE_BY_NAME[name]
    if r.scope is not None:
        return t.scope(r.scope).filter(F.coalesce(r.predicate(t.spec), F.lit(False)))
    if r.violations is not None:
        return r.violations(t)
    return r.count(t).filter(F.coalesce(F.col("actual") != 0, F.lit(True)))


def quality_results(t: Tables, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per rule: rule_id, name, status, actual, expected, description.

    Row-local rules sharing a scope are one aggregate over that scope.
    ``actual`` NULL (no data to judge) is a FAIL.
    """
    order = {r.name: i + 1 for i, r in enumerate(rules)}
    parts: list[DataFrame] = []
    scopes: dict[str, list[Rule]] = {}
    for r in rules:
        if r.scope is not None:
            scopes.setdefault(r.scope, []).append(r)
        else:
            parts.append(r.count(t).select(F.lit(r.name).alias("name"), F.col("actual").cast("bigint").alias("actual")))
    for scope, rs in scopes.items():
        agg = t.scope(scope).agg(
            *[F.coalesce(F.sum(F.when(F.coalesce(r.predicate(t.spec), F.lit(False)), F.col("_w")).otherwise(0)), F.lit(0)).alias(f"c{i}")
              for i, r in enumerate(rs)]
        )
        stack = F.array(*[F.struct(F.lit(r.name).alias("name"), F.col(f"c{i}").cast("bigint").alias("actual"))
                          for i, r in enumerate(rs)])
        parts.append(agg.select(F.inline(stack)))
    unioned = parts[0]
    for p in parts[1:]:
        unioned = unioned.unionByName(p)
    spark = unioned.sparkSession
    meta = spark.createDataFrame(
        [(order[r.name], r.rule_id, r.name, r.description) for r in rules],
        "rule_order int, rule_id string, name string, description string",
    )
    expected = F.lit(0).cast("bigint")
    return unioned.join(F.broadcast(meta), "name").select(
        "rule_order", "rule_id", "name",
        F.when(F.col("actual").isNotNull() & (F.col("actual") == expected), F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        "actual",
        expected.alias("expected"),
        "description",
    )


def quality_passed(results: DataFrame) -> DataFrame:
    """Q-35: the blocking gate -- one row, true only if every rule passed."""
    return results.agg(
        (F.count_if(F.col("status") != "PASS") == 0).alias("quality_passed"),
        F.count_if(F.col("status") == "PASS").alias("rules_passed"),
        F.count(F.lit(1)).alias("rules_total"),
    )


def descriptions() -> dict[str, str]:
    """What each rule says, by its name."""
    return {r.name: r.description for r in _rules()}
