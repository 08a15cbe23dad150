"""DuckDB oracle SQL for every registered query.

The oracle repeats the test-data mapping as CTEs over the pre-registered
views and computes each mart the way the reference's SQL does (CASE sums,
``row_number`` top-1, a global ``row_number`` for assignment) -- a different
method from the Spark plans, so agreement is a real cross-check.
"""

from __future__ import annotations

from datetime import datetime

from ..sources import testdata as td
from ..spec import CampaignSpec, testdata_spec


def lit_ts(dt: datetime) -> str:
    return f"TIMESTAMP '{dt.strftime('%Y-%m-%d %H:%M:%S')}'"


def lit_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def adapter_ctes(spec: CampaignSpec) -> list[tuple[str, str]]:
    T = lit_ts(spec.campaign_at)
    name_case = " ".join(f"WHEN '{s}' THEN '{d}'" for s, d in td.EVENT_NAME_MAP.items())
    member = "CAST(user_id * 10 + event_id % 10 AS VARCHAR)"
    platforms = ", ".join(f"'{p}'" for p in td.PLATFORMS)
    ctes = [
        ("raw_events", f"""
SELECT 'E' || CAST(event_id AS VARCHAR) AS event_id,
       {member} AS member_id,
       'A' || {member} || '-' || CAST(event_id % 3 AS VARCHAR) AS anonymous_id,
       CASE event_type {name_case} ELSE event_type END AS event_name,
       ts - INTERVAL {td.EVENT_SHIFT_DAYS} DAY AS event_ts,
       CASE WHEN event_type <> 'error'
            THEN 'cat_' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % {td.CATEGORY_BUCKETS} AS VARCHAR) END AS category,
       ([{platforms}])[event_id % 3 + 1] AS platform,
       '{td.EVENT_SOURCE}' AS source
FROM events"""),
        ("raw_consent_history", f"""
SELECT 'C' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS consent_id,
       {member} AS member_id,
       CASE WHEN event_id % 2 = 0 THEN 'email' ELSE 'push' END AS channel,
       CASE WHEN event_type = 'error' THEN 'unsubscribed' ELSE 'subscribed' END AS status,
       ts - INTERVAL {td.EVENT_SHIFT_DAYS} DAY AS effective_at,
       '{td.CONSENT_SOURCE}' AS source
FROM events"""),
        ("consent_ranked", f"""
SELECT member_id, channel, status, effective_at,
       row_number() OVER (PARTITION BY member_id, channel ORDER BY effective_at DESC, consent_id DESC) AS rn
FROM raw_consent_history WHERE effective_at < {T}"""),
        ("consent_latest", "SELECT member_id, channel, status, effective_at FROM consent_ranked WHERE rn = 1"),
        ("raw_members", f"""
SELECT CAST(c.c_custkey AS VARCHAR) AS member_id,
       {lit_ts(td.JOINED_EPOCH)} + to_days(CAST(c.c_custkey % {td.JOINED_SPREAD_DAYS} AS INTEGER)) AS joined_at,
       r.r_name AS region,
       CASE WHEN c.c_custkey % 3 = 2 THEN 'push' ELSE 'email' END AS preferred_channel,
       COALESCE(ce.status = 'subscribed', false) AS email_consent,
       COALESCE(cp.status = 'subscribed', false) AS push_consent,
       (c.c_custkey % {td.SUPPRESSION_MODULUS} = {td.SUPPRESSION_REMAINDER}) AS is_suppressed
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN consent_latest ce ON ce.member_id = CAST(c.c_custkey AS VARCHAR) AND ce.channel = 'email'
LEFT JOIN consent_latest cp ON cp.member_id = CAST(c.c_custkey AS VARCHAR) AND cp.channel = 'push'"""),
        ("raw_listings", f"""
SELECT CAST(o_orderkey AS VARCHAR) AS listing_id,
       CAST(o_custkey AS VARCHAR) AS member_id,
       o_orderpriority AS category,
       o_orderdate + INTERVAL {td.LISTING_CREATED_HOURS} HOUR AS created_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL {td.SOLD_AFTER_DAYS} DAY END AS sold_at,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS sale_value
FROM orders"""),
        ("raw_historical_touches", f"""
SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                     CAST(CAST(l_shipdate AS DATE) AS VARCHAR),
                     CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR))) AS touch_id,
       CAST(o_custkey AS VARCHAR) AS member_id,
       'historical' AS campaign_id, 'historical' AS variant,
       CASE WHEN l_linenumber % 2 = 0 THEN 'push' ELSE 'email' END AS channel,
       l_shipdate + INTERVAL {td.HISTORICAL_SENT_HOURS} HOUR AS sent_at,
       CAST(NULL AS TIMESTAMP) AS opened_at, CAST(NULL AS TIMESTAMP) AS clicked_at,
       CAST(NULL AS TIMESTAMP) AS unsubscribed_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
        ("raw_campaign_exclusions", f"""
SELECT CAST(o_custkey AS VARCHAR) AS member_id, '{td.EXCLUSION_REASON}' AS exclusion_reason,
       o_orderdate AS start_at, o_orderdate + INTERVAL {td.EXCLUSION_DAYS} DAY AS end_at
FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"""),
    ]
    return ctes


def first_failed(checks: list[tuple[str, str]]) -> str:
    """SQL for the name of the first check that does not hold (NULL: all hold)."""
    rows = ", ".join(f"{{'name': '{name}', 'holds': coalesce({holds}, false)}}" for name, holds in checks)
    return f"list_filter([{rows}], lambda c: NOT c.holds)[1].name"


def mart_ctes(spec: CampaignSpec) -> list[tuple[str, str]]:
    """The marts from their definitions: one grouped pass per source (windows as
    FILTERs), eligibility as an ordered list of checks."""
    T, E = lit_ts(spec.campaign_at), lit_ts(spec.outcome_end)
    before, after = f"created_at < {T}", f"created_at BETWEEN {T} AND {E}"
    recent = f"event_ts >= {lit_ts(spec.recent_start)}"
    sent = f"{T} + INTERVAL {td.TARGET_SENT_MINUTES} MINUTE"
    eligibility = first_failed([
        ("no_seller_history", "has_seller_history"),
        ("not_lapsed_90d", "is_lapsed_seller"),
        ("no_recent_activity_30d", "has_recent_activity"),
        ("no_marketing_consent", "has_marketing_consent"),
        ("suppressed", "NOT is_suppressed"),
        ("contact_cap_reached", "within_contact_cap"),
        ("campaign_conflict", "has_no_campaign_conflict"),
    ])
    # preferred channel first, then the channels in their fixed order
    channel = ("list_filter([preferred_channel, 'email', 'push'], "
               "lambda c: coalesce(map {'email': email_consent, 'push': push_consent}[c], false))[1]")
    response = {"opened_at": (1, td.OPEN_BELOW, 1), "clicked_at": (3, td.CLICK_BELOW, 2), "unsubscribed_at": (5, td.UNSUBSCRIBE_BELOW, 3)}
    responses = ", ".join(
        f"if(md5(member_id)[{at}:{at + 1}] < '{below}', {sent} + INTERVAL {h} HOUR, NULL) AS {name}"
        for name, (at, below, h) in response.items()
    )
    arm = f"row_number() OVER (ORDER BY md5('{spec.assignment_salt}|' || member_id), member_id) - 1"
    pct = "round(100.0 * {0} / nullif({1}, 0), 2)"
    return [
        ("listing_facts", f"""
SELECT member_id,
       count(*) FILTER ({before}) AS n_before, max(created_at) FILTER ({before}) AS latest_before,
       count(sold_at) FILTER ({before}) AS sold_before, sum(sale_value) FILTER ({before}) AS gmv_before,
       count(*) FILTER ({after}) AS n_after, count(sold_at) FILTER ({after}) AS sold_after,
       sum(sale_value) FILTER ({after}) AS gmv_after
FROM raw_listings GROUP BY ALL"""),
        ("event_facts", f"""
SELECT member_id, max(event_ts) AS latest, count(*) FILTER ({recent}) AS n_recent,
       count(*) FILTER ({recent} AND event_name = 'watchlist_added') AS n_watch,
       count(*) FILTER ({recent} AND event_name = 'purchase_completed') AS n_bought,
       last(category ORDER BY event_ts, event_id) FILTER (coalesce(category, '') <> '') AS category
FROM raw_events WHERE event_ts < {T} GROUP BY ALL"""),
        ("contact_facts", f"""
SELECT member_id, count(*) AS n FROM raw_historical_touches
WHERE sent_at >= {lit_ts(spec.contact_start)} AND sent_at < {T} GROUP BY ALL"""),
        ("member_facts", f"""
SELECT m.member_id, joined_at, region, preferred_channel, email_consent, push_consent, is_suppressed,
       ifnull(n_before, 0) AS historical_listing_count, latest_before AS last_listing_at,
       ifnull(sold_before, 0) AS historical_sales_count, ifnull(gmv_before, 0) AS historical_gmv,
       latest AS last_activity_at, ifnull(n_recent, 0) AS recent_event_count,
       ifnull(n_watch, 0) AS recent_watchlist_count, ifnull(n_bought, 0) AS recent_purchase_count,
       ifnull(t.n, 0) AS marketing_contacts_7d,
       EXISTS (FROM raw_campaign_exclusions x WHERE x.member_id = m.member_id AND {T} BETWEEN start_at AND end_at)
         AS has_active_campaign_exclusion,
       category AS preferred_category
FROM raw_members m LEFT JOIN listing_facts USING (member_id) LEFT JOIN event_facts USING (member_id)
     LEFT JOIN contact_facts t USING (member_id)"""),
        ("member_flags", f"""
SELECT *, historical_listing_count > 0 AS has_seller_history,
       ifnull(last_listing_at <= {lit_ts(spec.lapsed_cutoff)}, false) AS is_lapsed_seller,
       recent_event_count > 0 AS has_recent_activity,
       email_consent OR push_consent AS has_marketing_consent,
       marketing_contacts_7d < {spec.contact_cap} AS within_contact_cap,
       NOT has_active_campaign_exclusion AS has_no_campaign_conflict
FROM member_facts"""),
        ("member_360", f"""
SELECT *, ifnull({eligibility}, 'eligible') AS eligibility_status, eligibility_status = 'eligible' AS is_eligible
FROM member_flags"""),
        ("eligible_audience", f"""
SELECT member_id, region, {channel} AS activation_channel, preferred_category, historical_listing_count,
       historical_sales_count, historical_gmv, last_listing_at, last_activity_at, recent_event_count,
       recent_watchlist_count, recent_purchase_count, marketing_contacts_7d,
       '{spec.campaign_id}' AS campaign_id, {T} AS audience_created_at
FROM member_360 WHERE is_eligible"""),
        ("raw_experiment_assignments", f"""
SELECT '{spec.experiment_id}' AS experiment_id, member_id, {lit_ts(spec.assigned_at)} AS assigned_at,
       [{lit_list(spec.arms)}][1 + ({arm}) % {len(spec.arms)}] AS variant
FROM eligible_audience"""),
        ("raw_campaign_touches", f"""
FROM raw_historical_touches UNION ALL BY NAME
SELECT md5('{spec.campaign_id}|' || member_id) AS touch_id, member_id, '{spec.campaign_id}' AS campaign_id, variant,
       activation_channel AS channel, {sent} AS sent_at, {responses}
FROM raw_experiment_assignments JOIN eligible_audience USING (member_id)
WHERE variant IN ({lit_list(spec.treatments)})"""),
        ("response_facts", f"""
SELECT member_id, count(sent_at) AS message_sent_count, count(opened_at) AS message_open_count,
       count(clicked_at) AS message_click_count, count(unsubscribed_at) AS unsubscribe_count
FROM raw_campaign_touches WHERE campaign_id = '{spec.campaign_id}' GROUP BY ALL"""),
        ("member_outcomes", """
SELECT member_id, region, activation_channel, preferred_category, experiment_id, variant, assigned_at,
       ifnull(n_after, 0) > 0 AS converted_14d, ifnull(n_after, 0) AS listing_count_14d,
       ifnull(sold_after, 0) AS sold_listing_count_14d, ifnull(gmv_after, 0) AS observed_gmv_14d,
       ifnull(r.message_sent_count, 0) AS message_sent_count, ifnull(r.message_open_count, 0) AS message_open_count,
       ifnull(r.message_click_count, 0) AS message_click_count, ifnull(r.unsubscribe_count, 0) AS unsubscribe_count
FROM eligible_audience JOIN raw_experiment_assignments USING (member_id)
     LEFT JOIN listing_facts USING (member_id) LEFT JOIN response_facts r USING (member_id)"""),
        ("experiment_results", f"""
SELECT experiment_id, variant, count(*) AS assigned_members, count(*) FILTER (converted_14d) AS converted_members,
       {pct.format("count(*) FILTER (converted_14d)", "count(*)")} AS conversion_rate_pct,
       sum(listing_count_14d)::BIGINT AS total_listings_14d, sum(observed_gmv_14d) AS observed_gmv_14d,
       sum(o.message_sent_count)::BIGINT AS message_sent_count, sum(o.message_click_count)::BIGINT AS message_click_count,
       {pct.format("sum(o.message_click_count)", "sum(o.message_sent_count)")} AS click_rate_pct,
       sum(o.unsubscribe_count)::BIGINT AS unsubscribe_count,
       {pct.format("sum(o.unsubscribe_count)", "sum(o.message_sent_count)")} AS unsubscribe_rate_pct
FROM member_outcomes o GROUP BY ALL"""),
    ]


def with_ctes(body: str, spec: CampaignSpec | None = None, extra: list[tuple[str, str]] | None = None) -> str:
    spec = spec or testdata_spec()
    ctes = adapter_ctes(spec) + mart_ctes(spec) + (extra or [])
    return "WITH " + ",\n".join(f"{n} AS ({s.strip()})" for n, s in ctes) + "\n" + body.strip()


def _money(cols: list[str], money: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in money else c for c in cols)
