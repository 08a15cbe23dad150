"""Maps the supplied star-schema tables onto the seven campaign entities.

The mapping rules are fixed (FIXTURES.md section 3) and repeated, as CTEs, in
the DuckDB oracle (``lapsewise.plans.oracle``). Everything here is a lazy
projection/join over the supplied Parquet files, so each entity grows with
the scale factor; no rows are invented on the driver.

Experiment assignments and the target campaign's touches are *derived*: the
eligible audience is computed from pre-campaign touches only (the target
touches are sent after the instant, so they cannot change any pre-campaign
feature), randomised with X-14, and one touch is emitted per treatment member.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import by_key, days, hours, minutes, ts
from ..plans.pipeline import CampaignRun
from ..spec import HISTORICAL_CAMPAIGN, CampaignSpec, testdata_spec

# ---------------------------------------------------------------------------
# Fixed values of the adapter (FIXTURES.md section 3).
# ---------------------------------------------------------------------------
EVENT_SHIFT_DAYS = 8301
JOINED_EPOCH = datetime(1994, 1, 1)
JOINED_SPREAD_DAYS = 300
SUPPRESSION_MODULUS, SUPPRESSION_REMAINDER = 53, 7
EVENT_NAME_MAP = {
    "view": "item_viewed",
    "click": "watchlist_added",
    "purchase": "purchase_completed",
    "signup": "listing_started",
    "error": "session_started",
}
CATEGORY_BUCKETS = 7
PLATFORMS = ("web", "ios", "android")
EVENT_SOURCE = "product_tracking"
CONSENT_SOURCE = "preference_center"
LISTING_CREATED_HOURS = 12
SOLD_AFTER_DAYS = 5
HISTORICAL_SENT_HOURS = 9
EXCLUSION_DAYS = 180
EXCLUSION_REASON = "priority_journey_hold"
TARGET_SENT_MINUTES = 30
# response thresholds on the 1st/2nd/3rd hex pair of md5(member_id)
OPEN_BELOW, CLICK_BELOW, UNSUBSCRIBE_BELOW = "80", "20", "02"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def between(df: DataFrame, column: str, shift: timedelta, since: datetime | None, until: datetime | None) -> DataFrame:
    """Rows whose ``column`` + ``shift`` lies in [since, until). The bounds are moved,
    not the column, so Parquet sees them."""
    if since is not None:
        df = df.filter(F.col(column) >= ts(since - shift))
    return df if until is None else df.filter(F.col(column) < ts(until - shift))


def events_entity(spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    e = between(read_table(spark, sf_dir, "events"), "ts", -timedelta(days=EVENT_SHIFT_DAYS), since, until)
    member = (F.col("user_id") * 10 + F.col("event_id") % 10).cast("string")
    name_expr = F.coalesce(
        *[F.when(F.col("event_type") == s, F.lit(d)) for s, d in EVENT_NAME_MAP.items()],
        F.col("event_type"),
    )
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("event_id"),
        member.alias("member_id"),
        F.concat(F.lit("A"), member, F.lit("-"), (F.col("event_id") % 3).cast("string")).alias("anonymous_id"),
        name_expr.alias("event_name"),
        (F.col("ts") - days(EVENT_SHIFT_DAYS)).alias("event_ts"),
        F.when(F.col("event_type") != "error", F.concat(F.lit("cat_"), (k % CATEGORY_BUCKETS).cast("string"))).alias("category"),
        F.element_at(F.array(*[F.lit(p) for p in PLATFORMS]), (F.col("event_id") % 3 + 1).cast("int")).alias("platform"),
        F.lit(EVENT_SOURCE).alias("source"),
    )


def consent_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    member = (F.col("user_id") * 10 + F.col("event_id") % 10).cast("string")
    return e.select(
        F.concat(F.lit("C"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("consent_id"),
        member.alias("member_id"),
        F.when(F.col("event_id") % 2 == 0, F.lit("email")).otherwise(F.lit("push")).alias("channel"),
        F.when(F.col("event_type") == "error", F.lit("unsubscribed")).otherwise(F.lit("subscribed")).alias("status"),
        (F.col("ts") - days(EVENT_SHIFT_DAYS)).alias("effective_at"),
        F.lit(CONSENT_SOURCE).alias("source"),
    )


def members_entity(spark: SparkSession, sf_dir: str, consent: DataFrame, spec: CampaignSpec) -> DataFrame:
    from ..operators.consent import consent_snapshot

    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    key = F.col("c_custkey")
    base = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            key.cast("string").alias("member_id"),
            (ts(JOINED_EPOCH) + days((key % JOINED_SPREAD_DAYS).cast("int"))).alias("joined_at"),
            F.col("r_name").alias("region"),
            F.when(key % 3 == 2, F.lit("push")).otherwise(F.lit("email")).alias("preferred_channel"),
            (key % SUPPRESSION_MODULUS == SUPPRESSION_REMAINDER).alias("is_suppressed"),
        )
    )
    snap = consent_snapshot(consent, spec.campaign_at, spec.channels)
    return base.join(by_key(snap), "member_id", "left").select(
        "member_id", "joined_at", "region", "preferred_channel",
        *[F.coalesce(F.col(f"{ch}_consent"), F.lit(False)).alias(f"{ch}_consent") for ch in ("email", "push")],
        "is_suppressed",
    )


def listings_entity(spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    o = between(read_table(spark, sf_dir, "orders"), "o_orderdate", timedelta(hours=LISTING_CREATED_HOURS), since, until)
    sold = F.col("o_orderstatus") == "F"
    return o.select(
        F.col("o_orderkey").cast("string").alias("listing_id"),
        F.col("o_custkey").cast("string").alias("member_id"),
        F.col("o_orderpriority").alias("category"),
        (F.col("o_orderdate") + hours(LISTING_CREATED_HOURS)).alias("created_at"),
        F.when(sold, F.col("o_orderdate") + days(SOLD_AFTER_DAYS)).alias("sold_at"),
        F.when(sold, F.col("o_totalprice").cast("decimal(18,2)")).otherwise(F.lit(0).cast("decimal(18,2)")).alias("sale_value"),
    )


def historical_touches_entity(spark: SparkSession, sf_dir: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    li = between(read_table(spark, sf_dir, "lineitem"), "l_shipdate", timedelta(hours=HISTORICAL_SENT_HOURS), since, until)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    natural = F.concat_ws(
        "|",
        F.col("l_orderkey").cast("string"),
        F.col("l_linenumber").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_suppkey").cast("string"),
        F.col("l_shipdate").cast("date").cast("string"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
    )
    null_ts = F.lit(None).cast("timestamp_ntz")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.md5(natural).alias("touch_id"),
        F.col("o_custkey").cast("string").alias("member_id"),
        F.lit(HISTORICAL_CAMPAIGN).alias("campaign_id"),
        F.lit(HISTORICAL_CAMPAIGN).alias("variant"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("push")).otherwise(F.lit("email")).alias("channel"),
        (F.col("l_shipdate") + hours(HISTORICAL_SENT_HOURS)).alias("sent_at"),
        null_ts.alias("opened_at"),
        null_ts.alias("clicked_at"),
        null_ts.alias("unsubscribed_at"),
    )


def exclusions_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")).select(
        F.col("o_custkey").cast("string").alias("member_id"),
        F.lit(EXCLUSION_REASON).alias("exclusion_reason"),
        F.col("o_orderdate").alias("start_at"),
        (F.col("o_orderdate") + days(EXCLUSION_DAYS)).alias("end_at"),
    )


def target_touches(assignments: DataFrame, audience: DataFrame, spec: CampaignSpec) -> DataFrame:
    """One touch per treatment assignment, sent 30 minutes after the instant."""
    h = F.md5(F.col("member_id"))
    sent = ts(spec.campaign_at) + minutes(TARGET_SENT_MINUTES)
    treated = assignments.filter(F.col("variant").isin(*spec.treatments))
    return treated.join(audience.select("member_id", "activation_channel"), "member_id").select(
        F.md5(F.concat_ws("|", F.lit(spec.campaign_id), F.col("member_id"))).alias("touch_id"),
        "member_id",
        F.lit(spec.campaign_id).alias("campaign_id"),
        "variant",
        F.col("activation_channel").alias("channel"),
        sent.alias("sent_at"),
        F.when(F.substring(h, 1, 2) < OPEN_BELOW, sent + hours(1)).alias("opened_at"),
        F.when(F.substring(h, 3, 2) < CLICK_BELOW, sent + hours(2)).alias("clicked_at"),
        F.when(F.substring(h, 5, 2) < UNSUBSCRIBE_BELOW, sent + hours(3)).alias("unsubscribed_at"),
    )


class TestWarehouse(CampaignRun):
    """Raw entities mapped from one supplied scale factor, plus every mart.

    Assignments and the target campaign's touches are derived (X-14 over the
    eligible audience); features read pre-campaign touches only, which is
    exact because target touches are sent after the instant.
    """

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, sf_dir: str, spec: CampaignSpec | None = None, materialize: bool = False):
        super().__init__(spark, spec or testdata_spec(), raw=None, materialize=materialize)
        self.sf_dir = sf_dir

    # Event-, order- and line-sized entities stay lazy views over the supplied
    # files: re-deriving them is cheaper than writing a staged copy (measured
    # at sf0.1). Members are written once (see below).
    @cached_property
    def events(self) -> DataFrame:
        return events_entity(self.spark, self.sf_dir)

    @cached_property
    def consent_history(self) -> DataFrame:
        return consent_entity(self.spark, self.sf_dir)

    @cached_property
    def members(self) -> DataFrame:
        # member-sized and read by every later step (features, rules, tests):
        # derived once from customers + as-of consent and written
        return self._mart(members_entity(self.spark, self.sf_dir, self.consent_history, self.spec), "raw_members")

    @cached_property
    def listings(self) -> DataFrame:
        return listings_entity(self.spark, self.sf_dir)

    @cached_property
    def historical_touches(self) -> DataFrame:
        return historical_touches_entity(self.spark, self.sf_dir)

    @cached_property
    def campaign_exclusions(self) -> DataFrame:
        return exclusions_entity(self.spark, self.sf_dir)

    @cached_property
    def experiment_assignments(self) -> DataFrame:
        from ..operators.assignment import assign_arms

        return self._mart(assign_arms(self.eligible_audience, self.spec), "experiment_assignments")

    @cached_property
    def campaign_touches(self) -> DataFrame:
        target = self._mart(target_touches(self.experiment_assignments, self.eligible_audience, self.spec),
                            "raw_target_touches")
        return self.historical_touches.unionByName(target)

    # What the features and outcomes read, bounded on the supplied columns.
    @property
    def feature_touches(self) -> DataFrame:
        return historical_touches_entity(self.spark, self.sf_dir, self.spec.contact_start, self.spec.campaign_at)

    @property
    def feature_events(self) -> DataFrame:
        return events_entity(self.spark, self.sf_dir, until=self.spec.campaign_at)

    @property
    def feature_listings(self) -> DataFrame:
        return listings_entity(self.spark, self.sf_dir, until=self.spec.campaign_at)

    @property
    def outcome_listings(self) -> DataFrame:
        after = self.spec.outcome_end + timedelta(microseconds=1)  # the window's end is inside
        return listings_entity(self.spark, self.sf_dir, self.spec.campaign_at, after)
