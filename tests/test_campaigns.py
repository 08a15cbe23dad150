"""Many campaigns in one pass equal one pass each."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lapsewise.operators.campaigns import campaign_features
from lapsewise.operators.features import member_360

AT = datetime(2026, 8, 1, 9)
COLUMNS = ["historical_listing_count", "last_listing_at", "historical_sales_count", "historical_gmv", "last_activity_at", "recent_event_count",
           "recent_watchlist_count", "recent_purchase_count", "marketing_contacts_7d", "has_active_campaign_exclusion", "preferred_category"]


@pytest.fixture(scope="module")
def tables(spark):
    """Times that fall on, just before and just after instants and window bounds."""
    n, step = F.col("id"), timedelta(days=5)
    at = F.lit(AT.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    member = F.concat(F.lit("m"), (n % 7).cast("string"))
    nudge = F.element_at(F.array(F.expr("INTERVAL '0' SECOND"), F.expr("INTERVAL '0.000001' SECOND"), F.expr("INTERVAL '-0.000001' SECOND"), F.expr("INTERVAL '7' HOUR")), (n % 4 + 1).cast("int"))
    when = at - F.make_dt_interval(days=((n * 13) % 130 - 3).cast("int")) + nudge
    ids = spark.range(900)
    members = spark.range(8).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("member_id"), at.alias("joined_at"), F.lit("EU").alias("region"),
                                    F.lit("email").alias("preferred_channel"), *[F.lit(True).alias(c) for c in ("email_consent", "push_consent", "is_suppressed")])
    events = ids.select(F.concat(F.lit("E"), n.cast("string")).alias("event_id"), F.when(n % 50 != 0, member).alias("member_id"),
                        F.element_at(F.array(F.lit("watchlist_added"), F.lit("purchase_completed"), F.lit("search")), (n % 3 + 1).cast("int")).alias("event_name"),
                        F.when(n % 61 != 0, when).alias("event_ts"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(""), F.lit(None)), (n % 4 + 1).cast("int")).alias("category"))
    listings = ids.filter("id % 3 = 0").select(member.alias("member_id"), when.alias("created_at"), F.when(n % 2 == 0, when).alias("sold_at"),
                                               F.when(n % 5 != 0, (n / 7).cast("decimal(18,2)")).alias("sale_value"))
    touches = ids.filter("id % 2 = 0").select(member.alias("member_id"), when.alias("sent_at"))
    exclusions = ids.filter("id % 40 = 1").select(member.alias("member_id"), F.when(n % 9 != 0, when).alias("start_at"),
                                                  (when + F.make_dt_interval(days=(n % 9 - 2).cast("int"))).alias("end_at"))
    campaigns = [(f"c{k}", AT - k * step) for k in range(12)] + [("same instant", AT), ("long ago", AT - timedelta(days=4000))]
    return members, listings, events, touches, exclusions, campaigns


def test_every_campaign_equals_its_own_member_360(spark, spec, tables):
    *sources, campaigns = tables
    frame = spark.createDataFrame(campaigns, "campaign_id string, campaign_at timestamp_ntz")
    got = {(r.campaign_id, r.member_id): tuple(r[c] for c in COLUMNS) for r in campaign_features(*sources, frame, spec).collect()}
    assert len(got) == len(campaigns) * 8
    for campaign, at in campaigns:
        for r in member_360(*sources, spec.with_(campaign_at=at)).collect():
            assert got[campaign, r.member_id] == tuple(r[c] for c in COLUMNS), (campaign, r.member_id)


def test_sources_are_scanned_once_and_no_campaign_is_joined_to_rows(spark, spec, tables, tmp_path):
    *sources, campaigns = tables
    paths = []
    for k, df in enumerate(sources):
        df.write.parquet(str(tmp_path / str(k)))
        paths.append(spark.read.parquet(str(tmp_path / str(k))))
    frame = spark.createDataFrame(campaigns, "campaign_id string, campaign_at timestamp_ntz")
    plan = campaign_features(*paths, frame, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 5
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "LessThan(event_ts" in plan


def test_a_task_reads_a_bounded_number_of_members(spark, spec, tables, monkeypatch):
    from lapsewise.operators import campaigns as operator

    *sources, campaigns = tables
    frame = spark.createDataFrame(campaigns, "campaign_id string, campaign_at timestamp_ntz")
    one = campaign_features(*sources, frame, spec)
    rows = {tuple(r) for r in one.collect()}
    monkeypatch.setattr(operator, "READINGS_A_TASK", 10)
    many = campaign_features(*sources, frame, spec)
    assert many.rdd.getNumPartitions() == -(-8 * len(campaigns) * 3 // 10)
    assert {tuple(r) for r in many.collect()} == rows


def test_no_campaign(spark, spec, tables):
    with pytest.raises(ValueError, match="no campaign"):
        campaign_features(*tables[:-1], spark.createDataFrame([], "campaign_id string, campaign_at timestamp_ntz"), spec)
