"""Documented operating policies N-1, N-6, N-7 (N-2..N-5 are registered queries)."""

from datetime import datetime

from pyspark.sql import functions as F

from lapsewise.operators import monitoring as N

T = datetime(2026, 8, 1, 9, 0, 0)


def test_audience_size_alert(spark):
    aud = spark.range(100).withColumnRenamed("id", "member_id")
    r = N.audience_size_alert(aud, 80).first()
    assert r.audience_size == 100 and abs(r.deviation - 0.25) < 1e-12 and r.alert
    assert not N.audience_size_alert(aud, 90).first().alert


def test_incremental_write_keeps_untouched_dates(spark, tmp_path):
    path = str(tmp_path / "events")
    day1 = spark.createDataFrame([("e1", datetime(2026, 7, 1, 10)), ("e2", datetime(2026, 7, 2, 11))],
                                 "event_id string, event_ts timestamp_ntz")
    N.write_incremental(day1, path, "event_ts")
    late = spark.createDataFrame([("e3", datetime(2026, 7, 2, 12))], "event_id string, event_ts timestamp_ntz")
    N.write_incremental(late, path, "event_ts")
    ids = sorted(r.event_id for r in spark.read.parquet(path).collect())
    assert ids == ["e1", "e3"]  # 07-01 kept, 07-02 replaced by the new batch


def test_refresh_removes_a_date_whose_events_are_all_withdrawn(spark, tmp_path):
    from lapsewise.operators.rollup import refresh_rollup

    path = str(tmp_path / "rollup")
    rows = [(f"e{d}", "m1", "item_viewed", "c", datetime(2026, 7, d, 10)) for d in (1, 2)]
    events = spark.createDataFrame(rows, "event_id string, member_id string, event_name string, category string, event_ts timestamp_ntz")
    refresh_rollup(events, path)
    assert spark.read.parquet(path).count() == 2
    refresh_rollup(events.filter("event_id <> 'e2'"), path, dates=["2026-07-02"])
    assert [str(r.event_date) for r in spark.read.parquet(path).collect()] == ["2026-07-01"]


def test_send_time_recheck_blocks_changed_members(spark, spec):
    recs = spark.createDataFrame(
        [("m1", spec.campaign_id, "generic", "email"), ("m2", spec.campaign_id, "generic", "email"),
         ("m3", spec.campaign_id, "personalized", "push")],
        "member_id string, campaign_id string, variant string, activation_channel string")
    at_send = spark.createDataFrame(
        [("m1", False, True, True, True, False), ("m2", False, False, True, True, False),
         ("m3", False, True, True, True, False)],
        "member_id string, is_suppressed boolean, within_contact_cap boolean, has_no_campaign_conflict boolean, "
        "email_consent boolean, push_consent boolean")
    r = {x.member_id: x for x in N.send_time_recheck(recs, at_send, spec).collect()}
    assert r["m1"].entry_allowed
    assert r["m2"].blocked_reason == "contact_cap_reached"
    assert r["m3"].blocked_reason == "channel_consent_missing"
