"""Activation sync: validation order, sequential upsert semantics, replay,
and the micro-batch stream."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lapsewise.operators import activation as A
from lapsewise.schemas import DESTINATION_FIELDS

REC_SCHEMA = (
    "member_id string, campaign_id string, variant string, activation_channel string, "
    "preferred_category string, historical_listing_count long, marketing_contacts_7d long, "
    "audience_created_at timestamp_ntz, is_suppressed boolean, within_contact_cap boolean, "
    "has_no_campaign_conflict boolean, has_channel_consent boolean, seq long"
)
T0 = datetime(2026, 8, 1, 9, 0, 0)


def rec(member="m1", campaign="c1", variant="generic", channel="email", category="Fashion", listings=2,
        contacts=0, suppressed=False, cap=True, no_conflict=True, consent=True, seq=0):
    return (member, campaign, variant, channel, category, listings, contacts, T0, suppressed, cap,
            no_conflict, consent, seq)


def test_validation_order_first_failure_wins(spark, spec):
    rows = [
        rec(member="", seq=1),                       # missing required (empty)
        rec(member="a", campaign=None, seq=2),       # missing required (NULL)
        rec(member="b", variant="control", seq=3),
        rec(member="c", variant="holdout", seq=4),
        rec(member="d", channel="sms", seq=5),
        rec(member="e", suppressed=True, consent=False, seq=6),  # suppression before consent
        rec(member="f", consent=False, cap=False, seq=7),
        rec(member="g", cap=False, no_conflict=False, seq=8),
        rec(member="h", no_conflict=False, seq=9),
        rec(member="i", suppressed=None, seq=10),    # falsy suppression -> ok
        rec(member="j", variant="control", channel="sms", suppressed=True, seq=11),
    ]
    df = spark.createDataFrame(rows, REC_SCHEMA)
    c = {r.seq: r for r in A.classify(df, A.empty_destination(spark), spec).collect()}
    assert (c[1].action, c[1].reason) == ("rejected", "missing_required_field")
    assert c[1].idempotency_key is None  # no member -> no key logged
    assert c[2].reason == "missing_required_field" and c[2].idempotency_key is not None
    assert c[3].reason == "control_not_activatable"
    assert c[4].reason == "unknown_variant"
    assert c[5].reason == "unsupported_channel"
    assert (c[6].action, c[6].reason) == ("suppressed", "member_suppressed")
    assert c[7].reason == "channel_consent_missing"
    assert c[8].reason == "contact_cap_reached"
    assert c[9].reason == "campaign_conflict"
    assert c[10].action == "created"
    assert c[11].reason == "control_not_activatable"


def test_key_and_hash_match_reference_encoding(spark, spec):
    import hashlib
    import json

    df = spark.createDataFrame([rec(member="42", category=None)], REC_SCHEMA)
    r = df.select(A.idempotency_key().alias("k"), A.payload_hash().alias("h")).first()
    assert r.k == hashlib.sha256(b"c1|42|generic").hexdigest()[:24]
    payload = {"member_id": "42", "campaign_id": "c1", "variant": "generic", "activation_channel": "email",
               "preferred_category": None, "historical_listing_count": 2, "marketing_contacts_7d": 0,
               "audience_created_at": "2026-08-01 09:00:00"}
    assert set(payload) == set(DESTINATION_FIELDS)
    expected = hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert r.h == expected


def _python_sync(records, destination):
    """Row-by-row model of the reference's upsert loop (validation assumed passed)."""
    dest = dict(destination)
    out = []
    for key, h in records:
        old = dest.get(key)
        if old is None:
            out.append("created")
        elif old == h:
            out.append("unchanged")
        else:
            out.append("updated")
        dest[key] = h
    return out, dest


def test_set_based_sync_equals_sequential_loop(spark, spec):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        m = f"m{rnd.randrange(60)}"
        rows.append(rec(member=m, channel=rnd.choice(["email", "push"]), category=rnd.choice(["A", "B", None]),
                        suppressed=rnd.random() < 0.1, seq=i))
    df = spark.createDataFrame(rows, REC_SCHEMA)
    # a pre-existing destination for some keys
    first = A.sync(df.filter("seq < 100"), A.empty_destination(spark), spec, "r0")
    dest0 = first.destination.checkpoint()
    res = A.sync(df.filter("seq >= 100"), dest0, spec, "r1")
    got = {r.seq: r.action for r in res.log.collect()}
    keyed = df.filter("seq >= 100").select("seq", A.idempotency_key().alias("k"), A.payload_hash().alias("h"),
                                           "is_suppressed").orderBy("seq").collect()
    valid = [(r.k, r.h) for r in keyed if not r.is_suppressed]
    d0 = {r.idempotency_key: r.payload_hash for r in dest0.collect()}
    expected, final = _python_sync(valid, d0)
    got_valid = [got[r.seq] for r in keyed if not r.is_suppressed]
    assert got_valid == expected
    assert all(got[r.seq] == "suppressed" for r in keyed if r.is_suppressed)
    snap = {r.idempotency_key: r.payload_hash for r in res.destination.collect()}
    assert snap == final
    # unchanged-only keys keep last_synced_at from the previous run; snapshot keys unique
    assert res.destination.groupBy("idempotency_key").count().filter("count > 1").count() == 0


def test_replay_is_all_unchanged_and_updates_keep_first_synced(spark, spec):
    df = spark.createDataFrame([rec(member=f"m{i}", seq=i) for i in range(20)], REC_SCHEMA)
    first = A.sync(df, A.empty_destination(spark), spec, "initial", synced_at=T0)
    d1 = first.destination.checkpoint()  # each run's snapshot is materialised, as in a pipeline
    s1 = first.summary.first()
    assert (s1.attempted, s1.created, s1.unchanged) == (20, 20, 0)
    replay = A.sync(df, d1, spec, "replay", synced_at=datetime(2026, 8, 2))
    d2 = replay.destination.checkpoint()
    s2 = replay.summary.first()
    assert (s2.created, s2.unchanged, s2.updated) == (0, 20, 0)
    snap = {r.member_id: r for r in d2.collect()}
    assert snap["m1"].last_synced_at == T0  # unchanged writes nothing
    changed = df.withColumn("activation_channel", F.when(F.col("member_id") == "m1", "push").otherwise(F.col("activation_channel")))
    upd = A.sync(changed, d2, spec, "change", synced_at=datetime(2026, 8, 3))
    assert upd.summary.first().updated == 1
    d3 = upd.destination.checkpoint()
    row = {r.member_id: r for r in d3.collect()}["m1"]
    assert row.activation_channel == "push" and row.first_synced_at == T0
    assert row.last_synced_at == datetime(2026, 8, 3)
    # a changed variant is a different key: a second membership, the old one kept
    other = df.filter("member_id = 'm2'").withColumn("variant", F.lit("personalized"))
    s = A.sync(other, d3, spec, "variant")
    assert s.summary.first().created == 1 and s.destination.count() == 21


def test_duplicate_in_batch_equal_then_different_payload(spark, spec):
    rows = [rec(member="x", seq=0), rec(member="x", seq=1), rec(member="x", channel="push", seq=2)]
    res = A.sync(spark.createDataFrame(rows, REC_SCHEMA), A.empty_destination(spark), spec, "dup")
    acts = [r.action for r in res.log.orderBy("seq").collect()]
    assert acts == ["created", "unchanged", "updated"]
    assert res.destination.first().activation_channel == "push"


def stream(spark, src, root, checkpoint, spec, schema):
    from lapsewise.streaming.sync_stream import start_sync_stream

    start_sync_stream(spark.readStream.schema(schema).parquet(str(src / "*")), root, str(checkpoint), spec).awaitTermination(120)


def test_stream_sync_is_idempotent_under_redelivery(spark, spec, tmp_path):
    from lapsewise.streaming.sync_stream import current_state, read_log

    src, root = tmp_path / "in", str(tmp_path / "dest")
    batch = spark.createDataFrame([rec(member=f"s{i}", seq=i) for i in range(10)], REC_SCHEMA)
    batch.write.parquet(str(src / "b1"))
    stream(spark, src, root, tmp_path / "ck", spec, batch.schema)
    # redeliver the same records as a new file -> next micro-batch
    batch.write.parquet(str(src / "b2"))
    stream(spark, src, root, tmp_path / "ck", spec, batch.schema)
    per_batch = {r.batch_id: (r.created, r.unchanged) for r in read_log(spark, root).groupBy("batch_id").agg(
        F.count_if(F.col("action") == "created").alias("created"),
        F.count_if(F.col("action") == "unchanged").alias("unchanged")).collect()}
    assert sorted(per_batch.values()) == [(0, 10), (10, 0)]
    assert current_state(spark, root).count() == 10
    # a fresh checkpoint starts again at batch 0: nothing is lost or made twice
    stream(spark, src, root, tmp_path / "ck2", spec, batch.schema)
    assert current_state(spark, root).count() == 10
    again = read_log(spark, root)
    assert again.select("stream").distinct().count() == 2 and again.count() == 40
    assert again.filter("action = 'created'").count() == 10


def test_sync_joins_stay_on_the_executors(spark, spec, tmp_path):
    """Sides with a row per membership are not sent through the driver, small or not."""
    def written(df, name):  # files: their small sizes are known
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    batch = written(spark.createDataFrame([rec(member=f"m{k % 5}", category=f"c{k}", seq=k) for k in range(20)], REC_SCHEMA), "batch")
    stored = written(A.sync(batch, A.empty_destination(spark), spec, "first").destination, "stored")
    result = A.sync(batch, stored, spec, "second")
    for df in (result.log, result.destination, A.snapshot_changes(A.classify(batch, stored, spec), stored, spec.campaign_at)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert result.destination.count() == 5 and result.log.count() == 20


def test_previous_in_key_of_a_million_rows_equals_plain_lag(spark):
    """All columns are read, one key holds a third of the rows."""
    from pyspark.sql import Window

    from lapsewise.operators.activation import previous_in_key

    df = spark.range(1_200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.xxhash64("id") % 5000).cast("string")).alias("k"),
        (F.col("id") * 7 % 1_200_000).alias("seq"), F.md5(F.col("id").cast("string")).alias("v"), F.col("id").alias("extra"))
    df = df.repartition(13)
    got = previous_in_key(df, "k", "seq", "v", "v", "prev")
    plain = df.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("seq", "v")))
    assert got.columns == plain.columns
    assert got.exceptAll(plain).isEmpty() and got.count() == 1_200_000
