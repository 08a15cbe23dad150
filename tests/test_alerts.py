"""Monitoring signals as streams equal their batch forms, late rows included."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from lapsewise.operators.monitoring import conversion_freshness, cumulative_unsubscribe
from lapsewise.streaming.alerts import HourStore, freshness_alert, start_freshness_stream, start_unsubscribe_stream, unsubscribe_alerts

T0 = datetime(2026, 8, 1, 9)
TOUCHES = "touch_id string, campaign_id string, sent_at timestamp_ntz, unsubscribed_at timestamp_ntz"


def touches(spark, spec, hours, n=20):
    rows = [(f"t{h}-{k}", spec.campaign_id if k % 5 else "other", T0 + timedelta(hours=h, minutes=k), T0 + timedelta(hours=h + k, minutes=59) if k % 3 == 0 else None)
            for h in hours for k in range(n)]
    return spark.createDataFrame(rows, TOUCHES)


def test_late_touches_update_their_hours(spark, spec, tmp_path):
    parts = [touches(spark, spec, range(0, 30, 2)), touches(spark, spec, [1, 3, 40]), touches(spark, spec, [5])]
    root, folder = str(tmp_path / "hours"), tmp_path / "in"
    for k, part in enumerate(parts):
        part.write.parquet(str(folder / str(k)))
        source = spark.readStream.schema(part.schema).parquet(str(folder / "*"))
        start_unsubscribe_stream(source, root, str(tmp_path / "checkpoint"), spec, "100 hours").awaitTermination()
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    want = sorted(map(tuple, cumulative_unsubscribe(whole, spec).collect()))
    assert sorted(map(tuple, unsubscribe_alerts(spark, root).collect())) == want and len(want) > 30
    # a late batch commits the hours it changed, not all of them
    assert [p.rows for p in HourStore(spark, root).latest().parts][-1] < len(want) / 2


def test_rows_behind_the_watermark_are_not_counted(spark, spec, tmp_path):
    root, folder = str(tmp_path / "hours"), tmp_path / "in"
    for k, hours in enumerate(([0, 100], [200], [1])):
        part = touches(spark, spec, hours)
        part.write.parquet(str(folder / str(k)))
        source = spark.readStream.schema(part.schema).parquet(str(folder / "*"))
        start_unsubscribe_stream(source, root, str(tmp_path / "checkpoint"), spec, "10 hours").awaitTermination()
    hours = {r.bucket for r in HourStore(spark, root).read().collect()}
    assert T0 + timedelta(hours=200) in hours and not HourStore(spark, root).read().filter(F.col("bucket") == F.lit(T0 + timedelta(hours=1)).cast("timestamp_ntz")).filter("sent > 0").count()


def test_freshness_of_a_feed(spark, tmp_path):
    root, folder = str(tmp_path / "feeds"), tmp_path / "in"
    assert freshness_alert(spark, root, "listings", T0).first().breach  # nothing arrived
    for k, hours in enumerate(([5, 1], [2], [9])):
        part = spark.createDataFrame([(T0 + timedelta(hours=h),) for h in hours], "created_at timestamp_ntz")
        part.write.parquet(str(folder / str(k)))
        source = spark.readStream.schema(part.schema).parquet(str(folder / "*"))
        start_freshness_stream(source, "created_at", "listings", root, str(tmp_path / "ck"), T0 + timedelta(hours=8)).awaitTermination()
    as_of = T0 + timedelta(hours=8)
    rows = spark.read.parquet(str(folder / "*"))
    want = conversion_freshness(rows, "created_at", as_of).first()
    assert freshness_alert(spark, root, "listings", as_of).first() == want and want.breach
