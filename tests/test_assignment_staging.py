"""X-14 exact distributed rank; CSV staging (S-8, S-9, S-10, P-1..P-7)."""

from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapsewise.operators.assignment import assign_arms, exact_rank, salted_hash
from lapsewise.sources.readers import read_raw_csv, required_null_counts
from lapsewise.spec import CampaignSpec


def test_exact_rank_equals_global_row_number(spark):
    ids = spark.range(20000).select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("member_id"))
    h = ids.select("member_id", salted_hash(F.col("member_id"), "s1").alias("_h"))
    ours = exact_rank(h, "_h", "member_id", digits=2)
    oracle = h.select("member_id", F.row_number().over(Window.orderBy("_h", "member_id")).alias("rank"))
    diff = ours.join(oracle, "member_id").filter(ours["rank"] != oracle["rank"]).count()
    assert diff == 0 and ours.count() == 20000


@pytest.mark.parametrize("n,arms", [(10, ("control", "generic", "personalized")), (7, ("a", "b")),
                                    (11, ("c", "t1", "t2", "t3"))])
def test_arms_balanced_within_one(spark, n, arms):
    spec = CampaignSpec(arms=arms, control_arm=arms[0])
    aud = spark.createDataFrame([(f"x{i}",) for i in range(n)], "member_id string")
    sizes = [r["count"] for r in assign_arms(aud, spec).groupBy("variant").count().collect()]
    assert len(sizes) == len(arms) and max(sizes) - min(sizes) <= 1 and sum(sizes) == n


def test_assignment_is_deterministic(spark, spec):
    aud = spark.createDataFrame([(f"x{i}",) for i in range(50)], "member_id string")
    a = sorted(tuple(r) for r in assign_arms(aud, spec).collect())
    b = sorted(tuple(r) for r in assign_arms(aud.repartition(7), spec).collect())
    assert a == b


def test_csv_staging_by_header_with_rejects(spark, tmp_path):
    p = tmp_path / "listings.csv"
    p.write_text(
        "extra,sale_value,member_id,listing_id,created_at,category,sold_at\n"
        "x,10.50,m1,l1,2026-07-01 10:00:00,Fashion,2026-07-02 10:00:00\n"
        "x,0,m2,l2,2026-07-01 10:00:00,Fashion,not-a-time\n"
        "x,0,,l3,2026-07-01 10:00:00,Fashion,\n"
        "x,0,m4,l4,garbage,Fashion,\n",
        encoding="utf-8",
    )
    st = read_raw_csv(spark, str(p), "listings")
    valid = {r.listing_id: r for r in st.valid.collect()}
    assert set(valid) == {"l1", "l2"}
    assert valid["l1"].sold_at == datetime(2026, 7, 2, 10) and str(valid["l1"].sale_value) == "10.50"
    assert valid["l2"].sold_at is None  # tolerant column: bad text -> NULL
    rej = {r.listing_id: r.reject_reason for r in st.rejects.collect()}
    assert rej == {"l3": "member_id:missing", "l4": "created_at:unparseable"}
    nulls = {r.column_name: r.null_rows for r in required_null_counts(st.valid, "listings").collect()}
    assert all(v == 0 for v in nulls.values())


def test_csv_members_booleans_and_missing_file(spark, tmp_path):
    p = tmp_path / "members.csv"
    p.write_text("member_id,joined_at,region,preferred_channel,email_consent,push_consent,is_suppressed\n"
                 "m1,2024-01-01 00:00:00,Otago,email,1,0,0\n", encoding="utf-8")
    r = read_raw_csv(spark, str(p), "members").valid.first()
    assert r.email_consent is True and r.push_consent is False and r.is_suppressed is False
    with pytest.raises(AnalysisException):
        read_raw_csv(spark, str(tmp_path / "nope.csv"), "members").valid.count()


def test_csv_files_of_one_source_have_headers_of_their_own(spark, tmp_path):
    folder = tmp_path / "exclusions"
    folder.mkdir()
    times = "2026-07-01 00:00:00,2026-07-02 00:00:00"
    (folder / "a.csv").write_text(f"member_id,exclusion_reason,start_at,end_at\nm1,r1,{times}\n", encoding="utf-8")
    # columns in another order, a byte order mark, extra columns that differ by case only
    (folder / "b.csv").write_bytes(("﻿end_at,exclusion_reason,Note,note,start_at,member_id\n"
                                    "2026-07-02 00:00:00,r2,x,y,2026-07-01 00:00:00,m2\n").encode())
    # too many fields, too few, quotes within, and an empty required value
    (folder / "c.csv").write_text(f'member_id,exclusion_reason,start_at,end_at\nm3,r3,{times},extra\nm4,r4\n"m,5","say ""r5""",{times}\n,r6,{times}\n',
                                  encoding="utf-8")
    (folder / "empty.csv").write_text("")
    st = read_raw_csv(spark, str(folder), "campaign_exclusions")
    span = (datetime(2026, 7, 1), datetime(2026, 7, 2))
    assert sorted(map(tuple, st.valid.select("member_id", "exclusion_reason", "start_at", "end_at").collect())) == [
        ("m,5", 'say "r5"', *span), ("m1", "r1", *span), ("m2", "r2", *span)]
    rejects = {(r.reject_reason, r.member_id, r.raw_record) for r in st.rejects.collect()}
    assert rejects == {("record:malformed", None, f"m3,r3,{times},extra"), ("record:malformed", None, "m4,r4"), ("member_id:missing", None, None)}


def test_csv_headers_that_lack_or_repeat_a_column(spark, tmp_path):
    for name, header in (("lack", "member_id,exclusion_reason,start_at"), ("repeat", "member_id,exclusion_reason,start_at,end_at,end_at")):
        (tmp_path / f"{name}.csv").write_text(header + "\n")
        with pytest.raises(ValueError, match="end_at"):
            read_raw_csv(spark, str(tmp_path / f"{name}.csv"), "campaign_exclusions")
    (tmp_path / "nothing.csv").write_text("")
    st = read_raw_csv(spark, str(tmp_path / "nothing.csv"), "campaign_exclusions")
    assert st.valid.count() == 0 and st.rejects.count() == 0


def test_marts_are_bucketed_by_their_rows(spark):
    from lapsewise.session import cluster_conf
    from lapsewise.sources.marts import MAX_BUCKETS, MartStore, bucket_count

    assert bucket_count(10, 8, 200) == 8 and bucket_count(10_000_000, 8, 200) == 40
    assert bucket_count(10**9, 8000, 372_530) == 8000 and bucket_count(10**12, 8000, 372_530) == MAX_BUCKETS < 100_000
    before = spark.conf.get("spark.sql.shuffle.partitions")
    partitions = cluster_conf(100 * 10**12, 8000)["spark.sql.shuffle.partitions"]
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        store = MartStore(spark)
        rows = spark.range(1000).selectExpr("cast(id as string) member_id")
        written = store.write(rows, "members", bucket_by="member_id")
        assert int(partitions) > 100_000 and store.buckets == spark.sparkContext.defaultParallelism
        assert written.count() == 1000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
