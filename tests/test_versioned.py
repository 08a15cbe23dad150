"""The versioned destination: atomic commits, merge on read, compaction."""

import pytest
from pyspark.sql import functions as F

from lapsewise.operators.activation import empty_destination, sync
from lapsewise.sources.versioned import CommitConflict, MembershipStore
from lapsewise.streaming import sync_stream as S

from test_activation import REC_SCHEMA, rec


def batch(spark, members, **fields):
    return spark.createDataFrame([rec(member=f"s{i}", seq=k, **fields) for k, i in enumerate(members)], REC_SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()))


def deliver(spark, root, spec, batches, **options):
    for epoch, members, fields in batches:
        S.sync_batch(spark, batch(spark, members, **fields), "one", epoch, root, spec, **options)


BATCHES = [(0, range(40), {}), (1, range(20, 60), {"channel": "push"}), (2, range(60), {}), (3, range(5), {"channel": "push"})]


def test_parts_merged_on_read_equal_the_whole_rewrite(spark, spec, tmp_path):
    for fan_in in (2, 100):
        root = str(tmp_path / f"dest{fan_in}")
        deliver(spark, root, spec, BATCHES, fan_in=fan_in)
        whole = empty_destination(spark)
        for _, members, fields in BATCHES:
            whole = sync(batch(spark, members, **fields), whole, spec, "r").destination.checkpoint()
        store = MembershipStore(spark, root)
        assert rows(store.snapshot()) == rows(whole.select(*store.snapshot().columns))
        levels = [p.level for p in store.latest().parts]
        assert levels == sorted(levels, reverse=True) and len(levels) == (4 if fan_in == 100 else 1)


def test_a_batch_writes_its_changes_only(spark, spec, tmp_path):
    root = str(tmp_path / "dest")
    deliver(spark, root, spec, [(0, range(500), {}), (1, range(500), {}), (2, range(3), {"channel": "push"})])
    commits = MembershipStore(spark, root).commits()
    assert [[p.rows for p in c.parts] for c in commits] == [[500], [500], [500, 3]]  # a replay adds no part


def test_a_job_that_dies_inside_the_commit_leaves_the_last_version(spark, spec, tmp_path, monkeypatch):
    root, clean = str(tmp_path / "dest"), str(tmp_path / "clean")
    deliver(spark, clean, spec, BATCHES)
    deliver(spark, root, spec, BATCHES[:2])
    before, version = rows(S.current_state(spark, root)), MembershipStore(spark, root).latest().version

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    # After the log, after the rows, and at the last rename: readers still see version 2.
    for step in ("_write_part", "_publish"):
        monkeypatch.setattr(MembershipStore, step, die)
        with pytest.raises(RuntimeError, match="lost"):
            deliver(spark, root, spec, BATCHES[2:3])
        monkeypatch.undo()
        assert rows(S.current_state(spark, root)) == before and MembershipStore(spark, root).latest().version == version
        assert S.read_log(spark, root).count() == 80
    # A part that was written halfway is in nobody's way either.
    (tmp_path / "dest" / "parts" / "part=0000000003-half" / "campaign_id=c").mkdir(parents=True)
    (tmp_path / "dest" / "parts" / "part=0000000003-half" / "campaign_id=c" / "x.parquet").write_bytes(b"PAR1 torn")
    for _ in range(2):  # delivered again, and once more
        deliver(spark, root, spec, BATCHES[2:])
    assert rows(S.current_state(spark, root)) == rows(S.current_state(spark, clean))
    log = ["batch_id", "seq", "member_id", "action"]
    assert rows(S.read_log(spark, root).select(*log)) == rows(S.read_log(spark, clean).select(*log))
    assert S.sync_batch(spark, batch(spark, range(60)), "one", 3, root, spec).first().attempted == 5


def test_a_death_while_parts_merge_changes_nothing(spark, spec, tmp_path, monkeypatch):
    root = str(tmp_path / "dest")
    deliver(spark, root, spec, BATCHES[:4], fan_in=100)
    store = MembershipStore(spark, root, fan_in=2)
    before = rows(store.snapshot())
    monkeypatch.setattr(MembershipStore, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.compact()
    monkeypatch.undo()
    assert rows(store.snapshot()) == before
    old = store.latest()
    merged = store.compact()
    assert len(merged.parts) < len(old.parts) and rows(store.snapshot()) == before
    assert rows(store.snapshot(at=old)) == before  # an older version stays readable
    assert store.vacuum(keep=1) and rows(store.snapshot()) == before


def test_two_writers_cannot_publish_one_version(spark, spec, tmp_path):
    root = str(tmp_path / "dest")
    deliver(spark, root, spec, BATCHES[:1])
    one, two = MembershipStore(spark, root), MembershipStore(spark, root)
    last = two.latest()
    two.latest = lambda: last  # has not seen what the other writes
    changes = one.read().drop("version").limit(1)
    one.commit(changes, "a", 0)
    with pytest.raises(CommitConflict):
        two.commit(changes, "b", 0)
    assert one.latest().applied == {"one": 0, "a": 0}


def test_only_the_batchs_campaigns_and_buckets_are_read(spark, spec, tmp_path):
    root = str(tmp_path / "dest")
    both = batch(spark, range(20)).unionByName(batch(spark, range(20)).withColumn("campaign_id", F.lit("other campaign/ü")))
    S.sync_batch(spark, both, "one", 0, root, spec)
    assert S.current_state(spark, root).count() == 40
    one = S.current_state(spark, root, ["other campaign/ü"], [1, 2, 3])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "campaign_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "bucket" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert S.current_state(spark, root, ["other campaign/ü"]).count() == 20


def test_empty_store_and_batch(spark, spec, tmp_path):
    root = str(tmp_path / "dest")
    assert S.current_state(spark, root).count() == 0 and S.read_log(spark, root).count() == 0
    S.sync_batch(spark, batch(spark, []), "one", 0, root, spec)
    assert S.current_state(spark, root).count() == 0 and not MembershipStore(spark, root).latest().parts
    assert len(MembershipStore(spark, root).vacuum()) == 1  # the empty part, which no commit names
