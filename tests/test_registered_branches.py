"""The registered data reaches the failing branches too."""

from lapsewise.plans import queries as Q

SF = "/root/testdata/sf0.01"


def test_every_rule_finds_something_in_the_broken_tables(spark):
    rows = Q.queries()["quality_results_dirty"](spark, SF).collect()
    assert len(rows) == 26 and [r.name for r in rows if r.status != "FAIL" or not r.actual] == []


def test_repeated_keys_reach_every_action(spark):
    rows = Q.queries()["sync_repeated_keys"](spark, SF).groupBy("action").count().collect()
    assert {r.action for r in rows} == {"created", "updated", "unchanged", "suppressed", "rejected"}


def test_rejected_row_and_wrong_arm_stop_a_run(spark, tmp_path):
    from pyspark.sql import functions as F

    from lapsewise.plans.pipeline import CampaignRun, run_pipeline
    from lapsewise.sources.readers import stage
    from lapsewise.sources.testdata import TestWarehouse

    src = TestWarehouse(spark, "/root/testdata/sf0.001", materialize=True)
    raw = src.raw()
    staged = stage(raw["members"].withColumn("member_id", F.when(F.col("member_id") != "7", F.col("member_id")).otherwise("")), "members")
    run = CampaignRun(spark, src.spec, raw | {"members": staged.valid}, materialize=True, rejects={"members": staged.rejects})
    out = run_pipeline(run, str(tmp_path / "rejects"))
    assert not out.quality_passed and out.stopped_by == "rejected_rows" and set(out.outputs) == {"rejected_rows"}

    results = src.experiment_results
    run = CampaignRun(spark, src.spec, raw, materialize=True)
    run.__dict__["quality_results"] = src.quality_results
    run.__dict__["experiment_results"] = results.unionByName(results.filter("variant = 'control'").withColumn("variant", F.lit("extra")))
    out = run_pipeline(run, str(tmp_path / "arms"))
    assert out.stopped_by == "arm_set" and "decision" not in out.outputs and "arm_set_check" in out.outputs


def test_display_of_percentages(spark):
    from pyspark.sql import functions as F

    from lapsewise.operators.reports import display_pct

    rows = spark.createDataFrame([(12.345678,), (0.0,), (-3.2,)], "x double").select(display_pct(F.col("x")).alias("d")).collect()
    assert [r.d for r in rows] == ["12.35%", "0.00%", "-3.20%"]
