"""The campaign run: raw entities -> marts -> quality gate -> activation and
analysis -> reports, in the reference's order (S-12, Q-35).

``CampaignRun`` builds every mart lazily from seven raw entity DataFrames;
marts that many later steps read are materialised once (``materialize=True``)
under the shared checkpoint folder. ``run_pipeline`` writes the outputs and
stops before activation and analysis when a blocking quality rule fails.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import CampaignSpec


class CampaignRun:
    def __init__(self, spark: SparkSession, spec: CampaignSpec, raw: dict[str, DataFrame] | None = None,
                 materialize: bool = False, event_rollup: DataFrame | None = None,
                 rejects: dict[str, DataFrame] | None = None):
        self.spark, self.spec, self._raw = spark, spec, raw or {}
        self.rejects = rejects or {}  # rows that staging refused; any of them stops run_pipeline
        self.materialize = materialize
        self.event_rollup = event_rollup  # hourly rollup (rollup.py); None -> read raw events
        self._store = None

    # marts keyed by member: bucketed alike so joins between them are co-located
    MEMBER_KEYED = frozenset({"raw_members", "member_360", "eligible_audience", "experiment_assignments",
                              "member_outcomes", "activation_records"})

    @property
    def store(self):
        if self._store is None:
            from ..sources.marts import MartStore

            self._store = MartStore(self.spark)
        return self._store

    def _mart(self, df: DataFrame, name: str) -> DataFrame:
        if not self.materialize:
            return df
        return self.store.write(df, name, bucket_by="member_id" if name in self.MEMBER_KEYED else None)

    def _small(self, df: DataFrame) -> DataFrame:
        """Experiment-sized tables derived from written marts: kept in memory.
        Their lineage starts at a written mart, so recomputing a lost block
        is cheap; writing them would cost more than it saves."""
        return df.persist() if self.materialize else df

    # raw entities (a subclass may derive them instead) -----------------------
    @cached_property
    def members(self) -> DataFrame:
        return self._raw["members"]

    @cached_property
    def events(self) -> DataFrame:
        return self._raw["events"]

    @cached_property
    def listings(self) -> DataFrame:
        return self._raw["listings"]

    @cached_property
    def campaign_touches(self) -> DataFrame:
        return self._raw["campaign_touches"]

    @cached_property
    def consent_history(self) -> DataFrame:
        return self._raw["consent_history"]

    @cached_property
    def campaign_exclusions(self) -> DataFrame:
        return self._raw["campaign_exclusions"]

    @cached_property
    def experiment_assignments(self) -> DataFrame:
        return self._raw["experiment_assignments"]

    @property
    def feature_touches(self) -> DataFrame:
        """Touches read by the contact-pressure feature (all campaigns)."""
        return self.campaign_touches

    # What features and outcomes read; a subclass may bound it by their windows.
    @property
    def feature_events(self) -> DataFrame:
        return self.events

    @property
    def feature_listings(self) -> DataFrame:
        return self.listings

    @property
    def outcome_listings(self) -> DataFrame:
        return self.listings

    def raw(self) -> dict[str, DataFrame]:
        return {
            "members": self.members, "events": self.events, "listings": self.listings,
            "campaign_touches": self.campaign_touches, "consent_history": self.consent_history,
            "campaign_exclusions": self.campaign_exclusions,
            "experiment_assignments": self.experiment_assignments,
        }

    # marts ------------------------------------------------------------------
    @cached_property
    def member_360(self) -> DataFrame:
        from ..operators.features import member_360

        return self._mart(
            member_360(self.members, self.feature_listings, self.feature_events, self.feature_touches,
                       self.campaign_exclusions, self.spec, event_rollup=self.event_rollup),
            "member_360",
        )

    @cached_property
    def eligible_audience(self) -> DataFrame:
        from ..operators.audience import eligible_audience

        return self._mart(eligible_audience(self.member_360, self.spec), "eligible_audience")

    @cached_property
    def member_outcomes(self) -> DataFrame:
        from ..operators.outcomes import experiment_member_outcomes

        return self._mart(
            experiment_member_outcomes(self.eligible_audience, self.experiment_assignments, self.outcome_listings,
                                       self.campaign_touches, self.spec),
            "member_outcomes",
        )

    @cached_property
    def experiment_results(self) -> DataFrame:
        from ..operators.outcomes import experiment_results

        return self._mart(experiment_results(self.member_outcomes, self.spec), "experiment_results")

    # quality ------------------------------------------------------------------
    @cached_property
    def rejected_rows(self) -> DataFrame:
        """Rows per table and reason that lack a required value (S-9)."""
        counts = [df.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected"))
                  .select(F.lit(name).alias("table_name"), "reject_reason", "rejected") for name, df in self.rejects.items()]
        if not counts:
            return self.spark.createDataFrame([], "table_name string, reject_reason string, rejected long")
        return self._mart(reduce(DataFrame.unionByName, counts), "rejected_rows")

    @cached_property
    def arm_set_check(self) -> DataFrame:
        from ..operators.experiment import arm_set_check

        return arm_set_check(self.experiment_results, self.spec)

    @cached_property
    def quality_tables(self):
        from ..operators.quality import Tables

        return Tables(self.raw(), self.member_360, self.eligible_audience, self.member_outcomes,
                      self.experiment_results, self.spec)

    @cached_property
    def quality_results(self) -> DataFrame:
        from ..operators.quality import quality_results

        return self._mart(quality_results(self.quality_tables), "quality_results")

    # analysis -----------------------------------------------------------------
    @cached_property
    def comparisons(self) -> DataFrame:
        from ..operators import experiment as X

        return self._small(X.comparisons(self.experiment_results, self.spec))

    @cached_property
    def covariate_balance(self) -> DataFrame:
        from ..operators import experiment as X

        return self._small(X.covariate_balance(self.experiment_assignments, self.member_360, self.spec))

    @cached_property
    def srm(self) -> DataFrame:
        from ..operators import experiment as X

        return self._small(X.sample_ratio_mismatch(self.experiment_results, self.spec))

    @cached_property
    def power(self) -> DataFrame:
        from ..operators import experiment as X

        return self._small(X.power_plan(self.experiment_results, self.spec))

    @cached_property
    def decision_inputs(self) -> DataFrame:
        from ..operators import decision as D
        from ..operators import experiment as X
        from ..operators.quality import quality_passed

        bal = X.balance_summary(self.covariate_balance, self.spec)
        inputs = D.decision_inputs(self.comparisons, self.srm, bal, self.power, quality_passed(self.quality_results))
        return self._small(inputs)

    @cached_property
    def decision(self) -> DataFrame:
        from ..operators import decision as D

        return D.evaluate(self.decision_inputs, self.spec)

    @cached_property
    def decision_sweep(self) -> DataFrame:
        from ..operators import decision as D

        return D.scenario_sweep(self.decision_inputs, self.spec)

    @cached_property
    def decision_report(self) -> DataFrame:
        from ..operators import decision as D

        best = D.best_variant(self.comparisons)
        verdict = self.decision.select("experiment_id", "rollout_ready", "recommendation")
        return self._small(best.join(verdict, "experiment_id"))

    # activation ---------------------------------------------------------------
    @cached_property
    def activation_records(self) -> DataFrame:
        from ..operators.activation import activation_records, in_member_order

        recs = activation_records(self.eligible_audience, self.experiment_assignments, self.member_360, self.spec)
        recs = in_member_order(recs, lambda df: self.store.write(df, "activation_records_ranged"))
        return self._mart(recs, "activation_records")

    @cached_property
    def destination(self):
        from ..sources.versioned import MembershipStore

        return MembershipStore(self.spark, self.store.path("destination"))

    def _sync(self, run_id: str, batch_id: int):
        """One run against the destination: its log and the destination after it."""
        from ..operators.activation import classify, empty_destination
        from ..sources.versioned import sync_into, touched

        batch = self.activation_records
        current = self.destination.snapshot(*touched(classify(batch, empty_destination(self.spark), self.spec)))
        classified = self._mart(classify(batch, current, self.spec), f"sync_classified_{batch_id}")
        commit = sync_into(self.destination, classified, current, self.spec, run_id, batch_id, run_id)
        return self.destination.log(run_id, batch_id), self.destination.snapshot(at=commit)

    @cached_property
    def first_sync(self):
        return self._sync("initial-sync", 0)

    @cached_property
    def replay_sync(self):
        self.first_sync  # noqa: B018 - the run that is replayed
        return self._sync("idempotent-replay", 1)

    @cached_property
    def reconciliation(self) -> DataFrame:
        from ..operators.activation import reconciliation, run_summary

        return reconciliation(
            self.eligible_audience, self.experiment_assignments, self.activation_records,
            self.replay_sync[1], run_summary(self.replay_sync[0]), self.spec,
        )


@dataclass
class PipelineOutcome:
    quality_passed: bool
    outputs: dict[str, str] = field(default_factory=dict)
    stopped_by: str | None = None  # "rejected_rows", "quality" or "arm_set"


def run_pipeline(run: CampaignRun, out_dir: str) -> PipelineOutcome:
    """Write marts and reports. Stops at once if staging refused a row, and before
    activation and analysis if a quality rule fails or the observed arms are not
    the declared ones."""
    from ..operators import experiment as X
    from ..operators import reports
    from ..operators.activation import run_summary, sample_payloads
    from ..operators.audience import category_distribution, funnel
    from ..operators.quality import quality_passed
    from ..operators.schema_tests import declared_tests, row_counts, run_schema_tests
    from ..sources import sinks

    root = out_dir.rstrip("/")
    out: dict[str, str] = {}

    def put(name: str, df: DataFrame, json: bool = False) -> None:
        path = f"{root}/{name}"
        (sinks.write_report_json if json else sinks.write_table)(df, path)
        out[name] = path

    put("rejected_rows", run.rejected_rows, json=True)
    if not run.rejected_rows.isEmpty():
        return PipelineOutcome(False, out, "rejected_rows")
    marts = {"member_360": run.member_360, "eligible_audience": run.eligible_audience,
             "member_outcomes": run.member_outcomes, "experiment_results": run.experiment_results}
    sinks.write_marts(marts, f"{root}/marts")
    sinks.write_audience_sample(run.eligible_audience, f"{root}/activation_audience_sample")
    put("row_counts", row_counts(run.raw() | marts), json=True)
    put("warehouse_tests", run_schema_tests(run.raw() | marts, declared_tests(run.spec.arms, run.spec.channels)), json=True)
    put("data_quality", run.quality_results, json=True)
    passed = bool(quality_passed(run.quality_results).first()["quality_passed"])  # one row
    if not passed:
        return PipelineOutcome(False, out, "quality")
    put("arm_set_check", run.arm_set_check, json=True)
    if not run.arm_set_check.filter(~F.col("arms_match")).isEmpty():
        return PipelineOutcome(True, out, "arm_set")
    first_log, _ = run.first_sync
    replay_log, dest = run.replay_sync
    put("destination", dest)
    put("sync_log", first_log.unionByName(replay_log))
    put("activation_reconciliation", run.reconciliation, json=True)
    put("sync_runs", run_summary(first_log.unionByName(replay_log)), json=True)
    put("sample_payloads", sample_payloads(run.activation_records), json=True)
    put("experiment_comparisons", run.comparisons, json=True)
    put("randomization_srm", run.srm, json=True)
    put("covariate_balance", run.covariate_balance, json=True)
    put("power_plan", run.power, json=True)
    put("decision", run.decision, json=True)
    put("decision_scenarios", run.decision_sweep, json=True)
    put("funnel", funnel(run.member_360), json=True)
    put("category_distribution", category_distribution(run.eligible_audience), json=True)
    put("commercial_assumptions", reports.commercial_assumptions(run.spark, run.spec), json=True)
    put("methodology", reports.methodology(run.spark, run.spec), json=True)
    put("treatment_table", reports.treatment_table(run.comparisons), json=True)
    put("conversion_by_arm", reports.conversion_by_arm(run.experiment_results), json=True)
    put("headline", reports.headline(run.experiment_results, run.decision_report, run.quality_results), json=True)
    balance = X.balance_summary(run.covariate_balance, run.spec)
    put("evidence", reports.evidence(run.experiment_results, run.decision_report, run.srm, balance, run.power, run.spec), json=True)
    return PipelineOutcome(True, out)
