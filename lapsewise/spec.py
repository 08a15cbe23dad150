"""Campaign specification: every constant of a campaign is an argument.

The pipeline never hard-codes an instant, a window, a threshold or a price.
`CampaignSpec` carries them; `reference_spec()` reproduces the reference
campaign and `testdata_spec()` the instant used against the supplied tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical results.
# ---------------------------------------------------------------------------
CAMPAIGN_ID = "seller_reactivation_2026_08"
EXPERIMENT_ID = "exp_seller_reactivation_2026_08"
CAMPAIGN_AT = datetime(2026, 8, 1, 9, 0, 0)
OUTCOME_END = datetime(2026, 8, 15, 23, 59, 59)
RECENT_DAYS = 30
CONTACT_DAYS = 7
LAPSE_DAYS = 90
CONTACT_CAP = 2
ARMS = ("control", "generic", "personalized")
CONTROL_ARM = "control"
CHANNELS = ("email", "push")
WILSON_Z = 1.96
SRM_P_THRESHOLD = 0.01
SMD_THRESHOLD = 0.10
ADJUSTED_P_THRESHOLD = 0.05
UNSUBSCRIBE_RATE_LIMIT = 0.01
VALUE_PER_INCREMENTAL_UNIT = 5.50
# variant -> (fixed cost, cost per message)
CAMPAIGN_COSTS = {"generic": (80.0, 0.015), "personalized": (120.0, 0.020)}
POWER_BASELINE_RATE = 0.07
POWER_MDE = 0.04
POWER_ALPHA = 0.025
POWER_TARGET = 0.80
COVARIATES = (
    "historical_listing_count",
    "historical_sales_count",
    "historical_gmv",
    "recent_event_count",
    "recent_watchlist_count",
    "recent_purchase_count",
    "marketing_contacts_7d",
)
HISTORICAL_CAMPAIGN = "historical"


@dataclass(frozen=True)
class CampaignSpec:
    campaign_id: str = CAMPAIGN_ID
    experiment_id: str = EXPERIMENT_ID
    campaign_at: datetime = CAMPAIGN_AT
    outcome_end: datetime = OUTCOME_END
    recent_days: int = RECENT_DAYS
    contact_days: int = CONTACT_DAYS
    lapse_days: int = LAPSE_DAYS
    contact_cap: int = CONTACT_CAP
    arms: tuple[str, ...] = ARMS
    control_arm: str = CONTROL_ARM
    channels: tuple[str, ...] = CHANNELS
    wilson_z: float = WILSON_Z
    srm_p_threshold: float = SRM_P_THRESHOLD
    smd_threshold: float = SMD_THRESHOLD
    adjusted_p_threshold: float = ADJUSTED_P_THRESHOLD
    unsubscribe_rate_limit: float = UNSUBSCRIBE_RATE_LIMIT
    value_per_unit: float = VALUE_PER_INCREMENTAL_UNIT
    costs: dict = field(default_factory=lambda: dict(CAMPAIGN_COSTS))
    power_baseline_rate: float = POWER_BASELINE_RATE
    power_mde: float = POWER_MDE
    power_alpha: float = POWER_ALPHA
    power_target: float = POWER_TARGET
    covariates: tuple[str, ...] = COVARIATES
    assignment_salt: str = "s1"
    assignment_lead: timedelta = timedelta(hours=1)
    # hex digits of the salted hash used as an order-preserving bucket
    assignment_bucket_digits: int = 4

    @property
    def treatments(self) -> tuple[str, ...]:
        return tuple(a for a in self.arms if a != self.control_arm)

    @property
    def recent_start(self) -> datetime:
        return self.campaign_at - timedelta(days=self.recent_days)

    @property
    def contact_start(self) -> datetime:
        return self.campaign_at - timedelta(days=self.contact_days)

    @property
    def lapsed_cutoff(self) -> datetime:
        return self.campaign_at - timedelta(days=self.lapse_days)

    @property
    def assigned_at(self) -> datetime:
        return self.campaign_at - self.assignment_lead

    @property
    def comparisons(self) -> int:
        return len(self.treatments)

    def with_(self, **changes) -> "CampaignSpec":
        return replace(self, **changes)


def reference_spec() -> CampaignSpec:
    return CampaignSpec()


# The supplied test tables are shifted so the campaign instant sits inside
# their event range (see FIXTURES.md section 3).
TESTDATA_CAMPAIGN_AT = datetime(2001, 5, 1, 9, 0, 0)
TESTDATA_OUTCOME_DAYS = 60


def testdata_spec() -> CampaignSpec:
    return CampaignSpec(
        campaign_at=TESTDATA_CAMPAIGN_AT,
        outcome_end=TESTDATA_CAMPAIGN_AT + timedelta(days=TESTDATA_OUTCOME_DAYS),
    )
