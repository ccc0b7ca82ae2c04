"""Defaults of every operator, in one frozen tree."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Splits:
    train_end: str = "2023-06-01"
    val_end: str = "2023-08-01"
    test_end: str = "2023-10-01"

    @property
    def snapshots(self) -> tuple[str, str, str]:
        return (self.train_end, self.val_end, self.test_end)


@dataclass(frozen=True)
class Label:
    window_days: int = 90
    include_pending: bool = True


@dataclass(frozen=True)
class Tiers:
    high: float = 0.70
    medium: float = 0.30
    top_drivers: int = 3
    fallback_high_share: float = 0.05
    fallback_medium_share: float = 0.20


@dataclass(frozen=True)
class Encoding:
    columns: tuple[str, ...] = ("crm_package_name", "sales_channel")
    folds: int = 5
    smoothing: float = 1.0


@dataclass(frozen=True)
class Drift:
    bins: int = 10
    epsilon: float = 1e-4
    psi_alert: float = 0.2
    feature_p_value: float = 0.05
    dataset_share: float = 0.2
    mean_shift: float = 0.05
    critical_share: float = 0.3
    critical_alerts: int = 3


@dataclass(frozen=True)
class Economics:
    annual_revenue: float = 360.0
    call_cost: float = 8.0
    success_rate: float = 0.25
    headline_capacity: float = 0.20
    capacities: tuple[float, ...] = (0.05, 0.10, 0.15, 0.20, 0.30)


@dataclass(frozen=True)
class Settings:
    splits: Splits = field(default_factory=Splits)
    label: Label = field(default_factory=Label)
    tiers: Tiers = field(default_factory=Tiers)
    encoding: Encoding = field(default_factory=Encoding)
    drift: Drift = field(default_factory=Drift)
    economics: Economics = field(default_factory=Economics)
    call_windows: tuple[int, ...] = (7, 14, 30, 90)
    promote_tolerance: float = 0.01
    retune_after_days: int = 28


DEFAULTS = Settings()

# --- fixed values: category lists and texts that outputs must carry ---------------------------
CONTRACT_STATUSES = (
    "01 Early Contract",
    "02 In Contract",
    "03 Soon to be OOC",
    "04 Coming OOC",
    "05 Newly OOC",
    "06 OOC",
)
TECHNOLOGIES = ("FTTC", "FTTP", "GFAST", "MPF")
LEAVING_REASONS = (
    "CompetitorDeals",
    "VagueReason",
    "HomeMove",
    "Bereavement",
    "Other",
    "BadDebtDisconnect",
    "CustomerServices",
    "Installation&Provisioning",
    "Mis-sold",
    "TV",
    "TechnicalIssue",
)
REASON_GROUPS = {
    "CompetitorDeals": "addressable",
    "TechnicalIssue": "addressable",
    "Mis-sold": "addressable",
    "Bereavement": "non-addressable",
    "HomeMove": "non-addressable",
    "BadDebtDisconnect": "involuntary",
    "VagueReason": "unclassified",
}
LEAKY_COLUMNS = (
    "cease_placed_date",
    "cease_completed_date",
    "reason_description",
    "reason_description_insight",
)
NON_FEATURES = (
    "unique_customer_identifier",
    "snapshot_date",
    "churned",
    "tenure_bucket",
    "sales_channel",
    "crm_package_name",
)
DRIVER_ACTIONS = {
    "ooc_days": "Proactive renewal offer 30 days before contract expiry",
    "tenure_days": "Loyalty programme enrolment for long-tenure customers",
    "tenure_log": "Early-life onboarding programme to reduce new-customer churn",
    "days_since_last_call": "Proactive check-in call (customer has gone quiet)",
    "speed_gap_pct": "Engineering ticket + service credit for underperforming line",
    "contract_dd_cancels": "Payment plan discussion + gentle outreach",
    "total_calls": "Investigate repeat-contact root cause; warm transfer to specialist",
    "avg_call_duration": "Review call quality — long calls may indicate unresolved issues",
    "is_out_of_contract": "Re-contract offer with competitive pricing",
}
DEFAULT_ACTION = "Investigate further — tailor retention offer based on customer profile"
REQUEST_DEFAULTS = {
    "dd_cancel_60_day": 0.0,
    "contract_status_risk": 1.0,
    "speed_gap_pct": 0.0,
    "call_count_30d": 0.0,
    "loyalty_call_flag_30d": 0.0,
    "avg_download_30d": 0.0,
    "download_trend_7_30": 1.0,
    "avg_talk_time_30d": 0.0,
}
REQUEST_REQUIRED = ("ooc_days", "tenure_days")
CONTEXT_COLUMNS = (
    "ooc_days",
    "contract_status_risk",
    "tenure_days",
    "loyalty_call_flag_30d",
    "speed_gap_pct",
)
