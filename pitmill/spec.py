"""Profile thresholds as parameters; the defaults are the published profile's."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ProfileSpec:
    profile_id: str = "LIQUID_V1"
    profile_version: str = "LIQUID_V1"
    instrument_type: str = "ORDINARY_EQUITY"
    trading_status: str = "ACTIVE_TRADING"
    price_min: float = 20.0
    listing_age_sessions_min: int = 272
    positive_volume_days_60_min: int = 40
    median_traded_value_60_min: float = 5_000_000.0
    ranking_metric: str = "median_traded_value_126"
    #: (flag, observed sessions it needs)
    readiness: tuple[tuple[str, int], ...] = (("feature_ready_60", 60), ("feature_ready_126", 126), ("signal_history_ready_252", 252), ("signal_history_ready_273", 273), ("model_handoff_history_ready_300", 300))
    tops: tuple[int, ...] = (500, 750, 1000)


#: Thresholds that divide the test panel.
SMALL = ProfileSpec(price_min=1000.0, listing_age_sessions_min=272, positive_volume_days_60_min=12, median_traded_value_60_min=30_000.0, tops=(10, 25, 50))
