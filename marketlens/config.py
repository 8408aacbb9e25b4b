"""Analysis parameters. Every operator takes them from here; none is hard coded in a plan."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import date


@dataclass(frozen=True)
class Settings:
    # The published analysis is defined by these dates, thresholds and labels.
    window_start: date = date(2017, 1, 1)
    window_end: date = date(2018, 9, 1)  # exclusive
    excluded_statuses: tuple[str, ...] = ("canceled", "unavailable")
    rfm_reference: date = date(2018, 9, 1)
    # The calendar's days; None for the whole years in which there are orders.
    calendar_start: date | None = date(2016, 9, 1)
    calendar_end: date | None = date(2018, 10, 31)  # inclusive
    hand_translations: dict[str, str] = field(
        default_factory=lambda: {
            "pc_gamer": "pc_gamer",
            "portateis_cozinha_e_preparadores_de_alimentos": "portable_kitchen_and_food_preparers",
        }
    )
    compared_years: tuple[int, int] = (2017, 2018)
    compared_last_month: int = 8
    spike_start: date = date(2017, 10, 15)
    spike_end: date = date(2017, 12, 15)  # inclusive
    spike_baseline_end: date = date(2017, 11, 20)  # exclusive
    aov_min_orders: int = 1000
    late_min_orders: int = 300
    dashboard_late_min_orders: int = 100
    category_min_customers: int = 1500
    return_cohorts_before: date = date(2018, 3, 1)
    return_days: int = 180
    cohort_first: str = "2017-01"
    cohort_last: str = "2018-07"
    cohort_horizon: str = "2018-08"
    cohort_months: int = 12
    seller_min_orders: int = 30
    seller_late_limit: float = 0.15
    seller_review_limit: float = 3.5
    late_alert_pct: float = 10.0
    gap_bin_days: int = 15
    gap_last_edge: int = 585


# The same analysis bound to the dates and volumes of the test tables.
STANDIN = replace(
    Settings(),
    window_start=date(1999, 1, 1),
    window_end=date(2000, 9, 1),
    rfm_reference=date(2000, 9, 1),
    calendar_start=None,
    calendar_end=None,
    hand_translations={"economy_ring": "economy_ring", "promo_bolt": "promo_bolt"},
    compared_years=(1999, 2000),
    spike_start=date(1999, 10, 15),
    spike_end=date(1999, 12, 15),
    spike_baseline_end=date(1999, 11, 20),
    aov_min_orders=120,
    late_min_orders=150,
    dashboard_late_min_orders=120,
    category_min_customers=30,
    return_cohorts_before=date(2000, 3, 1),
    cohort_first="1999-01",
    cohort_last="2000-07",
    cohort_horizon="2000-08",
    seller_min_orders=135,
    seller_late_limit=0.24,
)
