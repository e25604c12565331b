"""Explicit run parameters.

The source jobs read ``CURRENT_DATE`` / ``SYSDATE()`` and hard-code status
codes and thresholds; here every one of them is a parameter so a run is
reproducible and testable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# The rolling horizons (days) of the aggregate metrics and of the
# top-product ranking, and the default thresholds of the two VIP rules.
METRIC_HORIZONS = (7, 14, 21, 32, 60, 90)
PRODUCT_HORIZONS = (7, 30, 90)
DEFAULT_VIP_MIN_AMOUNT = 200
DEFAULT_VIP_MIN_COUNT = 5
DEFAULT_CROSSING_AMOUNT = 1000


@dataclass(frozen=True)
class ReportParams:
    """Parameters shared by the operators of one report run.

    ``asof`` replaces the database's current date: day differences are
    ``datediff(asof, day)``. Horizons are inclusive (``<= N``) and let
    future-dated rows through, as the source queries do.
    """

    asof: dt.date = field(default_factory=dt.date.today)
    horizons: tuple[int, ...] = METRIC_HORIZONS
    product_horizons: tuple[int, ...] = PRODUCT_HORIZONS
    approved_statuses: tuple[str, ...] = ("Approved", "ApprovedManually")
    deposit_type: object = 2
    withdrawal_type: object = 1
    vip_min_amount: float = DEFAULT_VIP_MIN_AMOUNT
    vip_min_count: int = DEFAULT_VIP_MIN_COUNT
    crossing_amount: float = DEFAULT_CROSSING_AMOUNT
    # Digits that the source database's decimal division adds to the scale of
    # the dividend in per-row base-currency amounts (amount / rate).
    fx_extra_digits: int = 4
    # Reproduce the source's slip where the 30/90-day "bets on top game"
    # columns carry the 7-day value.
    reference_compat: bool = False
    # Declare that transaction ids do not repeat within a day: spares the scan of
    # ids and days that finds the days on which they do.
    unique_txn_ids: bool = False
