"""Parameters of the scorecards: dates and thresholds, passed in so that results do not move."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Dates and thresholds shared by all plans.

    ``as_of`` stands for "today" and ``snapshot`` is the single month of the one-month
    snapshot. The numeric defaults are the production thresholds.
    """

    as_of: dt.date
    snapshot: dt.date
    months_back: int = 24
    days_back: int = 90
    min_account_plan_arr: float = 5_000
    min_account_arr_snapshot: float = 5_000
    min_account_arr_grid: float = 10_000
    min_plan_arr_snapshot: float = 5_000
    power_owner_over: int = 10
    accounts_over: int = 10


#: Thresholds scaled to the TPC-H-like test tables, so that each filter really splits the rows.
FIXTURE_PARAMS = Params(
    as_of=dt.date(2001, 8, 1),
    snapshot=dt.date(2001, 7, 1),
    min_account_plan_arr=24_000_000,
    min_account_arr_snapshot=44_000,
    min_account_arr_grid=44_000,
    min_plan_arr_snapshot=290_000,
    power_owner_over=509,
    accounts_over=7,
)
