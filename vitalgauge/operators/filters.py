"""Row filters. All are plain predicates, so that Spark can push them to the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.functions import months_before, year_month_label

INACTIVE_WORK_TYPES = ("Not Active",)


def filtered_solutions(solutions: DataFrame, as_of: dt.date) -> DataFrame:
    """Solution months with a plan and at least one active quarter, up to ``as_of``."""
    return solutions.where(
        (F.col("quarters_active") >= 1) & (F.col("date") <= F.lit(as_of)) & F.col("plan_uid").isNotNull()
    )


def filtered_plans(plans: DataFrame) -> DataFrame:
    """Plans with both ids: ``plan_uid, account_id``."""
    return plans.select("plan_uid", "account_id").dropna()


def trailing_months(dates: DataFrame, as_of: dt.date, months_back: int) -> DataFrame:
    """First-of-month days from ``months_back`` months before ``as_of`` on, with their labels."""
    return (
        dates.where((F.col("day_of_month") == 1) & (F.col("date") >= months_before(as_of, months_back)))
        .select(
            "date",
            "year_fiscal",
            "year",
            "month_calendar",
            year_month_label("year", "month_calendar").alias("year_month"),
        )
        .distinct()
    )


def active_work_types(rows: DataFrame, excluded: Iterable[str] = INACTIVE_WORK_TYPES) -> DataFrame:
    """Rows whose work type is known and not excluded."""
    return rows.where(~F.col("work_type").isin(*excluded))


def active_workapps(workapps: DataFrame) -> DataFrame:
    return workapps.where(F.col("status") == "Active")


def mobile_device(any_case: bool = False) -> Column:
    """Device starts with ``Mobile``, or with ``any_case`` has ``mobile`` anywhere in any case."""
    if any_case:
        return F.contains(F.lower("device"), F.lit("mobile"))
    return F.startswith("device", F.lit("Mobile"))


def month_equals(rows: DataFrame, month: dt.date, column: str = "date") -> DataFrame:
    """Rows dated in the month of ``month``: a half-open date range rather than a formatted month."""
    first = month.replace(day=1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    return rows.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(following)))


def account_in(rows: DataFrame, accounts: DataFrame | Iterable) -> DataFrame:
    """Rows of the given accounts: a short list of ids, or a DataFrame with ``account_id``."""
    if isinstance(accounts, DataFrame):
        return rows.join(accounts.select("account_id"), "account_id", "left_semi")
    return rows.where(F.col("account_id").isin(*accounts))


def positive_hvt(solutions: DataFrame) -> DataFrame:
    """Solution months with high-value-task users."""
    return solutions.where(F.col("users_hvt") > 0)
