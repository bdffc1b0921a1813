"""Grouped aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.functions import coalesce_first, concat_label, strip_id_prefix
from vitalgauge.operators.filters import active_work_types

#: Daily plan measures summed per account, and monthly measures summed per work type.
PLAN_SUMS = (
    "licenses", "users_licensed", "users_licensed_active", "users_collab_external", "users_collab_internal",
)
WORK_TYPE_SUMS = (
    "days_edit", "days_edit_hvt", "days_edit_non_hvt", "total_count", "users_active", "users_edit",
    "users_external", "users_hvt", "users_hvt_editor", "users_hvt_viewer", "users_non_hvt_editor",
    "users_non_hvt_viewer", "users_view", "days_view", "days_view_hvt", "days_view_non_hvt",
)


def account_arr_having(daily: DataFrame, minimum: float) -> DataFrame:
    """Accounts whose summed plan revenue reaches ``minimum``."""
    summed = daily.groupBy("account_id").agg(F.sum("plan_arr").alias("total_arr"))
    return summed.where(F.col("total_arr") >= F.lit(minimum))


def snapshot_solutions(
    solutions: DataFrame, plan: DataFrame, account: DataFrame, month: dt.date, min_arr: float
) -> DataFrame:
    """Solutions of one month whose account has at least ``min_arr``, with the account id."""
    rich = account.where(F.col("arr") >= F.lit(min_arr)).select("account_id")
    owned = plan.select("plan_uid", "account_id").join(rich, "account_id", "left_semi")
    return solutions.where(F.col("date") == F.lit(month)).join(owned, "plan_uid")


def accounts_over_n_solutions(solutions: DataFrame, minimum: int) -> DataFrame:
    """Accounts with more than ``minimum`` solutions."""
    counted = solutions.groupBy("account_id").agg(F.count("solution_uid").alias("solution_count"))
    return counted.where(F.col("solution_count") > minimum)


def owner_solution_counts(solutions: DataFrame) -> DataFrame:
    """Solution months per owner; solutions without an owner form a group of their own."""
    return solutions.groupBy("owner_uid").agg(F.count("solution_uid").alias("total_solutions_per_owner"))


def mobile_users_per_account(users: DataFrame, require_mobile: bool = False) -> DataFrame:
    """Distinct users per account; with ``require_mobile`` only those with mobile sessions."""
    kept = users.where(F.col("mobile_sessions") > 0) if require_mobile else users
    return kept.groupBy("account_id").agg(F.count_distinct("user_uid").alias("mobile_users_count"))


def weighted_sum(column: str | Column, weight: str | Column) -> Column:
    """Sum over joined rows, from rows that carry the number of joined rows as a weight."""
    value = F.col(column) if isinstance(column, str) else column
    factor = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(value * factor)


def weighted_count(predicate: Column, weight: str | Column) -> Column:
    """Number of joined rows for which the predicate holds."""
    factor = F.col(weight) if isinstance(weight, str) else weight
    return F.sum(F.when(predicate, factor).otherwise(0))


def account_month_rollup(paying: DataFrame) -> DataFrame:
    """Daily plan facts per account, date and account name."""
    return paying.groupBy("account_id", "date", "name").agg(
        F.max("arr").alias("arr"),
        F.sum("plan_arr").alias("plan_arr"),
        F.min("plan_first_paid").alias("plan_first_paid"),
        *[F.sum(c).alias(c) for c in PLAN_SUMS],
    )


def rich_names(account: DataFrame, min_arr: float) -> DataFrame:
    """Account ids and names with at least ``min_arr``, each pair once."""
    return account.where(F.col("arr") >= F.lit(min_arr)).select("account_id", "name").distinct()


def plan_to_account_rollup(plan_monthly: DataFrame, account_months: DataFrame, min_arr: float) -> DataFrame:
    """Monthly plan measures per work type, account, name and date, with the account's plan facts.

    The plan rows are summed per account, date and work type before they meet the account-month,
    of which there may be one per account name; both sides then shuffle once per group.
    """
    kept = account_months.where(F.col("arr") >= F.lit(min_arr))
    per_type = (
        active_work_types(plan_monthly)
        .groupBy("account_id", "date", "work_type")
        .agg(F.max("quarters_active").alias("quarters_active"), *[F.sum(c).alias(c) for c in WORK_TYPE_SUMS])
    )
    # account_months is unique per account, date and name, so the joined rows are the groups.
    return per_type.join(kept, ["account_id", "date"])


def string_agg_label(
    plan_monthly: DataFrame, plan: DataFrame, account: DataFrame, min_arr: float
) -> DataFrame:
    """Per account: ``name (plan, plan, …)`` over its distinct paying plans, ids in text order."""
    paying = plan.where((F.col("arr") > 0) & (F.col("licenses") > 1)).select("plan_uid", "account_id")
    rich = account.where(F.col("arr") >= F.lit(min_arr)).select("account_id", "name")
    used = plan_monthly.select("plan_uid", "account_id").distinct()
    tokens = used.join(paying, ["plan_uid", "account_id"], "left_semi").select(
        "account_id", strip_id_prefix("plan_uid").alias("token")
    )
    lists = tokens.distinct().groupBy("account_id").agg(
        F.array_join(F.array_sort(F.collect_list("token")), ", ").alias("plans")
    )
    return rich.join(lists, "account_id").select(
        "account_id", "name", concat_label("name", "plans").alias("account_name_ppid")
    )


def partner_since(account_first: str, plan_first: str, session_first: str) -> Column:
    return coalesce_first(account_first, plan_first, session_first)
