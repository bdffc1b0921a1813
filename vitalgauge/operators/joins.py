"""Joins.

Several joins of the scorecards match many rows with many rows, only to count or sum the result
afterwards. Those are written as *match counts*: the side that multiplies is counted per key
first, and the count is joined as a weight. Sums over the joined rows are then weighted sums, and
no key, however hot, produces more rows than it came with.
"""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgauge.functions import months_before, plan_key, plan_keys
from vitalgauge.operators.filters import active_workapps, mobile_device


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match NULL keys; the left key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    matches = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys])
    return left.join(renamed, matches, how).drop(*[f"right_{k}" for k in keys])


def with_weight(rows: DataFrame, counts: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Left join to match counts: ``name`` is the number of rows a left join to the counted side
    would have made of each row (1 where nothing matches)."""
    return rows.join(counts, list(on), "left").withColumn(name, F.coalesce(F.col(name), F.lit(1)))


# --- dimensions -----------------------------------------------------------------------------------


def plan_daily_with_account(plan_daily: DataFrame, plans: DataFrame) -> DataFrame:
    """Daily plan facts with the account of the plan; rows without plan, date or account vanish."""
    return plan_daily.dropna(subset=["plan_uid", "date"]).join(plans, "plan_uid")


def solution_plan_month(solutions: DataFrame, daily: DataFrame) -> DataFrame:
    """Solution months with the plan facts of the same plan and date, where there are any."""
    return solutions.join(daily, ["plan_uid", "date"], "left")


def presence(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``key`` values that occur, with a constant 1 under ``name``."""
    return rows.select(key).dropna().distinct().withColumn(name, F.lit(1))


def with_presence(rows: DataFrame, present: DataFrame, key: str, name: str) -> DataFrame:
    """1 under ``name`` where the key is present, else 0."""
    return rows.join(present, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def paying_plan_months(plan_daily: DataFrame, plan: DataFrame, account: DataFrame) -> DataFrame:
    """Daily plan facts of paying multi-license plans, with plan and account attributes."""
    paying = plan.where((F.col("arr") > 0) & (F.col("licenses") > 1)).select(
        "plan_uid", "account_id", F.col("first_paid").alias("plan_first_paid")
    )
    named = account.select("account_id", "name", "arr")
    # The account of a paying plan may be unknown: such rows stay, without account attributes.
    joined = plan_daily.join(paying, "plan_uid").withColumnRenamed("account_id", "plan_account")
    return joined.join(named, F.col("plan_account") == F.col("account_id"), "left").drop("plan_account")


# --- high-value-task users ------------------------------------------------------------------------


def hvt_counts(hvt_solutions: DataFrame, solution: str = "solution_key") -> DataFrame:
    """Rows per account, solution and number of high-value-task users."""
    return hvt_solutions.groupBy("account_id", solution, "users_hvt").agg(F.count("*").alias("hvt_rows"))


def hvt_weights(counts: DataFrame, solution: str = "solution_key") -> DataFrame:
    """Match counts of the solution-to-solution join on account and solution."""
    return counts.groupBy("account_id", solution).agg(F.sum("hvt_rows").alias("hvt_weight"))


# --- work apps ------------------------------------------------------------------------------------


def by_plan_key(workapps: DataFrame) -> DataFrame:
    """Work apps with ``plan_key``: a row for each key that the owner's plan id answers to (two at most)."""
    return workapps.withColumn("plan_key", F.explode(plan_keys("owner_plan_uid")))


def workapp_months(workapps: DataFrame, since: dt.date | Column | None = None) -> DataFrame:
    """Active work apps by plan key, with the year and month they took effect in; ``since`` drops those of
    earlier months in the scan."""
    active = active_workapps(workapps)
    if since is not None:
        active = active.where(F.col("effective_from") >= F.trunc(F.lit(since), "month"))
    return by_plan_key(active).select(
        "plan_key",
        F.year("effective_from").alias("year"),
        F.month("effective_from").alias("month_calendar"),
        "container_uid",
        "owner_user_uid",
    )


def workapp_month_counts(apps: DataFrame) -> DataFrame:
    """Per plan and month: rows, distinct containers and distinct owners of the work apps."""
    return apps.groupBy("plan_key", "year", "month_calendar").agg(
        F.count("*").alias("app_weight"),
        F.count_distinct("container_uid").alias("containers"),
        F.count_distinct("owner_user_uid").alias("app_owners"),
    )


def with_workapp_months(rows: DataFrame, apps: DataFrame) -> DataFrame:
    """Left join on plan, year and month, as match counts."""
    keyed = rows.withColumn("plan_key", plan_key("plan_uid"))
    counted = with_weight(keyed, workapp_month_counts(apps), ["plan_key", "year", "month_calendar"], "app_weight")
    return counted.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)) for c in ("containers", "app_owners")}
    )


def workapps_valid_at(workapps: DataFrame, day: dt.date) -> DataFrame:
    """Distinct active work apps whose interval, possibly open-ended, holds ``day``."""
    ends = F.col("effective_to")
    valid = active_workapps(workapps).where(
        (F.col("effective_from") <= F.lit(day)) & (ends.isNull() | (ends >= F.lit(day)))
    )
    return valid.select("container_uid", "owner_plan_uid", "owner_user_uid").distinct()


def interval_match_counts(points: DataFrame, intervals: DataFrame, key: str, name: str) -> DataFrame:
    """For each distinct ``key, date`` of ``points``: how many intervals of the key hold the date.

    ``intervals`` has ``key, effective_from, effective_to``; both ends count, and an interval
    without an end matches nothing (as BETWEEN has it). The count is a running sum of starts and
    ends. These are summed per key and day before the window, so a window partition holds at most
    one row per calendar day, however many intervals or points the key has.
    """
    valid = intervals.where(F.col("effective_to") >= F.col("effective_from"))
    starts = valid.select(key, F.col("effective_from").alias("date"), F.lit(1).alias("step"))
    ends = valid.select(key, F.date_add("effective_to", 1).alias("date"), F.lit(-1).alias("step"))
    asked = points.select(key, "date", F.lit(0).alias("step"), F.lit(True).alias("asked"))
    per_day = (
        starts.unionByName(ends)
        .withColumn("asked", F.lit(False))
        .unionByName(asked)
        .where(F.col(key).isNotNull() & F.col("date").isNotNull())
        .groupBy(key, "date")
        .agg(F.sum("step").alias("step"), F.max("asked").alias("asked"))
    )
    running = Window.partitionBy(key).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return (
        per_day.withColumn(name, F.sum("step").over(running))
        .where("asked")
        .select(key, "date", name)
    )


# --- mobile users ---------------------------------------------------------------------------------


def mobile_session_counts(sessions: DataFrame, any_case: bool = False) -> DataFrame:
    """Distinct mobile sessions per user."""
    return (
        sessions.where(mobile_device(any_case))
        .groupBy("user_uid")
        .agg(F.count_distinct("session_uid").alias("mobile_sessions"))
    )


def mobile_users(sessions: DataFrame, any_case: bool = False) -> DataFrame:
    """Users with mobile sessions, with ``has_mobile`` telling whether any has an id."""
    return (
        sessions.where(mobile_device(any_case))
        .groupBy("user_uid")
        .agg((F.count("session_uid") > 0).alias("has_mobile"))
    )


def plan_users(user_plan: DataFrame, mobile: DataFrame, only_mobile: bool) -> DataFrame:
    """Distinct users per plan with ``is_mobile``; ``only_mobile`` keeps users with sessions only."""
    pairs = user_plan.where(F.col("plan_uid").isNotNull()).select("user_uid", "plan_uid").distinct()
    joined = pairs.join(mobile, "user_uid", "inner" if only_mobile else "left")
    return joined.select(
        "plan_uid", "user_uid", F.coalesce(F.col("has_mobile"), F.lit(False)).alias("is_mobile")
    )


def account_users(user_plan: DataFrame, plan: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every user of every plan with the account of the plan and the number of mobile sessions."""
    counted = (
        sessions.where(mobile_device())
        .groupBy("user_uid")
        .agg(F.count("session_uid").alias("mobile_sessions"))
    )
    owned = user_plan.join(plan.select("plan_uid", "account_id"), "plan_uid")
    return owned.join(counted, "user_uid", "left").select(
        "plan_uid", "account_id", "user_uid", F.coalesce("mobile_sessions", F.lit(0)).alias("mobile_sessions")
    )


# --- grid -----------------------------------------------------------------------------------------


def work_type_grid(names: DataFrame, categories: DataFrame, column: str = "work_type") -> DataFrame:
    """Every row of ``names`` once per distinct category: the dense grid is what this operator is for.

    The categories stay a DataFrame. They are copied to a fixed number of slices, over which the rows of ``names``
    are spread, so the product is an equi-join that runs in many tasks.
    """
    slices = F.explode(F.sequence(F.lit(0), F.lit(_GRID_SLICES - 1)))
    copies = categories.select(column).where(F.col(column).isNotNull()).distinct().withColumn("slice", slices)
    spread = names.withColumn("slice", F.pmod(F.xxhash64(*names.columns), F.lit(_GRID_SLICES)).cast("int"))
    return spread.join(copies, "slice").drop("slice")


_GRID_SLICES = 256


def fill_grid(grid: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of facts to a grid on plain equality of all keys, so a NULL key finds nothing."""
    return grid.join(facts, list(keys), "left")


def in_months_back(rows: DataFrame, as_of: dt.date, months_back: int) -> DataFrame:
    return rows.where(F.col("date") >= months_before(as_of, months_back))


#: Weights multiply and are summed again, which a bigint doesn't hold for hot keys.
WEIGHT = "decimal(38,0)"


def weight_of(*names: str) -> Column:
    """Product of weights, exact far beyond the range of bigint."""
    return functools.reduce(operator.mul, [F.col(n).cast(WEIGHT) for n in names]).cast(WEIGHT)
