"""One-month snapshot: one row per account with about 28 measures, without windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.functions import (
    contains_text,
    format_month,
    json_path,
    normalize_department,
    plan_key,
    round_arr,
    sum_columns,
    text_not_empty,
)
from vitalgauge.operators import filters, joins
from vitalgauge.operators.aggregates import (
    accounts_over_n_solutions,
    mobile_users_per_account,
    owner_solution_counts,
    weighted_count,
)
from vitalgauge.operators.windows import count_distinct_if
from vitalgauge.params import Params
from vitalgauge.sources.shared import share
from vitalgauge.tables import Tables

PLAN_FACTS = (
    "users_licensed", "users_licensed_active", "users_collab_internal", "users_collab_internal_active",
    "users_collab_external", "users_collab_external_active",
)
ATTRIBUTES = ("month_year", "account_name", "account_arr", "territory_type", "industry", "sub_industry")
WORK_APP = "WorkApps"
#: Columns the measures read.
MEASURED = (
    "account_id", *ATTRIBUTES, *PLAN_FACTS, "solution_uid", "owner_uid", "users_active", "users_hvt",
    "users_external", "users_external_view", "quarters_active", "workflows", "wt_complexity",
    "api_integrations", "api_apps", "weight", "is_work_app", "power",
)


#: Columns of :func:`month_rows` that the snapshot reads.
MONTH_COLUMNS = (
    *(c for c in MEASURED if c not in ("weight", "is_work_app", "power")), "plan_uid", "date", "in_plan",
)


def month_rows(t: Tables, p: Params, accounts: DataFrame | list | None = None) -> DataFrame:
    """All solutions of the snapshot month of accounts with enough revenue, with account attributes, and with plan facts
    where the plan has enough revenue (``in_plan``). The only scan of the solutions and of the daily plan facts."""
    solutions = filters.month_equals(t.solution_monthly, p.snapshot).where(F.col("date") == F.lit(p.snapshot))
    owners = t.account.where(F.col("arr") >= F.lit(p.min_account_arr_snapshot)).select(
        "account_id",
        F.col("name").alias("account_name"),
        round_arr("arr").alias("account_arr"),
        "territory_type",
        json_path("company", "industry").alias("industry"),
        json_path("company", "industry_sub").alias("sub_industry"),
    )
    if accounts is not None:
        owners = filters.account_in(owners, accounts)
    daily = t.plan_daily.where(
        (F.col("date") == F.lit(p.snapshot)) & (F.col("plan_arr") >= F.lit(p.min_plan_arr_snapshot))
    ).select("plan_uid", F.lit(True).alias("in_plan"), *PLAN_FACTS)
    plans = t.plan.select("plan_uid", "account_id").join(owners, "account_id").join(daily, "plan_uid", "left")
    return (
        solutions.join(plans, "plan_uid")
        .withColumn("department", normalize_department("department"))
        .withColumn("month_year", format_month("date"))
    )


def active_facts(month: DataFrame) -> DataFrame:
    """Of :func:`month_rows`: solutions in active use, of plans with enough revenue."""
    return month.where(F.col("in_plan") & (F.col("users_active") >= 1)).drop("in_plan")


def snapshot_facts(t: Tables, p: Params, accounts: DataFrame | list | None = None) -> DataFrame:
    """Active solutions of the snapshot month with account attributes and plan facts."""
    return active_facts(month_rows(t, p, accounts))


def with_container_apps(facts: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Joined rows per fact from the work apps valid in the snapshot month, by container."""
    valid = joins.workapps_valid_at(t.workapp_interval, p.snapshot)
    counted = valid.groupBy(F.col("container_uid").alias("solution_uid")).agg(F.count("*").alias("matches"))
    return _with_matches(facts, counted, ["solution_uid"]).withColumn("is_work_app", F.col("matched"))


def with_interval_apps(facts: DataFrame, t: Tables, p: Params) -> DataFrame:
    """Joined rows per fact from the work apps of the plan whose interval holds the date.

    All facts have the date of the snapshot, so the intervals are filtered by it in the scan; see
    :func:`vitalgauge.operators.joins.interval_match_counts` for many dates.
    """
    day = F.lit(p.snapshot)
    valid = t.workapp_interval.where((F.col("effective_from") <= day) & (F.col("effective_to") >= day))
    counted = joins.by_plan_key(valid).groupBy("plan_key").agg(F.count("*").alias("matches"))
    keyed = facts.withColumn("plan_key", plan_key("plan_uid"))
    return _with_matches(keyed, counted, ["plan_key"]).withColumn(
        "is_work_app", F.coalesce(contains_text("api_apps", WORK_APP), F.lit(False))
    )


def _with_matches(facts: DataFrame, counted: DataFrame, on: list[str]) -> DataFrame:
    return facts.join(counted, on, "left").withColumns(
        {"matched": F.col("matches").isNotNull(), "weight": F.coalesce("matches", F.lit(1))}
    )


def _has_text(column: str) -> Column:
    return F.coalesce(text_not_empty(column), F.lit(False))


def one_pass_account_month(facts: DataFrame, citizen_developers: bool) -> DataFrame:
    """All measures per account, from weighted facts.

    Counts and sums come from one grouping by the plan facts, whose few distinct rows per account
    then carry the distinct sums; owners and values are each made distinct before they are counted.
    """
    key = ["account_id"]
    solution = F.col("solution_uid").isNotNull()

    def solutions_where(condition: Column) -> Column:
        return weighted_count(condition & solution, "weight")

    counts = {
        "total_solutions_per_account": solutions_where(F.col("users_active") > 0),
        "external_integrations": solutions_where(_has_text("api_integrations")),
        "internal_integrations": solutions_where(_has_text("api_apps")),
        "solutions_with_hvt": solutions_where(F.col("users_hvt") > 0),
        "solutions_with_external_users": solutions_where(F.col("users_external") > 0),
        "unique_external_collaborators": weighted_count(F.col("users_collab_external").isNotNull(), "weight"),
        "solutions_created_last_90_days": solutions_where(F.col("quarters_active") == 1),
        "solutions_automation": solutions_where(F.col("workflows") > 0),
        "unique_internal_collaborators": weighted_count(F.col("users_collab_internal").isNotNull(), "weight"),
        "external_views_with_work_app": F.sum(
            F.when(F.col("is_work_app"), F.col("users_external_view") * F.col("weight")).otherwise(0)
        ),
    }
    active = sum_columns("users_collab_internal_active", "users_collab_external_active", "users_licensed_active")
    distinct_sums = {
        "total_licensed_users": F.col("users_licensed"),
        "total_active_licensed_users": F.col("users_licensed_active"),
        "total_internal_collaborators_active": F.col("users_collab_internal_active"),
        "total_external_collaborators_active": F.col("users_collab_external_active"),
        "total_internal_collaborators": F.col("users_collab_internal"),
        "total_external_collaborators": F.col("users_collab_external"),
        "total_active_users": active,
    }
    by_plan = (
        facts.groupBy(*key, *ATTRIBUTES, *PLAN_FACTS)
        .agg(*[agg.alias(name) for name, agg in counts.items()])
        .groupBy(*key, *ATTRIBUTES)
        .agg(
            *[F.sum_distinct(column).alias(name) for name, column in distinct_sums.items()],
            *[F.sum(name).alias(name) for name in counts],
        )
    )

    citizen = _has_text("api_integrations") | _has_text("api_apps")
    by_owner = (
        facts.where(F.col("owner_uid").isNotNull())
        .groupBy(*key, "owner_uid")
        .agg(F.max(citizen).alias("citizen"), F.max("power").alias("power"))
        .groupBy(*key)
        .agg(
            F.count("*").alias("unique_solution_owners"),
            F.count_if("power").alias("power_developers"),
            *([F.count_if("citizen").alias("citizen_developers_count")] if citizen_developers else []),
        )
    )

    hvt = F.col("users_hvt")
    by_value = (
        facts.select(*key, "users_hvt", "wt_complexity", "workflows")
        .distinct()
        .groupBy(*key)
        .agg(
            F.count_distinct(hvt).alias("unique_hvt_collaborators"),
            F.count_distinct(F.when(hvt > 0, hvt)).alias("unique_hvt_collaborators_per_solution"),
            F.expr("avg(DISTINCT wt_complexity)").alias("total_complexity_score"),
            F.sum_distinct("workflows").alias("total_workflows"),
        )
    )
    apps = count_distinct_if(facts, key, "solution_uid", {"work_app_count": F.col("is_work_app")})

    joined = by_plan.join(by_owner, key, "left").join(by_value, key, "left").join(apps, key, "left")
    zero_if_missing = ["unique_solution_owners", "power_developers", "work_app_count"]
    if citizen_developers:
        zero_if_missing.append("citizen_developers_count")
    return joined.fillna(0, subset=zero_if_missing)


def weighted_facts(t: Tables, p: Params, by: str, accounts: DataFrame | list | None = None) -> DataFrame:
    """What the measures read: facts of large accounts, weighted by the work apps they match, with ``power`` for
    owners of many solutions."""
    # Read three times: for the size of accounts, the totals of owners, and the facts themselves.
    month = share(month_rows(t, p, accounts).select(*MONTH_COLUMNS), "snapshot-month")
    facts = active_facts(month)
    large = accounts_over_n_solutions(month, p.accounts_over)
    power = owner_solution_counts(facts).where(F.col("total_solutions_per_owner") > p.power_owner_over)
    kept = filters.account_in(facts, large)
    weighted = with_container_apps(kept, t, p) if by == "container" else with_interval_apps(kept, t, p)
    power = power.select("owner_uid", F.lit(True).alias("power"))
    weighted = weighted.join(power, "owner_uid", "left").fillna(False, subset=["power"])
    # Four groupings read the weighted facts; the joins before them are made once.
    return share(weighted.select(*MEASURED), f"snapshot-{by}")


def account_month_snapshot(
    t: Tables, p: Params, by: str, accounts: DataFrame | list | None = None, require_mobile: bool = False
) -> DataFrame:
    """The snapshot; work apps are matched ``by="container"`` or ``by="interval"``."""
    weighted = weighted_facts(t, p, by, accounts)
    rows = one_pass_account_month(weighted, citizen_developers=by == "interval")

    addon = joins.presence(t.addon_plan, "account_id", "brandfolder_presence")
    kept_plans = filters.account_in(t.plan, weighted.select("account_id").distinct())
    users = joins.account_users(t.user_plan, kept_plans, t.session)
    return (
        joins.with_presence(rows, addon, "account_id", "brandfolder_presence")
        .withColumn("presence_of_rm_plan", F.col("brandfolder_presence"))
        .join(mobile_users_per_account(users, require_mobile), "account_id", "left")
    )
