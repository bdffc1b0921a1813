"""Checks of aggregates, partition aggregates, ranks and scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.checks.registry import check
from vitalgauge.checks.relational import usable_solutions
from vitalgauge.functions import band_score, days_before, safe_ratio
from vitalgauge.operators import aggregates, filters, joins, windows
from vitalgauge.operators.objects import OBJECT_KINDS
from vitalgauge.operators.ranks import percent_ranks, with_ranks_and_scores
from vitalgauge.params import Params
from vitalgauge.plans import adoption, work_grid
from vitalgauge.plans.kpis import EDITIONS
from vitalgauge.sources.shared import share
from vitalgauge.tables import Tables

ACCOUNT_MONTH = ["account_id", "year_month"]


# --- aggregates -----------------------------------------------------------------------------------


@check(
    "account_arr_having",
    "SELECT account_id, round(CAST(total_arr AS DOUBLE), 6) AS total_arr FROM rich",
)
def account_arr_having(t: Tables, p: Params) -> DataFrame:
    daily = joins.plan_daily_with_account(t.plan_daily, filters.filtered_plans(t.plan))
    return aggregates.account_arr_having(daily, p.min_account_plan_arr)


@check("accounts_over_n_solutions", "SELECT account_id, solution_count FROM crowded")
def accounts_over_n_solutions(t: Tables, p: Params) -> DataFrame:
    in_month = aggregates.snapshot_solutions(
        t.solution_monthly, t.plan, t.account, p.snapshot, p.min_account_arr_snapshot
    )
    return aggregates.accounts_over_n_solutions(in_month, p.accounts_over)


@check("owner_solution_counts", "SELECT owner_uid, total_solutions_per_owner FROM owner_totals")
def owner_solution_counts(t: Tables, p: Params) -> DataFrame:
    return aggregates.owner_solution_counts(usable_solutions(t, p))


@check(
    "count_distinct_sessions",
    "SELECT user_uid, mobile_sessions FROM any_case_sessions",
)
def count_distinct_sessions(t: Tables, p: Params) -> DataFrame:
    return joins.mobile_session_counts(t.session, any_case=True)


@check(
    "mobile_users_per_account",
    "SELECT account_id, count(DISTINCT user_uid) AS mobile_users_count FROM user_accounts GROUP BY account_id",
)
def mobile_users_per_account(t: Tables, p: Params) -> DataFrame:
    return aggregates.mobile_users_per_account(joins.account_users(t.user_plan, t.plan, t.session))


@check(
    "distinct_sum_avg",
    """SELECT account_id, CAST(sum(DISTINCT users_licensed) AS BIGINT) AS total_licensed_users,
              CAST(sum(DISTINCT users_collab_internal_active + users_collab_external_active + users_licensed_active)
                   AS BIGINT) AS total_active_users,
              round(avg(DISTINCT wt_complexity), 6) AS avg_complexity
       FROM star GROUP BY account_id""",
)
def distinct_sum_avg(t: Tables, p: Params) -> DataFrame:
    active = F.col("users_collab_internal_active") + F.col("users_collab_external_active") + F.col("users_licensed_active")
    return adoption.star_rows(t, p).groupBy("account_id").agg(
        F.sum_distinct("users_licensed").alias("total_licensed_users"),
        F.sum_distinct(active).alias("total_active_users"),
        F.expr("avg(DISTINCT wt_complexity)").alias("avg_complexity"),
    )


@check(
    "conditional_counts",
    """SELECT account_id, count(CASE WHEN users_hvt > 0 THEN solution_uid END) AS hvt_rows,
              count(DISTINCT CASE WHEN workflows > 0 THEN solution_uid END) AS automated_solutions,
              count(DISTINCT CASE WHEN len(api_apps) > 0 THEN solution_uid END) AS solutions_with_apps,
              CAST(sum(CASE WHEN external THEN users_external_view ELSE 0 END) AS BIGINT) AS external_views
       FROM star GROUP BY account_id""",
)
def conditional_counts(t: Tables, p: Params) -> DataFrame:
    rows = adoption.star_rows(t, p)
    sums = rows.groupBy("account_id").agg(
        F.count(F.when(F.col("users_hvt") > 0, F.col("solution_uid"))).alias("hvt_rows"),
        F.sum(F.when(F.col("external"), F.col("users_external_view")).otherwise(0)).alias("external_views"),
    )
    distinct = windows.count_distinct_if(
        rows, ["account_id"], "solution_uid",
        {"automated_solutions": F.col("workflows") > 0, "solutions_with_apps": F.length("api_apps") > 0},
    )
    return sums.join(distinct, "account_id")


@check(
    "safe_ratio",
    """SELECT account_id, year_month,
              round(sum(users_collab_internal_active) /
                    nullif(sum(users_collab_internal_active + users_collab_external_active), 0) * 100, 6) AS pct_internal,
              round(sum(users_licensed_active) / nullif(sum(users_licensed), 0), 6) AS licensed_ratio
       FROM star GROUP BY account_id, year_month""",
)
def safe_ratios(t: Tables, p: Params) -> DataFrame:
    active = F.col("users_collab_internal_active") + F.col("users_collab_external_active")
    return adoption.star_rows(t, p).groupBy(*ACCOUNT_MONTH).agg(
        safe_ratio(F.sum("users_collab_internal_active"), F.sum(active), 100).alias("pct_internal"),
        safe_ratio(F.sum("users_licensed_active"), F.sum("users_licensed")).alias("licensed_ratio"),
    )


@check(
    "max_as_any_value",
    """SELECT s.account_id, max(a.name) AS account_name, round(CAST(max(a.arr) AS DOUBLE), 6) AS account_arr,
              max(a.territory_type) AS territory_type, max(json_extract_string(a.company, '$$.industry')) AS industry,
              max(json_extract_string(a.company, '$$.subIndustry')) AS sub_industry
       FROM star s LEFT JOIN account a ON s.account_id = a.account_id GROUP BY s.account_id""",
)
def max_as_any_value(t: Tables, p: Params) -> DataFrame:
    seen = adoption.star_rows(t, p).select("account_id").distinct()
    return seen.join(adoption.account_profile(t.account), "account_id", "left")


@check(
    "plan_to_account_rollup",
    """SELECT work_type, account_id, name, date, round(CAST(arr AS DOUBLE), 6) AS arr,
              round(CAST(plan_arr AS DOUBLE), 6) AS plan_arr, plan_first_paid, licenses, users_licensed,
              quarters_active, days_edit, users_active, users_view, days_view_non_hvt FROM grid_data""",
)
def plan_to_account_rollup(t: Tables, p: Params) -> DataFrame:
    paying = joins.paying_plan_months(t.plan_daily, t.plan, t.account)
    rollup = aggregates.plan_to_account_rollup(
        t.solution_plan_monthly, aggregates.account_month_rollup(paying), p.min_account_arr_grid
    )
    return rollup.select(
        "work_type", "account_id", "name", "date", "arr", "plan_arr", "plan_first_paid", "licenses",
        "users_licensed", "quarters_active", "days_edit", "users_active", "users_view", "days_view_non_hvt",
    )


@check(
    "grouped_distinct_rows",
    "SELECT container_uid, owner_plan_uid, owner_user_uid FROM workapp_interval WHERE status = 'Active' GROUP BY ALL",
)
def grouped_distinct_rows(t: Tables, p: Params) -> DataFrame:
    return filters.active_workapps(t.workapp_interval).select(
        "container_uid", "owner_plan_uid", "owner_user_uid"
    ).distinct()


@check("object_agg", "SELECT account_id, date, work_type, kind, key, value FROM active_objects")
def object_agg(t: Tables, p: Params) -> DataFrame:
    # The maps are built, then listed again as rows.
    maps = work_grid.object_data(t)
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("object")) for k in OBJECT_KINDS])
    return maps.select(*work_grid.OBJECT_KEYS, F.explode(kinds).alias("o")).select(
        *work_grid.OBJECT_KEYS, "o.kind", F.explode("o.object").alias("key", "value")
    )


@check("string_agg_label", "SELECT account_id, name, account_name_ppid FROM labels")
def string_agg_label(t: Tables, p: Params) -> DataFrame:
    return aggregates.string_agg_label(t.solution_plan_monthly, t.plan, t.account, p.min_account_arr_grid)


# --- partition aggregates -------------------------------------------------------------------------


@check(
    "windowed_count_sum",
    """SELECT account_id, year_month, solution_uid, plan_uid,
              count(solution_uid) OVER am AS total_solutions_per_account,
              CAST(sum(wt_complexity) OVER am AS BIGINT) AS total_complexity_score,
              CAST(sum(workflows) OVER am AS BIGINT) AS total_workflows
       FROM star WINDOW am AS (PARTITION BY account_id, year_month)""",
)
def windowed_count_sum(t: Tables, p: Params) -> DataFrame:
    return windows.over_partition(
        adoption.star_rows(t, p), ACCOUNT_MONTH,
        total_solutions_per_account=F.count("solution_uid"),
        total_complexity_score=F.sum("wt_complexity"),
        total_workflows=F.sum("workflows"),
    ).select(
        *ACCOUNT_MONTH, "solution_uid", "plan_uid", "total_solutions_per_account", "total_complexity_score",
        "total_workflows",
    )


@check(
    "windowed_count_distinct",
    """SELECT account_id, year_month, solution_uid, plan_uid,
              count(DISTINCT owner_uid) OVER (PARTITION BY account_id, year_month) AS unique_solution_owners,
              count(DISTINCT users_collab_internal) OVER (PARTITION BY solution_uid) AS unique_internal_collaborators,
              count(DISTINCT users_collab_external) OVER (PARTITION BY solution_uid) AS unique_external_collaborators
       FROM star""",
)
def windowed_count_distinct(t: Tables, p: Params) -> DataFrame:
    rows = windows.over_partition(
        adoption.star_rows(t, p), ACCOUNT_MONTH, unique_solution_owners=F.count_distinct("owner_uid")
    )
    return windows.over_partition(
        rows, ["solution_uid"],
        unique_internal_collaborators=F.count_distinct("users_collab_internal"),
        unique_external_collaborators=F.count_distinct("users_collab_external"),
    ).select(
        *ACCOUNT_MONTH, "solution_uid", "plan_uid", "unique_solution_owners", "unique_internal_collaborators",
        "unique_external_collaborators",
    )


@check(
    "windowed_conditional_distinct",
    """SELECT account_id, year_month, solution_uid, plan_uid,
              count(DISTINCT CASE WHEN users_hvt > 0 THEN solution_uid END) OVER am AS solutions_with_hvt,
              count(DISTINCT CASE WHEN users_collab_external > 0 THEN solution_uid END) OVER am
                  AS solutions_with_external_users,
              count(DISTINCT CASE WHEN api_integrations IS NOT NULL THEN solution_uid END) OVER am
                  AS external_integrations,
              count(DISTINCT CASE WHEN len(integrations) > 0 THEN solution_uid END) OVER am AS internal_integrations,
              count(DISTINCT CASE WHEN date >= $as_of - $days_back THEN solution_uid END) OVER am
                  AS solutions_created_last_90_days,
              count(DISTINCT CASE WHEN workflows > 0 THEN solution_uid END) OVER am AS automation_count,
              count(DISTINCT CASE WHEN department IS NOT NULL THEN department END) OVER (PARTITION BY solution_uid)
                  AS num_departments_per_solution
       FROM star WINDOW am AS (PARTITION BY account_id, year_month)""",
)
def windowed_conditional_distinct(t: Tables, p: Params) -> DataFrame:
    conditions = {
        "solutions_with_hvt": F.col("users_hvt") > 0,
        "solutions_with_external_users": F.col("users_collab_external") > 0,
        "external_integrations": F.col("api_integrations").isNotNull(),
        "internal_integrations": F.array_size("integrations") > 0,
        "solutions_created_last_90_days": F.col("date") >= days_before(p.as_of, p.days_back),
        "automation_count": F.col("workflows") > 0,
    }
    rows = windows.count_distinct_if_over(adoption.star_rows(t, p), ACCOUNT_MONTH, "solution_uid", conditions)
    rows = windows.over_partition(
        rows, ["solution_uid"], num_departments_per_solution=F.count_distinct("department")
    )
    return rows.select(
        *ACCOUNT_MONTH, "solution_uid", "plan_uid", *conditions, "num_departments_per_solution"
    )


@check(
    "windowed_max_attr",
    """SELECT s.account_id, s.year_month, s.solution_uid,
              max(CASE WHEN x.account_id IS NULL THEN 0 ELSE 1 END) OVER acc AS brandfolder_presence,
              max(a.name) OVER acc AS account_name, max(a.territory_type) OVER acc AS territory_type
       FROM star s LEFT JOIN account a ON s.account_id = a.account_id LEFT JOIN addon x ON s.account_id = x.account_id
       WINDOW acc AS (PARTITION BY s.account_id)""",
)
def windowed_max_attr(t: Tables, p: Params) -> DataFrame:
    # Attributes of the account, so they are taken from the account table rather than from its rows.
    present = joins.presence(t.addon_plan, "account_id", "brandfolder_presence")
    profile = adoption.account_profile(t.account).select("account_id", "account_name", "territory_type")
    rows = adoption.star_rows(t, p).select(*ACCOUNT_MONTH, "solution_uid")
    return joins.with_presence(rows.join(profile, "account_id", "left"), present, "account_id", "brandfolder_presence")


@check(
    "windowed_ratio",
    """SELECT DISTINCT s.account_id, s.year_month,
              round(count(DISTINCT CASE WHEN m.mobile_sessions > 0 THEN m.user_uid END) OVER am
                    / nullif(count(DISTINCT s.users_licensed_active) OVER am, 0) * 100, 6)
                  AS pct_active_users_mobile_sessions
       FROM star s LEFT JOIN prefix_sessions m ON s.plan_uid = m.plan_uid
       WINDOW am AS (PARTITION BY s.account_id, s.year_month)""",
)
def windowed_ratio(t: Tables, p: Params) -> DataFrame:
    rows = adoption.star_rows(t, p)
    key = [*ACCOUNT_MONTH, "date"]
    licensed = rows.groupBy(*key).agg(F.count_distinct("users_licensed_active").alias("licensed"))
    users = adoption.user_metrics(rows, adoption.edition_users(t, EDITIONS["adoption_scorecard_mobile"]))
    return licensed.join(users, ["account_id", "date"], "left").select(
        *ACCOUNT_MONTH,
        safe_ratio(F.coalesce("mobile_users", F.lit(0)), "licensed", 100).alias("pct_active_users_mobile_sessions"),
    )


# --- ranks and scores -----------------------------------------------------------------------------

_RATIOS = """SELECT s.account_id, s.year_month,
        sum(users_licensed_active) / nullif(sum(users_licensed), 0) AS licensed_users,
        sum(users_collab_internal_active) / nullif(sum(users_collab_internal_active + users_collab_external_active), 0)
            AS internal_collaborator,
        max(CASE WHEN x.account_id IS NULL THEN 0 ELSE 1 END) AS brandfolder_presence
    FROM star s LEFT JOIN addon x ON s.account_id = x.account_id GROUP BY s.account_id, s.year_month"""


def _ratios(t: Tables, p: Params) -> DataFrame:
    active = F.col("users_collab_internal_active") + F.col("users_collab_external_active")
    rows = adoption.star_rows(t, p).groupBy(*ACCOUNT_MONTH).agg(
        safe_ratio(F.sum("users_licensed_active"), F.sum("users_licensed")).alias("licensed_users"),
        safe_ratio(F.sum("users_collab_internal_active"), F.sum(active)).alias("internal_collaborator"),
    )
    present = joins.presence(t.addon_plan, "account_id", "brandfolder_presence")
    return share(joins.with_presence(rows, present, "account_id", "brandfolder_presence"), "ratios")


@check(
    "percent_rank_kpi",
    f"""WITH r AS ({_RATIOS})
        SELECT account_id, year_month, 'licensed_users' AS measure, round(licensed_users, 6) AS value,
               round(percent_rank() OVER (ORDER BY licensed_users NULLS LAST), 6) AS pct_rank FROM r
        UNION ALL
        SELECT account_id, year_month, 'internal_collaborator', round(internal_collaborator, 6),
               round(percent_rank() OVER (ORDER BY internal_collaborator NULLS LAST), 6) FROM r""",
)
def percent_rank_kpi(t: Tables, p: Params) -> DataFrame:
    return percent_ranks(_ratios(t, p), ACCOUNT_MONTH, ["licensed_users", "internal_collaborator"])


@check(
    "percent_rank_presence",
    f"""WITH r AS ({_RATIOS})
        SELECT account_id, year_month, brandfolder_presence,
               round(percent_rank() OVER (ORDER BY brandfolder_presence NULLS LAST), 6) AS pct_rank FROM r""",
)
def percent_rank_presence(t: Tables, p: Params) -> DataFrame:
    ranks = percent_ranks(_ratios(t, p), ACCOUNT_MONTH, ["brandfolder_presence"])
    return ranks.select(*ACCOUNT_MONTH, F.col("value").cast("int").alias("brandfolder_presence"), "pct_rank")


@check(
    "banded_score",
    f"""WITH r AS ({_RATIOS}),
        k AS (SELECT account_id, year_month,
                     percent_rank() OVER (ORDER BY licensed_users NULLS LAST) AS a,
                     percent_rank() OVER (ORDER BY internal_collaborator NULLS LAST) AS b,
                     percent_rank() OVER (ORDER BY brandfolder_presence NULLS LAST) AS c FROM r)
        SELECT account_id, year_month,
               """ + ", ".join(
        f"""CASE WHEN {rank} >= 0.90 THEN 7 WHEN {rank} >= 0.70 THEN 4 WHEN {rank} >= 0.35 THEN 3
                 WHEN {rank} > 0 THEN 1 ELSE 0 END AS score_{name}"""
        for rank, name in (("a", "licensed_users"), ("b", "internal_collaborator"), ("c", "brandfolder_presence"))
    ) + " FROM k",
)
def banded_score(t: Tables, p: Params) -> DataFrame:
    names = ["licensed_users", "internal_collaborator", "brandfolder_presence"]
    scored = with_ranks_and_scores(_ratios(t, p), ACCOUNT_MONTH, {n: n for n in names})
    return scored.select(*ACCOUNT_MONTH, *[band_score(f"pct_rank_{n}").alias(f"score_{n}") for n in names])
