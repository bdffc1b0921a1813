"""Checks of the ready-made scorecards against unrewritten joins and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.checks.registry import check
from vitalgauge.functions import SCORE_BANDS
from vitalgauge.operators.objects import OBJECT_KINDS, map_as_text
from vitalgauge.params import Params
from vitalgauge.plans import adoption, snapshot, work_grid
from vitalgauge.plans.kpis import EDITIONS, Edition
from vitalgauge.sources.shared import share
from vitalgauge.tables import Tables

# --- adoption -------------------------------------------------------------------------------------


def _window_metrics(edition: Edition) -> dict[str, str]:
    """Metric -> window expression over the joined rows."""

    def solutions(condition: str) -> str:
        return f"count(DISTINCT CASE WHEN {condition} THEN solution_uid END) OVER am"

    metrics = {
        "unique_solution_owners": "count(DISTINCT owner_uid) OVER am",
        "power_developers": "count(DISTINCT CASE WHEN owner_total > $power_owner_over THEN owner_uid END) OVER am",
        "total_solutions_per_account": "count(solution_uid) OVER am",
        "solutions_created_monthly": "count(solution_uid) OVER am",
        "external_integrations": solutions("external" if edition.integrations_by_flag else "api_integrations IS NOT NULL"),
        "internal_integrations": solutions("len(integrations) > 0" if edition.integrations_by_flag else "api_apps IS NOT NULL"),
        "solutions_with_hvt": solutions("users_hvt > 0"),
        "solutions_with_external_users": solutions("users_collab_external > 0"),
        "solutions_created_last_90_days": solutions("date >= $as_of - $days_back"),
        "solutions_with_automation": solutions("workflows > 0"),
        "unique_hvt_collaborators": "count(DISTINCT other_hvt) OVER am",
        "total_complexity_score": "sum(wt_complexity) OVER am",
        "total_workflows": "sum(workflows) OVER am",
        "unique_internal_collaborators": "count(DISTINCT users_collab_internal) OVER sol",
        "unique_external_collaborators": "count(DISTINCT users_collab_external) OVER sol",
        "num_departments_per_solution": "count(DISTINCT department) OVER sol",
        "brandfolder_presence": "max(CASE WHEN addon_account IS NULL THEN 0 ELSE 1 END) OVER acc",
    }
    if edition.work_apps:
        metrics["work_app_count"] = "count(DISTINCT container_uid) OVER sol_month"
        metrics["external_views_with_work_app"] = "count(DISTINCT owner_user_uid) OVER sol_month"
    if edition.mobile:
        metrics["mobile_users"] = "count(DISTINCT CASE WHEN mobile_sessions > 0 THEN mobile_user END) OVER am"
    return metrics


def _measured(edition: Edition) -> str:
    """Subqueries ``joined`` and ``measured``: all joins made row by row, all windows over them."""
    columns = ["s.*", "o.total_solutions_per_owner AS owner_total", "h.users_hvt AS other_hvt", "x.account_id AS addon_account"]
    joined = [
        "star s",
        "LEFT JOIN owner_totals o ON s.owner_uid = o.owner_uid",
        "LEFT JOIN hvt_rows h ON s.solution_uid = h.solution_uid AND s.account_id = h.account_id",
        "LEFT JOIN addon x ON s.account_id = x.account_id",
    ]
    if edition.work_apps:
        columns += ["w.container_uid", "w.owner_user_uid"]
        joined.append(
            "LEFT JOIN live_apps w ON CAST(s.plan_uid AS VARCHAR) = w.app_plan AND s.year = w.app_year"
            " AND s.month_calendar = w.app_month"
        )
    if edition.mobile == "prefix":
        columns += ["m.mobile_sessions", "m.user_uid AS mobile_user"]
        joined.append("LEFT JOIN prefix_sessions m ON s.plan_uid = m.plan_uid")
    if edition.mobile == "any_case":
        columns += ["m.mobile_sessions", "u.user_uid AS mobile_user"]
        joined.append("LEFT JOIN user_plan u ON s.plan_uid = u.plan_uid")
        joined.append("LEFT JOIN any_case_sessions m ON u.user_uid = m.user_uid")
    if edition.profile:
        columns += [
            "a.name AS account_name", "a.arr AS account_arr", "a.territory_type",
            "json_extract_string(a.company, '$$.industry') AS industry",
            "json_extract_string(a.company, '$$.subIndustry') AS sub_industry",
        ]
        joined.append("LEFT JOIN account a ON s.account_id = a.account_id")

    metrics = ", ".join(f"{expr} AS {name}" for name, expr in _window_metrics(edition).items())
    suffix = "_active" if edition.active_columns else ""
    return f"""
        WITH joined AS (SELECT {", ".join(columns)} FROM {" ".join(joined)}),
        measured AS (
            SELECT *, {metrics},
                   users_collab_internal{suffix} + users_collab_external{suffix} AS total_active_users
            FROM joined
            WINDOW am AS (PARTITION BY account_id, year_month), sol AS (PARTITION BY solution_uid),
                   sol_month AS (PARTITION BY solution_uid, year, month_calendar), acc AS (PARTITION BY account_id))"""


def _adoption_oracle(edition: Edition) -> str:
    profile = (
        ", max(account_name) AS account_name, round(CAST(max(account_arr) AS DOUBLE), 6) AS account_arr,"
        " max(territory_type) AS territory_type, max(industry) AS industry, max(sub_industry) AS sub_industry"
        if edition.profile
        else ""
    )

    def raw(kpi) -> str:
        if kpi.denominator is None:
            return f"max({kpi.numerator})"
        value = "CASE WHEN solutions_with_automation > 0 THEN 1 ELSE 0 END" if kpi.numerator == "automated_rows" else kpi.numerator
        return f"sum({value}) / nullif(sum({kpi.denominator}), 0)"

    outputs = []
    for k in edition.kpis:
        if k.denominator is None:
            outputs.append(f"raw_{k.name} AS {k.name}")
        else:
            outputs.append(f"round(raw_{k.name} * {k.scale}, 6) AS {k.name}")
        if edition.ranked:
            outputs.append(f"round(rank_{k.name}, 6) AS pct_rank_{k.short}")
            bands = " ".join(f"WHEN rank_{k.name} >= {low} THEN {points}" for low, points in SCORE_BANDS)
            outputs.append(f"CASE {bands} WHEN rank_{k.name} > 0 THEN 1 ELSE 0 END AS score_{k.short}")
    ranks = ", ".join(
        f"percent_rank() OVER (ORDER BY raw_{k.name} NULLS LAST) AS rank_{k.name}" for k in edition.kpis
    )
    return f"""{_measured(edition)},
        grouped AS (
            SELECT account_id, year_fiscal, year, month_calendar, year_month,
                   CAST(sum(users_licensed) AS DOUBLE) AS total_licensed_users,
                   CAST(sum(users_licensed_active) AS DOUBLE) AS total_active_licensed_users,
                   CAST(sum(users_collab_internal) AS DOUBLE) AS total_internal_collaborators,
                   CAST(sum(users_collab_external) AS DOUBLE) AS total_external_collaborators,
                   CAST(sum(measured.total_active_users) AS DOUBLE) AS total_users{profile},
                   {", ".join(f"{raw(k)} AS raw_{k.name}" for k in edition.kpis)}
            FROM measured GROUP BY account_id, year_fiscal, year, month_calendar, year_month),
        ranked AS (SELECT *, {ranks} FROM grouped)
        SELECT account_id, year_fiscal, year, month_calendar, year_month, total_licensed_users,
               total_active_licensed_users, total_internal_collaborators, total_external_collaborators,
               total_users AS total_active_users,
               {"account_name, account_arr, territory_type, industry, sub_industry," if edition.profile else ""}
               {", ".join(outputs)}
        FROM ranked"""


def _register_adoption(edition: Edition) -> None:
    def build(t: Tables, p: Params) -> DataFrame:
        return adoption.adoption_scorecard(t, p, edition)

    check(edition.name, _adoption_oracle(edition))(build)


for _edition in EDITIONS.values():
    _register_adoption(_edition)


_V1, _FLAGSHIP = EDITIONS["adoption_kpis_v1"], EDITIONS["adoption_scorecard_mobile"]
_COUNTS = [
    "unique_solution_owners", "power_developers", "total_solutions_per_account", "external_integrations",
    "internal_integrations", "solutions_with_hvt", "solutions_with_external_users", "solutions_created_last_90_days",
    "solutions_with_automation", "unique_hvt_collaborators", "total_complexity_score", "total_workflows",
    "brandfolder_presence",
]


def _counts_oracle(edition: Edition, counts: list[str]) -> str:
    return f"""{_measured(edition)}
        SELECT DISTINCT account_id, date,
               {", ".join(f"CAST(measured.{c} AS BIGINT) AS {c}" for c in counts)} FROM measured"""


def _counts(t: Tables, p: Params, edition: Edition, counts: list[str]) -> DataFrame:
    rows = adoption.account_month_metrics(t, p, edition).withColumns(
        {"total_complexity_score": F.col("wt_complexity"), "total_workflows": F.col("workflows")}
    )
    return rows.select("account_id", "date", *[F.col(c).cast("bigint").alias(c) for c in counts])


@check("account_month_metrics_v1", _counts_oracle(_V1, _COUNTS))
def account_month_metrics_v1(t: Tables, p: Params) -> DataFrame:
    return _counts(t, p, _V1, _COUNTS)


@check("account_month_metrics", _counts_oracle(_FLAGSHIP, [*_COUNTS, "mobile_users"]))
def account_month_metrics(t: Tables, p: Params) -> DataFrame:
    return _counts(t, p, _FLAGSHIP, [*_COUNTS, "mobile_users"])


@check(
    "solution_metrics",
    f"""{_measured(_FLAGSHIP)}
        SELECT DISTINCT solution_uid, date, unique_internal_collaborators, unique_external_collaborators,
               num_departments_per_solution, work_app_count, external_views_with_work_app FROM measured""",
)
def solution_metrics(t: Tables, p: Params) -> DataFrame:
    activity = share(adoption.solution_activity(t, p, _FLAGSHIP), "solution-metrics")
    names = activity.select("solution_key", "solution_uid").distinct()
    return adoption.solution_metrics(activity, t, p, _FLAGSHIP).join(names, "solution_key").drop("solution_key")


# --- one-month snapshot ---------------------------------------------------------------------------


def _snapshot_oracle(by: str) -> str:
    if by == "container":
        apps = """LEFT JOIN (SELECT DISTINCT container_uid, owner_plan_uid, owner_user_uid FROM workapp_interval
                             WHERE status = 'Active' AND effective_from <= $snapshot
                               AND (effective_to IS NULL OR effective_to >= $snapshot)) w
                    ON w.container_uid = f.solution_uid"""
        is_app, citizen = "w.container_uid IS NOT NULL", ""
    else:
        apps = """LEFT JOIN keyed_apps w ON w.app_plan = CAST(f.plan_uid AS VARCHAR)
                                              AND f.date BETWEEN w.effective_from AND w.effective_to"""
        is_app = "position('WorkApps' IN f.api_apps) > 0"
        citizen = """count(DISTINCT CASE WHEN len(f.api_integrations) > 0 OR len(f.api_apps) > 0 THEN f.owner_uid END)
                         AS citizen_developers_count,"""

    def distinct_sum(column: str, name: str) -> str:
        return f"CAST(sum(DISTINCT {column}) AS BIGINT) AS {name},"

    def solutions(condition: str, name: str) -> str:
        return f"count(CASE WHEN {condition} THEN f.solution_uid END) AS {name},"

    return f"""
        WITH owner_rows AS (SELECT owner_uid, count(solution_uid) AS n FROM snap GROUP BY owner_uid),
        account_mobile AS (SELECT account_id, count(DISTINCT user_uid) AS n FROM user_accounts GROUP BY account_id)
        SELECT f.account_id, strftime(f.date, '%Y-%m') AS month_year, f.account_name,
               CAST(f.account_arr AS DOUBLE) AS account_arr, f.territory_type, f.industry, f.sub_industry,
               {distinct_sum("f.users_licensed", "total_licensed_users")}
               {distinct_sum("f.users_licensed_active", "total_active_licensed_users")}
               {distinct_sum("f.users_collab_internal_active", "total_internal_collaborators_active")}
               {distinct_sum("f.users_collab_external_active", "total_external_collaborators_active")}
               {distinct_sum("f.users_collab_internal", "total_internal_collaborators")}
               {distinct_sum("f.users_collab_external", "total_external_collaborators")}
               {distinct_sum("f.users_collab_internal_active + f.users_collab_external_active + f.users_licensed_active",
                             "total_active_users")}
               {distinct_sum("f.workflows", "total_workflows")}
               {solutions("f.users_active > 0", "total_solutions_per_account")}
               {solutions("len(f.api_integrations) > 0", "external_integrations")}
               {solutions("len(f.api_apps) > 0", "internal_integrations")}
               {solutions("f.users_hvt > 0", "solutions_with_hvt")}
               {solutions("f.users_external > 0", "solutions_with_external_users")}
               {solutions("f.quarters_active = 1", "solutions_created_last_90_days")}
               {solutions("f.workflows > 0", "solutions_automation")}
               {citizen}
               count(DISTINCT f.owner_uid) AS unique_solution_owners,
               count(DISTINCT CASE WHEN o.n > $power_owner_over THEN f.owner_uid END) AS power_developers,
               count(DISTINCT CASE WHEN f.users_hvt > 0 THEN f.users_hvt END) AS unique_hvt_collaborators_per_solution,
               count(DISTINCT f.users_hvt) AS unique_hvt_collaborators,
               count(f.users_collab_external) AS unique_external_collaborators,
               count(f.users_collab_internal) AS unique_internal_collaborators,
               round(avg(DISTINCT f.wt_complexity), 6) AS total_complexity_score,
               max(CASE WHEN x.account_id IS NULL THEN 0 ELSE 1 END) AS brandfolder_presence,
               max(CASE WHEN x.account_id IS NULL THEN 0 ELSE 1 END) AS presence_of_rm_plan,
               max(u.n) AS mobile_users_count,
               count(DISTINCT CASE WHEN {is_app} THEN f.solution_uid END) AS work_app_count,
               CAST(sum(CASE WHEN {is_app} THEN f.users_external_view ELSE 0 END) AS BIGINT) AS external_views_with_work_app
        FROM snap f JOIN crowded c ON f.account_id = c.account_id
        LEFT JOIN owner_rows o ON f.owner_uid = o.owner_uid
        LEFT JOIN addon x ON f.account_id = x.account_id
        LEFT JOIN account_mobile u ON f.account_id = u.account_id
        {apps}
        GROUP BY f.account_id, month_year, f.account_name, f.account_arr, f.territory_type, f.industry, f.sub_industry"""


@check("account_month_snapshot_container", _snapshot_oracle("container"))
def account_month_snapshot_container(t: Tables, p: Params) -> DataFrame:
    return snapshot.account_month_snapshot(t, p, "container")


@check("account_month_snapshot_interval", _snapshot_oracle("interval"))
def account_month_snapshot_interval(t: Tables, p: Params) -> DataFrame:
    return snapshot.account_month_snapshot(t, p, "interval")


# --- names of single operators that only occur inside a plan ---------------------------------------


#: Columns of the snapshot that come from other tables than its facts.
_BESIDE = "brandfolder_presence, presence_of_rm_plan, mobile_users_count"


@check("one_pass_account_month", f"SELECT * EXCLUDE ({_BESIDE}) FROM ({_snapshot_oracle('interval')})")
def one_pass_account_month(t: Tables, p: Params) -> DataFrame:
    return snapshot.one_pass_account_month(snapshot.weighted_facts(t, p, "interval"), citizen_developers=True)


_ROLLUP = [k.name for k in EDITIONS["adoption_scorecard_mobile"].kpis]


@check(
    "kpi_rollup",
    f"SELECT account_id, year_month, {', '.join(_ROLLUP)} FROM ({_adoption_oracle(EDITIONS['adoption_scorecard_mobile'])})",
)
def kpi_rollup(t: Tables, p: Params) -> DataFrame:
    edition = EDITIONS["adoption_scorecard_mobile"]
    scaled = [(F.col(k.name) * k.scale).alias(k.name) if k.scale != 1 else F.col(k.name) for k in edition.kpis]
    return adoption.kpi_ratios(t, p, edition).select("account_id", "year_month", *scaled)


# --- grid -----------------------------------------------------------------------------------------

_GRID_KEYS = ("account_id", "date", "name", "plan_arr", "arr", "partner_since", "account_name_ppid")
_GRID_MEASURES = [
    *work_grid.ACCOUNT_FACTS, *work_grid.PLAN_SUMS, "quarters_active", *work_grid.WORK_TYPE_SUMS,
]


def _grid_oracle() -> str:
    matches = " AND ".join(f"n.{k} = f.{k}" for k in _GRID_KEYS)
    return f"""
        WITH facts AS (
            SELECT g.*, o.premium_apps, o.integrations, o.connectors, o.assets
            FROM object_texts o JOIN grid_agg g
              ON o.account_id = g.account_id AND o.work_type = g.work_type AND o.date = g.date),
        row_names AS (
            SELECT DISTINCT account_id, date, name, coalesce(plan_arr, 0) AS plan_arr, coalesce(arr, 0) AS arr,
                   session_first, first_paid, partner_since, account_name_ppid
            FROM grid_agg WHERE date >= CAST($as_of - INTERVAL $months_back MONTH AS DATE)),
        types AS (SELECT DISTINCT work_type FROM grid_agg)
        SELECT n.account_id, n.date, n.name, round(CAST(n.plan_arr AS DOUBLE), 6) AS plan_arr,
               round(CAST(n.arr AS DOUBLE), 6) AS arr, n.partner_since, n.account_name_ppid, n.session_first,
               n.first_paid, t.work_type, {", ".join(f"f.{m}" for m in _GRID_MEASURES)},
               {", ".join(f"f.{k}" for k in OBJECT_KINDS)}
        FROM row_names n CROSS JOIN types t
        LEFT JOIN facts f ON {matches} AND t.work_type = f.work_type"""


@check("work_type_monthly_grid", _grid_oracle())
def work_type_monthly_grid(t: Tables, p: Params) -> DataFrame:
    grid = work_grid.newest_first(work_grid.work_type_monthly_grid(t, p))
    return grid.withColumns({kind: map_as_text(kind) for kind in OBJECT_KINDS})
