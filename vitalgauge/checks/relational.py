"""Checks of scans, sinks, filters and joins."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.checks.registry import check
from vitalgauge.functions import (
    band_score,
    case_flag,
    coalesce_first,
    plan_key,
    safe_ratio,
)
from vitalgauge.operators import distincts, filters, intervals, joins, skew, state
from vitalgauge.operators.aggregates import owner_solution_counts, snapshot_solutions, weighted_sum
from vitalgauge.operators.objects import OBJECT_KINDS, map_as_text
from vitalgauge.operators.ranks import with_ranks_and_scores
from vitalgauge.params import Params
from vitalgauge.plans import adoption, snapshot, work_grid
from vitalgauge.plans.kpis import EDITIONS
from vitalgauge.sources import layout
from vitalgauge.sources.shared import share, shared_path
from vitalgauge.sources.sink import replace_months, write_by_month
from vitalgauge.tables import TABLE_COLUMNS, Tables


def usable_solutions(t: Tables, p: Params) -> DataFrame:
    return filters.filtered_solutions(t.solution_monthly, p.as_of)


# --- scans and sinks ------------------------------------------------------------------------------


@check(
    "scan_tables",
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TABLE_COLUMNS),
)
def scan_tables(t: Tables, p: Params) -> DataFrame:
    counts = [t[n].agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in TABLE_COLUMNS]
    return functools.reduce(DataFrame.unionByName, counts)


@check("session_preview", "SELECT session_uid, user_uid, device FROM session ORDER BY session_uid LIMIT 50")
def session_preview(t: Tables, p: Params) -> DataFrame:
    return t.session.orderBy("session_uid").limit(50)


@check(
    "scorecard_sink",
    """SELECT account_id, year_month, CAST(sum(users_licensed) AS BIGINT) AS licensed, count(*) AS solution_rows
       FROM star GROUP BY account_id, year_month""",
)
def scorecard_sink(t: Tables, p: Params) -> DataFrame:
    rows = adoption.star_rows(t, p).groupBy("account_id", "year_month").agg(
        F.sum("users_licensed").alias("licensed"), F.count("*").alias("solution_rows")
    )
    path = shared_path(rows.sparkSession, "scorecard")
    write_by_month(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@check(
    "scorecard_replace_month",
    """SELECT account_id, year_month, CAST(sum(users_licensed) AS BIGINT) AS licensed, count(*) AS solution_rows
       FROM star GROUP BY account_id, year_month""",
)
def scorecard_replace_month(t: Tables, p: Params) -> DataFrame:
    """Written with one month wrong and one missing; both are then replaced, the first of them twice."""
    rows = adoption.star_rows(t, p).groupBy("account_id", "year_month").agg(
        F.sum("users_licensed").alias("licensed"), F.count("*").alias("solution_rows")
    )
    rows = share(rows, "scorecard-rows")
    spark, path = rows.sparkSession, shared_path(rows.sparkSession, "scorecard")
    last, first = (f"{year_month:%Y-%m}" for year_month in (p.as_of - dt.timedelta(40), p.as_of - dt.timedelta(100)))
    wrong = rows.where(F.col("year_month") != first).withColumn("licensed", F.col("licensed") + F.when(F.col("year_month") == last, 1).otherwise(0))
    write_by_month(wrong, path)
    for run, month in (("a", last), ("a", last), ("b", first)):
        replace_months(rows, path, [month], run)
    return spark.read.schema(rows.schema).parquet(path)


@check(
    "totals_from_state",
    """SELECT 'account' AS kind, account_id AS id, round(CAST(sum(plan_arr) AS DOUBLE), 6) AS total FROM daily GROUP BY account_id
       UNION ALL SELECT 'owner', owner_uid, CAST(total_solutions_per_owner AS DOUBLE) FROM owner_totals""",
)
def totals_from_state(t: Tables, p: Params) -> DataFrame:
    """All-time sums from stored months: history up to the snapshot first, then the months after it, the snapshot's again."""
    plans = filters.filtered_plans(t.plan)
    facts = {
        "account": (state.ACCOUNT_ARR, joins.plan_daily_with_account(t.plan_daily, plans)),
        "owner": (state.OWNER_SOLUTIONS, usable_solutions(t, p)),
    }
    out = []
    for kind, (kept, rows) in facts.items():
        spark, path = rows.sparkSession, shared_path(rows.sparkSession, f"state-{kind}")
        kept.begin(rows.where(F.col("date") <= F.lit(p.snapshot)), path)
        later = rows.where(F.col("date") > F.lit(p.snapshot)).select("date").distinct().collect()  # a row per month
        kept.update(rows, path, [p.snapshot, *(r["date"] for r in later)], "later")
        (key,), (total,) = kept.keys, kept.sums
        totals = kept.totals(kept.read(spark, path))
        out.append(totals.select(F.lit(kind).alias("kind"), F.col(key).alias("id"), F.col(total).cast("double").alias("total")))
    return out[0].unionByName(out[1])


@check(
    "distincts_from_state",
    """SELECT solution_uid, count(DISTINCT users_collab_internal) AS users_collab_internal,
              count(DISTINCT users_collab_external) AS users_collab_external, count(DISTINCT department) AS department
       FROM star GROUP BY solution_uid""",
)
def distincts_from_state(t: Tables, p: Params) -> DataFrame:
    """Distinct counts over all months from stored sets: history up to the snapshot first, then the months after it, the
    snapshot's again."""
    kept, rows = distincts.SOLUTION_DISTINCTS, adoption.star_rows(t, p)
    spark, path = rows.sparkSession, shared_path(rows.sparkSession, "state-distincts")
    kept.begin(rows.where(F.col("date") <= F.lit(p.snapshot)), path)
    later = adoption.months(t, p).where(F.col("date") > F.lit(p.snapshot)).select("date").collect()  # a row per month
    kept.update(rows, path, [p.snapshot, *(r["date"] for r in later)], "later")
    return kept.totals(kept.read(spark, path), by=["solution_uid"])


@check(
    "heavy_key_join",
    """SELECT s.solution_uid, s.plan_uid, s.date, d.users_licensed, d.licenses
       FROM sols s LEFT JOIN plan_daily d ON s.plan_uid = d.plan_uid AND s.date = d.date""",
)
def heavy_key_join(t: Tables, p: Params) -> DataFrame:
    rows = usable_solutions(t, p).select("solution_uid", "plan_uid", "date")
    return skew.salted_join(rows, t.plan_daily.select("plan_uid", "date", "users_licensed", "licenses"), ["plan_uid", "date"], hot="plan_uid")


@check(
    "stored_layout_join",
    """SELECT s.solution_uid, s.plan_uid, s.date, d.users_licensed, d.licenses
       FROM sols s LEFT JOIN plan_daily d ON s.plan_uid = d.plan_uid AND s.date = d.date""",
)
def stored_layout_join(t: Tables, p: Params) -> DataFrame:
    spark = t.plan_daily.sparkSession
    folder = shared_path(spark, "layout")
    names = {name: f"{name}_{folder[-12:]}" for name in ("solution_monthly", "plan_daily")}
    layout.write_facts(t, names, folder, buckets=8)
    stored = layout.with_stored_facts(t, spark, names)
    joined = joins.solution_plan_month(usable_solutions(stored, p), stored.plan_daily.select("plan_uid", "date", "users_licensed", "licenses"))
    return joined.select("solution_uid", "plan_uid", "date", "users_licensed", "licenses")


# --- filters --------------------------------------------------------------------------------------


@check(
    "filtered_solutions",
    """SELECT solution_uid, date, plan_uid, owner_uid, users_hvt, workflows, wt_complexity, department, external,
              api_integrations, api_apps, quarters_active FROM sols""",
)
def filtered_solutions(t: Tables, p: Params) -> DataFrame:
    return usable_solutions(t, p).select(
        "solution_uid", "date", "plan_uid", "owner_uid", "users_hvt", "workflows", "wt_complexity", "department",
        "external", "api_integrations", "api_apps", "quarters_active",
    )


@check("filtered_plans", "SELECT plan_uid, account_id FROM owned_plans")
def filtered_plans(t: Tables, p: Params) -> DataFrame:
    return filters.filtered_plans(t.plan)


@check("trailing_24_months", "SELECT date, year_fiscal, year, month_calendar, year_month FROM recent_months")
def trailing_24_months(t: Tables, p: Params) -> DataFrame:
    return filters.trailing_months(t.date_dim, p.as_of, p.months_back)


@check(
    "active_work_types",
    """SELECT plan_uid, account_id, date, work_type, total_count FROM solution_plan_monthly
       WHERE work_type NOT IN ('Not Active')""",
)
def active_work_types(t: Tables, p: Params) -> DataFrame:
    return filters.active_work_types(t.solution_plan_monthly).select(
        "plan_uid", "account_id", "date", "work_type", "total_count"
    )


@check(
    "active_workapps",
    """SELECT container_uid, effective_from, effective_to, owner_plan_uid, owner_user_uid, status, changes
       FROM workapp_interval WHERE status = 'Active'""",
)
def active_workapps(t: Tables, p: Params) -> DataFrame:
    return filters.active_workapps(t.workapp_interval)


@check(
    "mobile_device_filter",
    """SELECT 'prefix' AS variant, session_uid, user_uid FROM session WHERE device LIKE 'Mobile%'
       UNION ALL SELECT 'any_case', session_uid, user_uid FROM session WHERE lower(device) LIKE '%mobile%'""",
)
def mobile_device_filter(t: Tables, p: Params) -> DataFrame:
    variants = [("prefix", False), ("any_case", True)]
    return functools.reduce(
        DataFrame.unionByName,
        [
            t.session.where(filters.mobile_device(any_case)).select(F.lit(name).alias("variant"), "session_uid", "user_uid")
            for name, any_case in variants
        ],
    )


@check(
    "month_equals",
    """SELECT solution_uid, plan_uid, owner_uid, date FROM solution_monthly
       WHERE strftime(date, '%Y-%m') = strftime($snapshot, '%Y-%m')""",
)
def month_equals(t: Tables, p: Params) -> DataFrame:
    return filters.month_equals(t.solution_monthly, p.snapshot).select("solution_uid", "plan_uid", "owner_uid", "date")


@check(
    "account_equals",
    """SELECT account_id, solution_uid, plan_uid, owner_uid, date, users_active FROM snap
       WHERE account_id IN (SELECT account_id FROM addon_plan)""",
)
def account_equals(t: Tables, p: Params) -> DataFrame:
    return snapshot.snapshot_facts(t, p, accounts=t.addon_plan).select(
        "account_id", "solution_uid", "plan_uid", "owner_uid", "date", "users_active"
    )


@check("positive_hvt", "SELECT solution_uid, date, plan_uid, users_hvt FROM sols WHERE users_hvt > 0")
def positive_hvt(t: Tables, p: Params) -> DataFrame:
    return filters.positive_hvt(usable_solutions(t, p)).select("solution_uid", "date", "plan_uid", "users_hvt")


@check(
    "case_flag",
    """SELECT solution_uid, date, owner_uid, CASE WHEN workflows > 0 THEN 1 ELSE 0 END AS automated,
              CASE WHEN users_hvt > 0 THEN solution_uid END AS hvt_solution FROM sols""",
)
def case_flags(t: Tables, p: Params) -> DataFrame:
    return usable_solutions(t, p).select(
        "solution_uid", "date", "owner_uid",
        case_flag(F.col("workflows") > 0).alias("automated"),
        case_flag(F.col("users_hvt") > 0, F.col("solution_uid"), None).alias("hvt_solution"),
    )


@check(
    "coalesce_defaults",
    """SELECT b.plan_uid, coalesce(b.account_id, 0) AS account_or_zero,
              coalesce(a.first_paid, b.first_paid, a.session_first) AS partner_since
       FROM plan b LEFT JOIN account a ON b.account_id = a.account_id""",
)
def coalesce_defaults(t: Tables, p: Params) -> DataFrame:
    dates = t.account.select("account_id", F.col("first_paid").alias("account_first"), "session_first")
    return t.plan.join(dates, "account_id", "left").select(
        "plan_uid",
        coalesce_first("account_id", default=0).alias("account_or_zero"),
        coalesce_first("account_first", "first_paid", "session_first").alias("partner_since"),
    )


@check(
    "chained_alias_projection",
    """SELECT account_id, year_month, pct_licensed_users, round(rank_raw, 6) AS pct_rank_licensed_users,
              CASE WHEN rank_raw >= 0.9 THEN 7 WHEN rank_raw >= 0.7 THEN 4 WHEN rank_raw >= 0.35 THEN 3
                      WHEN rank_raw > 0 THEN 1 ELSE 0 END AS score_licensed_users
       FROM (SELECT account_id, year_month,
                    round(sum(users_licensed_active) / nullif(sum(users_licensed), 0) * 100, 6) AS pct_licensed_users,
                    percent_rank() OVER (ORDER BY sum(users_licensed_active) / nullif(sum(users_licensed), 0) NULLS LAST) AS rank_raw
             FROM star GROUP BY account_id, year_month)""",
)
def chained_alias_projection(t: Tables, p: Params) -> DataFrame:
    ratios = adoption.star_rows(t, p).groupBy("account_id", "year_month").agg(
        safe_ratio(F.sum("users_licensed_active"), F.sum("users_licensed")).alias("pct_licensed_users")
    )
    ranked = with_ranks_and_scores(ratios, ["account_id", "year_month"], {"pct_licensed_users": "licensed_users"})
    return (
        ranked.withColumn("pct_licensed_users", F.col("pct_licensed_users") * 100)
        .withColumn("score_licensed_users", band_score("pct_rank_licensed_users"))
    )


# --- joins ----------------------------------------------------------------------------------------


@check(
    "plan_daily_with_account",
    """SELECT plan_uid, date, account_id, users_licensed, users_licensed_active, users_collab_internal,
              users_collab_external, round(CAST(plan_arr AS DOUBLE), 6) AS plan_arr FROM daily""",
)
def plan_daily_with_account(t: Tables, p: Params) -> DataFrame:
    return joins.plan_daily_with_account(t.plan_daily, filters.filtered_plans(t.plan)).select(
        "plan_uid", "date", "account_id", "users_licensed", "users_licensed_active", "users_collab_internal",
        "users_collab_external", "plan_arr",
    )


@check(
    "solution_plan_month_left",
    """SELECT s.plan_uid, s.date, s.solution_uid, s.owner_uid, d.account_id, d.users_licensed
       FROM sols s LEFT JOIN daily d ON s.plan_uid = d.plan_uid AND s.date = d.date""",
)
def solution_plan_month_left(t: Tables, p: Params) -> DataFrame:
    daily = joins.plan_daily_with_account(t.plan_daily, filters.filtered_plans(t.plan))
    return joins.solution_plan_month(usable_solutions(t, p), daily).select(
        "plan_uid", "date", "solution_uid", "owner_uid", "account_id", "users_licensed"
    )


@check(
    "wide_star_join",
    """SELECT s.account_id, s.date, s.solution_uid, s.plan_uid, CAST(count(*) AS DOUBLE) AS joined_rows,
              CAST(sum(s.users_licensed) AS DOUBLE) AS users_licensed, CAST(sum(s.workflows) AS DOUBLE) AS workflows,
              max(o.total_solutions_per_owner) AS most_by_owner, max(a.name) AS account_name,
              max(a.territory_type) AS territory_type, max(json_extract_string(a.company, '$$.industry')) AS industry,
              max(CASE WHEN addon.account_id IS NULL THEN 0 ELSE 1 END) AS has_addon,
              max(CASE WHEN m.mobile_sessions > 0 THEN 1 ELSE 0 END) AS has_mobile
       FROM star s
       LEFT JOIN owner_totals o ON s.owner_uid = o.owner_uid
       LEFT JOIN hvt_rows h ON s.solution_uid = h.solution_uid AND s.account_id = h.account_id
       LEFT JOIN addon ON s.account_id = addon.account_id
       LEFT JOIN live_apps w ON CAST(s.plan_uid AS VARCHAR) = w.app_plan AND s.year = w.app_year
                            AND s.month_calendar = w.app_month
       LEFT JOIN account a ON s.account_id = a.account_id
       LEFT JOIN prefix_sessions m ON s.plan_uid = m.plan_uid
       GROUP BY ALL""",
)
def wide_star_join(t: Tables, p: Params) -> DataFrame:
    edition = EDITIONS["adoption_scorecard_mobile"]
    rows = adoption.solution_activity(t, p, edition)
    plans, rich = adoption.account_plans(t, p)
    weights = joins.hvt_weights(adoption.hvt_rows(usable_solutions(t, p), filters.account_in(plans, rich)))
    total = joins.weight_of("weight", "hvt_weight")
    owners = owner_solution_counts(usable_solutions(t, p)).dropna(subset=["owner_uid"])
    mobile = joins.presence(adoption.edition_users(t, edition).where("is_mobile"), "plan_uid", "has_mobile")
    addon = joins.presence(t.addon_plan, "account_id", "has_addon")
    grouped = (
        joins.with_weight(rows, weights, ["account_id", "solution_key"], "hvt_weight")
        .join(owners, "owner_uid", "left")
        .groupBy("account_id", "date", "solution_uid", "plan_uid")
        .agg(
            F.sum(total).alias("joined_rows"),
            weighted_sum("users_licensed", total).alias("users_licensed"),
            weighted_sum("workflows", total).alias("workflows"),
            F.max("total_solutions_per_owner").alias("most_by_owner"),
        )
    )
    profile = adoption.account_profile(t.account).select("account_id", "account_name", "territory_type", "industry")
    with_flags = joins.with_presence(grouped.join(profile, "account_id", "left"), addon, "account_id", "has_addon")
    return joins.with_presence(with_flags, mobile, "plan_uid", "has_mobile")


@check(
    "account_arr_semi",
    "SELECT op.plan_uid, op.account_id FROM owned_plans op JOIN rich r ON op.account_id = r.account_id",
)
def account_arr_semi(t: Tables, p: Params) -> DataFrame:
    plans, rich = adoption.account_plans(t, p)
    return filters.account_in(plans, rich).select("plan_uid", "account_id")


@check(
    "presence_left_join",
    """SELECT a.account_id, CASE WHEN x.account_id IS NULL THEN 0 ELSE 1 END AS brandfolder_presence
       FROM account a LEFT JOIN addon x ON a.account_id = x.account_id""",
)
def presence_left_join(t: Tables, p: Params) -> DataFrame:
    present = joins.presence(t.addon_plan, "account_id", "brandfolder_presence")
    return joins.with_presence(t.account.select("account_id"), present, "account_id", "brandfolder_presence")


@check(
    "workapp_month_join",
    """SELECT s.plan_uid, s.date, count(*) AS joined_rows, count(DISTINCT w.container_uid) AS containers,
              count(DISTINCT w.owner_user_uid) AS app_owners
       FROM star s LEFT JOIN live_apps w ON CAST(s.plan_uid AS VARCHAR) = w.app_plan AND s.year = w.app_year
                                        AND s.month_calendar = w.app_month
       GROUP BY ALL""",
)
def workapp_month_join(t: Tables, p: Params) -> DataFrame:
    rows = adoption.star_rows(t, p).groupBy("plan_uid", "date", "year", "month_calendar").agg(
        F.count("*").alias("rows")
    )
    joined = joins.with_workapp_months(rows, joins.workapp_months(t.workapp_interval))
    return joined.select(
        "plan_uid", "date", joins.weight_of("rows", "app_weight").cast("bigint").alias("joined_rows"), "containers", "app_owners"
    )


@check(
    "workapp_interval_join",
    """SELECT s.plan_uid, s.date, count(*) AS joined_rows, count(w.container_uid) AS matches
       FROM sols s LEFT JOIN keyed_apps w
         ON w.app_plan = CAST(s.plan_uid AS VARCHAR)
        AND s.date BETWEEN w.effective_from AND w.effective_to
       GROUP BY ALL""",
)
def workapp_interval_join(t: Tables, p: Params) -> DataFrame:
    rows = usable_solutions(t, p).groupBy("plan_uid", "date").agg(F.count("*").alias("rows"))
    rows = rows.withColumn("plan_key", plan_key("plan_uid"))
    counts = joins.interval_match_counts(rows, joins.by_plan_key(t.workapp_interval), "plan_key", "matches")
    return rows.join(counts, ["plan_key", "date"]).select(
        "plan_uid", "date",
        (F.col("rows") * F.greatest("matches", F.lit(1))).alias("joined_rows"),
        (F.col("rows") * F.col("matches")).alias("matches"),
    )


@check(
    "workapp_interval_rows",
    """SELECT s.solution_uid, s.plan_uid, s.date, w.container_uid, w.owner_plan_uid, w.owner_user_uid, w.effective_from,
              w.effective_to
       FROM sols s LEFT JOIN keyed_apps w
         ON w.app_plan = CAST(s.plan_uid AS VARCHAR)
        AND s.date BETWEEN w.effective_from AND w.effective_to""",
)
def workapp_interval_rows(t: Tables, p: Params) -> DataFrame:
    rows = usable_solutions(t, p).select("solution_uid", "plan_uid", "date", plan_key("plan_uid").alias("plan_key"))
    apps = joins.by_plan_key(t.workapp_interval).drop("status", "changes")
    return intervals.with_intervals(rows, apps, ["plan_key"]).drop("plan_key")


@check(
    "workapp_valid_days",
    """SELECT d.date, w.status, count(*) AS apps, count(DISTINCT w.owner_user_uid) AS owners
       FROM date_dim d JOIN workapp_interval w
         ON d.date BETWEEN w.effective_from AND coalesce(w.effective_to, DATE '9999-12-31')
       GROUP BY ALL""",
)
def workapp_valid_days(t: Tables, p: Params) -> DataFrame:
    # A day meets an owner once, with the number of the owner's apps, and not once per app.
    held = intervals.stretches(t.workapp_interval, ["status", "owner_user_uid"], "apps", open_ended=True)
    valid = intervals.days_in_intervals(t.date_dim, held, open_ended=True)
    return valid.groupBy("date", "status").agg(F.sum("apps").alias("apps"), F.count_distinct("owner_user_uid").alias("owners"))


@check(
    "workapp_as_of",
    """SELECT w.container_uid, w.owner_plan_uid, w.owner_user_uid, count(s.solution_uid) AS solutions
       FROM (SELECT DISTINCT container_uid, owner_plan_uid, owner_user_uid FROM workapp_interval
             WHERE status = 'Active' AND effective_from <= $snapshot
               AND (effective_to IS NULL OR effective_to >= $snapshot)) w
       LEFT JOIN in_month s ON s.solution_uid = w.container_uid GROUP BY ALL""",
)
def workapp_as_of(t: Tables, p: Params) -> DataFrame:
    valid = joins.workapps_valid_at(t.workapp_interval, p.snapshot)
    solutions = snapshot_solutions(t.solution_monthly, t.plan, t.account, p.snapshot, p.min_account_arr_snapshot)
    counted = solutions.groupBy(F.col("solution_uid").alias("container_uid")).agg(F.count("*").alias("solutions"))
    return valid.join(counted, "container_uid", "left").fillna(0, subset=["solutions"])


@check(
    "mobile_user_plans",
    """SELECT 'any_case' AS variant, up.plan_uid, up.user_uid, coalesce(m.mobile_sessions, 0) AS mobile_sessions
       FROM user_plan up LEFT JOIN any_case_sessions m ON up.user_uid = m.user_uid
       UNION ALL SELECT 'prefix', plan_uid, user_uid, mobile_sessions FROM prefix_sessions
       UNION ALL SELECT 'account', plan_uid, user_uid, mobile_sessions FROM user_accounts""",
)
def mobile_user_plans(t: Tables, p: Params) -> DataFrame:
    pairs = t.user_plan.dropna(subset=["plan_uid"]).distinct()
    any_case = pairs.join(joins.mobile_session_counts(t.session, any_case=True), "user_uid", "left")
    prefix = pairs.join(joins.mobile_session_counts(t.session), "user_uid")
    account = joins.account_users(t.user_plan, t.plan, t.session)

    def variant(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.lit(name).alias("variant"), "plan_uid", "user_uid",
            coalesce_first("mobile_sessions", default=0).alias("mobile_sessions"),
        )

    return variant("any_case", any_case).unionByName(variant("prefix", prefix)).unionByName(variant("account", account))


@check(
    "work_type_grid",
    """SELECT n.account_id, n.date, w.work_type, f.total_count
       FROM (SELECT DISTINCT account_id, date FROM solution_plan_monthly WHERE work_type <> 'Not Active') n
       CROSS JOIN (SELECT DISTINCT work_type FROM solution_plan_monthly WHERE work_type <> 'Not Active') w
       LEFT JOIN (SELECT account_id, date, work_type, CAST(sum(total_count) AS BIGINT) AS total_count
                  FROM solution_plan_monthly GROUP BY ALL) f
         ON f.account_id = n.account_id AND f.date = n.date AND f.work_type = w.work_type""",
)
def work_type_grid(t: Tables, p: Params) -> DataFrame:
    facts = (
        filters.active_work_types(t.solution_plan_monthly)
        .groupBy("account_id", "date", "work_type")
        .agg(F.sum("total_count").alias("total_count"))
    )
    grid = joins.work_type_grid(facts.select("account_id", "date").distinct(), facts)
    return joins.fill_grid(grid, facts, ["account_id", "date", "work_type"])


@check(
    "three_level_dim_join",
    """SELECT plan_uid, account_id, date, name, round(CAST(plan_arr AS DOUBLE), 6) AS plan_arr,
              round(CAST(arr AS DOUBLE), 6) AS arr, plan_first_paid FROM paying""",
)
def three_level_dim_join(t: Tables, p: Params) -> DataFrame:
    return joins.paying_plan_months(t.plan_daily, t.plan, t.account).select(
        "plan_uid", "account_id", "date", "name", "plan_arr", "arr", "plan_first_paid"
    )


@check(
    "self_join_objects",
    """SELECT o.account_id, o.date, o.work_type, m.users_active, o.premium_apps, o.integrations, o.connectors, o.assets
       FROM object_texts o
       JOIN (SELECT account_id, date, work_type, CAST(sum(users_active) AS BIGINT) AS users_active
             FROM solution_plan_monthly GROUP BY ALL) m
         ON o.account_id = m.account_id AND o.date = m.date AND o.work_type = m.work_type""",
)
def self_join_objects(t: Tables, p: Params) -> DataFrame:
    keys = list(work_grid.OBJECT_KEYS)
    measures = filters.active_work_types(t.solution_plan_monthly).groupBy(*keys).agg(
        F.sum("users_active").alias("users_active")
    )
    joined = work_grid.object_data(t).join(measures, keys)
    return joined.select(*keys, "users_active", *[map_as_text(k).alias(k) for k in OBJECT_KINDS])


@check(
    "owner_counts_join",
    """SELECT s.solution_uid, s.date, s.owner_uid, s.plan_uid, o.total_solutions_per_owner
       FROM sols s LEFT JOIN owner_totals o ON s.owner_uid = o.owner_uid""",
)
def owner_counts_join(t: Tables, p: Params) -> DataFrame:
    rows = usable_solutions(t, p)
    return rows.join(owner_solution_counts(rows), "owner_uid", "left").select(
        "solution_uid", "date", "owner_uid", "plan_uid", "total_solutions_per_owner"
    )


@check(
    "hvt_self_join",
    """SELECT op.account_id, s.solution_uid, s.date, count(*) AS joined_rows, count(h.users_hvt) AS matches
       FROM sols s JOIN owned_plans op ON s.plan_uid = op.plan_uid
       LEFT JOIN hvt_rows h ON s.solution_uid = h.solution_uid AND op.account_id = h.account_id
       GROUP BY ALL""",
)
def hvt_self_join(t: Tables, p: Params) -> DataFrame:
    rows = usable_solutions(t, p).join(filters.filtered_plans(t.plan), "plan_uid")
    weights = joins.hvt_weights(joins.hvt_counts(filters.positive_hvt(rows), "solution_uid"), "solution_uid")
    cells = rows.groupBy("account_id", "solution_uid", "date").agg(F.count("*").alias("rows"))
    return cells.join(weights, ["account_id", "solution_uid"], "left").select(
        "account_id", "solution_uid", "date",
        (F.col("rows") * coalesce_first("hvt_weight", default=1)).alias("joined_rows"),
        (F.col("rows") * coalesce_first("hvt_weight", default=0)).alias("matches"),
    )
