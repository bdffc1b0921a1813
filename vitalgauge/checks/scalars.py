"""Checks of sorts, limits, set operations, object flattening and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge import functions as X
from vitalgauge.checks.registry import check
from vitalgauge.checks.relational import usable_solutions
from vitalgauge.operators import filters
from vitalgauge.operators.documents import attributes, flatten_variant, parsed, sum_values
from vitalgauge.operators.objects import flatten_json, flatten_object, stack_objects, sum_by_key
from vitalgauge.params import Params
from vitalgauge.plans import adoption, snapshot, work_grid
from vitalgauge.tables import Tables

_MONTHLY = """SELECT account_id, year_month, CAST(sum(users_licensed) AS BIGINT) AS licensed
              FROM star GROUP BY account_id, year_month"""


def _monthly(t: Tables, p: Params) -> DataFrame:
    return adoption.star_rows(t, p).groupBy("account_id", "year_month").agg(F.sum("users_licensed").alias("licensed"))


# --- sorts and limits -----------------------------------------------------------------------------


@check("order_by_account_month", f"{_MONTHLY} ORDER BY account_id, year_month")
def order_by_account_month(t: Tables, p: Params) -> DataFrame:
    return _monthly(t, p).orderBy("account_id", "year_month")


@check("top_k_rows", f"{_MONTHLY} ORDER BY account_id, year_month LIMIT 10")
def top_k_rows(t: Tables, p: Params) -> DataFrame:
    return adoption.top_rows(_monthly(t, p), 10)


@check(
    "order_by_date_desc",
    """SELECT account_id, date, work_type, CAST(sum(total_count) AS BIGINT) AS total_count
       FROM solution_plan_monthly GROUP BY ALL ORDER BY date DESC, account_id, work_type""",
)
def order_by_date_desc(t: Tables, p: Params) -> DataFrame:
    grouped = t.solution_plan_monthly.groupBy("account_id", "date", "work_type").agg(
        F.sum("total_count").alias("total_count")
    )
    return grouped.orderBy(F.col("date").desc(), "account_id", "work_type")


# --- objects --------------------------------------------------------------------------------------


@check(
    "union_all_branches",
    """SELECT plan_uid, account_id, date, work_type, kind, key, value FROM plan_objects
       WHERE work_type NOT IN ('Not Active')""",
)
def union_all_branches(t: Tables, p: Params) -> DataFrame:
    return stack_objects(filters.active_work_types(t.solution_plan_monthly), ["plan_uid", *work_grid.OBJECT_KEYS])


@check(
    "flatten_object",
    """SELECT 'premium_apps' AS source, plan_uid AS row_id, date, work_type, key, value
       FROM plan_objects WHERE kind = 'premium_apps'
       UNION ALL SELECT 'props', event_id, NULL, NULL, 'k', CAST(json_extract(props, '$$.k') AS BIGINT) FROM events""",
)
def flatten_objects(t: Tables, p: Params) -> DataFrame:
    maps = flatten_object(t.solution_plan_monthly.select("plan_uid", "date", "work_type", "premium_apps"), "premium_apps")
    documents = flatten_json(t.events.select("event_id", "props"), "props")
    return maps.select(F.lit("premium_apps").alias("source"), F.col("plan_uid").alias("row_id"), "date", "work_type", "key", "value").unionByName(
        documents.select(
            F.lit("props").alias("source"), F.col("event_id").alias("row_id"), F.lit(None).cast("date").alias("date"),
            F.lit(None).cast("string").alias("work_type"), "key", "value",
        )
    )


@check("flatten_sum_by_key", "SELECT account_id, date, work_type, kind, key, value FROM active_objects")
def flatten_sum_by_key(t: Tables, p: Params) -> DataFrame:
    entries = stack_objects(filters.active_work_types(t.solution_plan_monthly), work_grid.OBJECT_KEYS)
    return sum_by_key(entries, work_grid.OBJECT_KEYS)


@check(
    "variant_attributes",
    """SELECT account_id, json_extract_string(company, '$$.industry') AS industry,
              coalesce(json_extract_string(company, '$$.industry_sub'), json_extract_string(company, '$$.subIndustry')) AS sub_industry
       FROM account""",
)
def variant_attributes(t: Tables, p: Params) -> DataFrame:
    wanted = {"industry": "industry", "sub_industry": ("industry_sub", "subIndustry")}
    return attributes(t.account.select("account_id", "company"), "company", wanted).drop("company")


@check(
    "variant_flatten_sum",
    """SELECT account_id, key, CAST(sum(value) AS DOUBLE) AS value, CAST(0 AS BIGINT) AS other_values
       FROM plan_objects WHERE kind = 'premium_apps' GROUP BY account_id, key""",
)
def variant_flatten_sum(t: Tables, p: Params) -> DataFrame:
    texts = t.solution_plan_monthly.select("account_id", F.to_json("premium_apps").alias("premium_apps"))
    return sum_values(flatten_variant(parsed(texts, "premium_apps"), "premium_apps"), ["account_id"])


@check(
    "json_path_extract",
    """SELECT 'account' AS source, account_id AS row_id, json_extract_string(company, '$$.industry') AS first_value,
              json_extract_string(company, '$$.subIndustry') AS second_value,
              json_extract_string(company, '$$.industry_sub') AS missing_value FROM account
       UNION ALL SELECT 'event', event_id, json_extract_string(props, '$$.k'), NULL, NULL FROM events""",
)
def json_path_extract(t: Tables, p: Params) -> DataFrame:
    accounts = t.account.select(
        F.lit("account").alias("source"), F.col("account_id").alias("row_id"),
        X.json_path("company", "industry").alias("first_value"),
        X.json_path("company", "subIndustry").alias("second_value"),
        X.json_path("company", "industry_sub").alias("missing_value"),
    )
    nothing = F.lit(None).cast("string")
    events = t.events.select(
        F.lit("event").alias("source"), F.col("event_id").alias("row_id"), X.json_path("props", "k").alias("first_value"),
        nothing.alias("second_value"), nothing.alias("missing_value"),
    )
    return accounts.unionByName(events)


# --- scalars --------------------------------------------------------------------------------------


@check(
    "year_month_label",
    """SELECT solution_uid, owner_uid, date, year(date) || '-' || lpad(CAST(month(date) AS VARCHAR), 2, '0') AS year_month
       FROM solution_monthly""",
)
def year_month_label(t: Tables, p: Params) -> DataFrame:
    year, month = X.date_parts("date")
    return t.solution_monthly.select("solution_uid", "owner_uid", "date", X.year_month_label(year, month).alias("year_month"))


@check("format_month", "SELECT plan_uid, date, strftime(date, '%Y-%m') AS month_year FROM plan_daily")
def format_month(t: Tables, p: Params) -> DataFrame:
    return t.plan_daily.select("plan_uid", "date", X.format_month("date").alias("month_year"))


@check(
    "date_parts",
    """SELECT container_uid, owner_plan_uid, effective_from, CAST(year(effective_from) AS INT) AS year,
              CAST(month(effective_from) AS INT) AS month_calendar FROM workapp_interval""",
)
def date_parts(t: Tables, p: Params) -> DataFrame:
    year, month = X.date_parts("effective_from")
    return t.workapp_interval.select(
        "container_uid", "owner_plan_uid", "effective_from", year.alias("year"), month.alias("month_calendar")
    )


@check(
    "date_shift",
    """SELECT container_uid, effective_from, CAST(effective_from - INTERVAL 24 MONTH AS DATE) AS months_earlier,
              CAST(effective_from - INTERVAL 90 DAY AS DATE) AS days_earlier FROM workapp_interval""",
)
def date_shift(t: Tables, p: Params) -> DataFrame:
    return t.workapp_interval.select(
        "container_uid", "effective_from",
        X.months_before(F.col("effective_from"), p.months_back).alias("months_earlier"),
        X.days_before(F.col("effective_from"), p.days_back).alias("days_earlier"),
    )


@check(
    "split_part_id",
    """SELECT container_uid, effective_from, split_part(owner_plan_uid, '.', 3) AS plan_token,
              split_part(status, '.', 3) AS no_token FROM workapp_interval""",
)
def split_part_id(t: Tables, p: Params) -> DataFrame:
    return t.workapp_interval.select(
        "container_uid", "effective_from", X.third_token("owner_plan_uid").alias("plan_token"),
        X.third_token("status").alias("no_token"),
    )


@check(
    "strip_id_prefix",
    """SELECT owner_plan_uid, effective_from,
              replace(replace(owner_plan_uid, 'plan.com-us.', ''), 'plan.com-eu.', '') AS short_id FROM workapp_interval""",
)
def strip_id_prefix(t: Tables, p: Params) -> DataFrame:
    return t.workapp_interval.select(
        "owner_plan_uid", "effective_from", X.strip_id_prefix("owner_plan_uid").alias("short_id")
    )


@check(
    "normalize_department",
    """SELECT solution_uid, date, owner_uid, replace(department || ' team ' || workflows, ' ', '_') AS department
       FROM solution_monthly""",
)
def normalize_department(t: Tables, p: Params) -> DataFrame:
    spaced = F.concat("department", F.lit(" team "), F.col("workflows").cast("string"))
    return t.solution_monthly.select("solution_uid", "date", "owner_uid", X.normalize_department(spaced).alias("department"))


@check(
    "round_arr",
    """SELECT account_id, CAST(round(arr, 0) AS DOUBLE) AS account_arr FROM account""",
)
def round_arr(t: Tables, p: Params) -> DataFrame:
    return t.account.select("account_id", X.round_arr("arr").alias("account_arr"))


@check(
    "text_length_flag",
    """SELECT solution_uid, date, owner_uid, CASE WHEN len(api_integrations) > 0 THEN 1 ELSE 0 END AS has_integrations,
              CASE WHEN len(api_integrations) > 0 OR len(api_apps) > 0 THEN 1 ELSE 0 END AS has_any FROM sols""",
)
def text_length_flag(t: Tables, p: Params) -> DataFrame:
    integrations, apps = X.text_not_empty("api_integrations"), X.text_not_empty("api_apps")
    return usable_solutions(t, p).select(
        "solution_uid", "date", "owner_uid", X.case_flag(integrations).alias("has_integrations"),
        X.case_flag(integrations | apps).alias("has_any"),
    )


@check(
    "substring_position",
    """SELECT solution_uid, date, owner_uid, api_apps,
              CASE WHEN position('WorkApps' IN api_apps) > 0 THEN 1 ELSE 0 END AS has_work_app FROM sols""",
)
def substring_position(t: Tables, p: Params) -> DataFrame:
    return usable_solutions(t, p).select(
        "solution_uid", "date", "owner_uid", "api_apps",
        X.case_flag(X.contains_text("api_apps", snapshot.WORK_APP)).alias("has_work_app"),
    )


@check(
    "array_size_flag",
    """SELECT solution_uid, date, owner_uid, CASE WHEN len(integrations) > 0 THEN 1 ELSE 0 END AS has_integrations
       FROM sols""",
)
def array_size_flag(t: Tables, p: Params) -> DataFrame:
    return usable_solutions(t, p).select(
        "solution_uid", "date", "owner_uid", X.case_flag(X.array_not_empty("integrations")).alias("has_integrations")
    )


@check(
    "sum_columns",
    """SELECT b.plan_uid, d.date, d.users_collab_internal + d.users_collab_external AS total_users
       FROM plan b LEFT JOIN plan_daily d ON b.plan_uid = d.plan_uid""",
)
def sum_columns(t: Tables, p: Params) -> DataFrame:
    return t.plan.select("plan_uid").join(t.plan_daily, "plan_uid", "left").select(
        "plan_uid", "date", X.sum_columns("users_collab_internal", "users_collab_external").alias("total_users")
    )


@check(
    "concat_label",
    """SELECT b.plan_uid, a.name || ' (' || CAST(b.plan_uid AS VARCHAR) || ')' AS label
       FROM plan b LEFT JOIN account a ON b.account_id = a.account_id""",
)
def concat_label(t: Tables, p: Params) -> DataFrame:
    return t.plan.join(t.account.select("account_id", "name"), "account_id", "left").select(
        "plan_uid", X.concat_label("name", F.col("plan_uid").cast("string")).alias("label")
    )
