"""DuckDB side of the checks: the input tables as named subqueries, and a small assembler.

Each oracle is written from the meaning of the operator, with real joins and real windows, so it
checks the rewrites of the Spark side instead of repeating them.
"""

from __future__ import annotations

import re
from string import Template

from vitalgauge.params import FIXTURE_PARAMS as P
from vitalgauge.sources.fixture import MEASURE_PRIMES

_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"
_APPS = "CASE WHEN l_linestatus = 'O' THEN 'Forms,WorkApps' WHEN l_returnflag = 'A' THEN 'Forms' END"
_PRIMES = ", ".join(f"CAST(sum(l_partkey % {prime}) AS BIGINT) AS {name}" for name, prime in MEASURE_PRIMES.items())

#: Named subqueries: the input tables first, then common steps. Later ones may use earlier ones.
SUBQUERIES: dict[str, str] = {
    "lines": "SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "solution_monthly": f"""
        SELECT l_partkey AS solution_uid, {_MONTH} AS date,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS plan_uid, l_suppkey AS owner_uid,
               CAST(l_quantity AS INT) % 6 AS users_hvt, l_linenumber - 1 AS workflows,
               CAST(l_quantity AS INT) % 10 AS wt_complexity, nullif(l_returnflag, 'N') AS department,
               l_linestatus = 'O' AS external, nullif(l_returnflag, 'N') AS api_integrations,
               {_APPS} AS api_apps, string_split({_APPS}, ',') AS integrations,
               l_linenumber % 5 AS quarters_active, CAST(l_quantity AS INT) % 4 AS users_active,
               l_partkey % 3 AS users_external, l_partkey % 7 AS users_external_view
        FROM lines""",
    "plan": """
        SELECT c_custkey AS plan_uid, CASE WHEN c_custkey % 50 <> 7 THEN c_custkey // 10 END AS account_id,
               CAST(any_value(c_acctbal) AS DECIMAL(18,2)) AS arr, c_custkey % 9 AS licenses,
               CAST(min(o_orderdate) AS DATE) AS first_paid
        FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey""",
    "plan_daily": f"""
        SELECT o_custkey AS plan_uid, {_MONTH} AS date, 10 * count(*) + o_custkey % 7 AS users_licensed,
               6 * count(*) AS users_licensed_active, o_custkey % 11 AS users_collab_internal,
               o_custkey % 6 AS users_collab_internal_active, o_custkey % 5 AS users_collab_external,
               o_custkey % 3 AS users_collab_external_active, o_custkey % 9 AS licenses,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS plan_arr
        FROM orders GROUP BY o_custkey, {_MONTH}""",
    "account": """
        SELECT c_custkey // 10 AS account_id, min(c_name) AS name, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS arr,
               min(c_mktsegment) AS territory_type, min(c_mktsegment) AS territory,
               json_object('industry', min(c_mktsegment), 'subIndustry', min(n_name)) AS company,
               CASE WHEN (c_custkey // 10) % 2 = 0 THEN DATE '1995-01-01' END AS first_paid,
               CASE WHEN (c_custkey // 10) % 3 <> 0 THEN DATE '1995-02-01' END AS session_first,
               count(*) AS users_licensed_paid, count(*) - 1 AS users_licensed_paid_active,
               count(*) + 2 AS licenses_paid
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_custkey // 10""",
    "date_dim": """
        SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month_calendar,
               CAST(day(d) AS INT) AS day_of_month,
               CAST(year(d) + CASE WHEN month(d) >= 2 THEN 1 ELSE 0 END AS INT) AS year_fiscal
        FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                     date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
              FROM orders)""",
    "addon_plan": "SELECT CAST(s_nationkey AS BIGINT) AS account_id FROM supplier",
    "workapp_interval": """
        SELECT o_orderkey % 2000 AS container_uid, CAST(o_orderdate AS DATE) AS effective_from,
               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) + 90 END AS effective_to,
               CASE o_orderkey % 13 WHEN 0 THEN concat('plan.com-eu.', o_custkey) WHEN 1 THEN CAST(o_custkey AS VARCHAR)
                    WHEN 2 THEN '' WHEN 3 THEN concat('plan.', o_custkey) WHEN 4 THEN 'plan.com-us.'
                    WHEN 5 THEN concat('plan.com-us.', o_custkey, '.old') WHEN 6 THEN NULL
                    ELSE concat('plan.com-us.', o_custkey) END AS owner_plan_uid, o_orderkey % 150 AS owner_user_uid,
               CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Closed' END AS status, 0 AS changes
        FROM orders""",
    # A plan without a region prefix answers to its bare number and to that number in any region.
    "keyed_apps": """
        SELECT *, owner_plan_uid AS app_plan FROM workapp_interval WHERE owner_plan_uid <> ''
        UNION ALL SELECT *, split_part(owner_plan_uid, '.', 3) FROM workapp_interval
        WHERE len(string_split(owner_plan_uid, '.')) = 3 AND NOT list_contains(string_split(owner_plan_uid, '.'), '')""",
    "user_plan": "SELECT DISTINCT user_id AS user_uid, user_id AS plan_uid FROM events",
    "session": """
        SELECT event_id AS session_uid, user_id AS user_uid,
               CASE event_type WHEN 'click' THEN 'Mobile iOS' WHEN 'view' THEN 'web mobile' ELSE 'Desktop' END AS device
        FROM events""",
    "plan_month_lines": f"""
        SELECT o_custkey AS plan_uid, o_custkey // 10 AS account_id, {_MONTH} AS date,
               CASE WHEN l_returnflag = 'N' THEN 'Not Active' ELSE l_returnflag END AS work_type,
               l_partkey, l_linenumber, l_linestatus, p_brand, p_type, c_mktsegment
        FROM lines JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey""",
    "solution_plan_monthly": f"""
        SELECT plan_uid, account_id, date, work_type, {_PRIMES}
        FROM plan_month_lines GROUP BY ALL""",
    # The object columns of solution_plan_monthly in long form.
    "plan_objects": """
        SELECT plan_uid, account_id, date, work_type, 'premium_apps' AS kind, p_brand AS key,
               CAST(sum(l_linenumber) AS BIGINT) AS value FROM plan_month_lines GROUP BY ALL
        UNION ALL SELECT plan_uid, account_id, date, work_type, 'integrations', p_type, count(*)
        FROM plan_month_lines GROUP BY ALL
        UNION ALL SELECT plan_uid, account_id, date, work_type, 'connectors', l_linestatus, count(*)
        FROM plan_month_lines GROUP BY ALL
        UNION ALL SELECT DISTINCT plan_uid, account_id, date, work_type, 'assets', c_mktsegment, 1
        FROM plan_month_lines WHERE plan_uid % 10 <> 3""",
    # Common steps.
    "sols": """
        SELECT * FROM solution_monthly
        WHERE quarters_active >= 1 AND date <= $as_of AND plan_uid IS NOT NULL""",
    "owned_plans": "SELECT plan_uid, account_id FROM plan WHERE plan_uid IS NOT NULL AND account_id IS NOT NULL",
    "daily": "SELECT pd.*, op.account_id FROM plan_daily pd JOIN owned_plans op USING (plan_uid)",
    "rich": """
        SELECT account_id, sum(plan_arr) AS total_arr FROM daily
        GROUP BY account_id HAVING sum(plan_arr) >= $min_account_plan_arr""",
    "recent_months": """
        SELECT DISTINCT date, year_fiscal, year, month_calendar,
               year || '-' || lpad(CAST(month_calendar AS VARCHAR), 2, '0') AS year_month
        FROM date_dim WHERE day_of_month = 1 AND date >= CAST($as_of - INTERVAL $months_back MONTH AS DATE)""",
    "star": """
        SELECT s.*, d.account_id, d.users_licensed, d.users_licensed_active, d.users_collab_internal,
               d.users_collab_internal_active, d.users_collab_external, d.users_collab_external_active,
               m.year_fiscal, m.year, m.month_calendar, m.year_month
        FROM sols s JOIN owned_plans op ON s.plan_uid = op.plan_uid
        LEFT JOIN daily d ON s.plan_uid = d.plan_uid AND s.date = d.date
        JOIN recent_months m ON d.date = m.date
        JOIN rich r ON op.account_id = r.account_id""",
    "owner_totals": "SELECT owner_uid, count(solution_uid) AS total_solutions_per_owner FROM sols GROUP BY owner_uid",
    "hvt_rows": """
        SELECT op.account_id, s.solution_uid, s.users_hvt FROM sols s LEFT JOIN owned_plans op USING (plan_uid)
        WHERE s.users_hvt > 0""",
    "addon": "SELECT DISTINCT account_id FROM addon_plan",
    "live_apps": """
        SELECT container_uid, owner_user_uid, app_plan,
               CAST(year(effective_from) AS INT) AS app_year, CAST(month(effective_from) AS INT) AS app_month
        FROM keyed_apps WHERE status = 'Active'""",
    "prefix_sessions": """
        SELECT su.user_uid, up.plan_uid, count(DISTINCT su.session_uid) AS mobile_sessions
        FROM session su JOIN user_plan up ON su.user_uid = up.user_uid
        WHERE su.device LIKE 'Mobile%' AND up.plan_uid IS NOT NULL GROUP BY ALL""",
    "any_case_sessions": """
        SELECT user_uid, count(DISTINCT session_uid) AS mobile_sessions FROM session
        WHERE lower(device) LIKE '%mobile%' GROUP BY user_uid""",
    "in_month": """
        SELECT s.*, a.account_id FROM solution_monthly s
        JOIN plan b ON b.plan_uid = s.plan_uid JOIN account a ON a.account_id = b.account_id
        WHERE a.arr >= $min_account_arr_snapshot AND s.date = $snapshot""",
    "crowded": """
        SELECT account_id, count(solution_uid) AS solution_count FROM in_month
        GROUP BY account_id HAVING count(solution_uid) > $accounts_over""",
    "snap": """
        SELECT s.*, a.account_id, a.name AS account_name, round(a.arr, 0) AS account_arr, a.territory_type,
               json_extract_string(a.company, '$$.industry') AS industry,
               json_extract_string(a.company, '$$.industry_sub') AS sub_industry,
               d.users_licensed, d.users_licensed_active, d.users_collab_internal,
               d.users_collab_internal_active, d.users_collab_external, d.users_collab_external_active
        FROM solution_monthly s LEFT JOIN plan b ON b.plan_uid = s.plan_uid
        LEFT JOIN account a ON a.account_id = b.account_id
        LEFT JOIN plan_daily d ON d.plan_uid = b.plan_uid AND s.date = d.date
        WHERE a.arr >= $min_account_arr_snapshot AND s.date = $snapshot AND s.users_active >= 1
          AND d.plan_arr >= $min_plan_arr_snapshot""",
    "user_accounts": """
        SELECT up.plan_uid, b.account_id, up.user_uid, coalesce(ms.n, 0) AS mobile_sessions
        FROM user_plan up JOIN plan b ON up.plan_uid = b.plan_uid
        LEFT JOIN (SELECT user_uid, count(session_uid) AS n FROM session WHERE device LIKE 'Mobile%'
                   GROUP BY user_uid) ms ON up.user_uid = ms.user_uid""",
    "active_objects": """
        SELECT account_id, date, work_type, kind, key, CAST(sum(value) AS BIGINT) AS value
        FROM plan_objects WHERE work_type NOT IN ('Not Active') GROUP BY ALL""",
    "object_texts": """
        SELECT account_id, date, work_type,
               coalesce(string_agg(key || '=' || value, ',' ORDER BY key) FILTER (kind = 'premium_apps'), '') AS premium_apps,
               coalesce(string_agg(key || '=' || value, ',' ORDER BY key) FILTER (kind = 'integrations'), '') AS integrations,
               coalesce(string_agg(key || '=' || value, ',' ORDER BY key) FILTER (kind = 'connectors'), '') AS connectors,
               coalesce(string_agg(key || '=' || value, ',' ORDER BY key) FILTER (kind = 'assets'), '') AS assets
        FROM active_objects GROUP BY ALL""",
    "labels": """
        SELECT account_id, name, name || ' (' || string_agg(DISTINCT token, ', ' ORDER BY token) || ')' AS account_name_ppid
        FROM (SELECT m.account_id, a.name,
                     replace(replace(CAST(m.plan_uid AS VARCHAR), 'plan.com-us.', ''), 'plan.com-eu.', '') AS token
              FROM solution_plan_monthly m
              LEFT JOIN plan b ON m.plan_uid = b.plan_uid AND m.account_id = b.account_id
              LEFT JOIN account a ON m.account_id = a.account_id
              WHERE b.arr > 0 AND b.licenses > 1 AND a.arr >= $min_account_arr_grid AND m.account_id IS NOT NULL)
        GROUP BY account_id, name""",
    "paying": """
        SELECT d.plan_uid, a.account_id, d.plan_arr, a.arr, d.date, a.name, b.first_paid AS plan_first_paid,
               d.licenses, d.users_licensed, d.users_licensed_active, d.users_collab_external, d.users_collab_internal
        FROM plan_daily d LEFT JOIN plan b ON d.plan_uid = b.plan_uid
        LEFT JOIN account a ON b.account_id = a.account_id WHERE b.arr > 0 AND b.licenses > 1""",
    "grid_data": """
        WITH acc AS (
            SELECT account_id, date, name, max(arr) AS arr, sum(plan_arr) AS plan_arr,
                   min(plan_first_paid) AS plan_first_paid, CAST(sum(licenses) AS BIGINT) AS licenses,
                   CAST(sum(users_licensed) AS BIGINT) AS users_licensed,
                   CAST(sum(users_licensed_active) AS BIGINT) AS users_licensed_active,
                   CAST(sum(users_collab_external) AS BIGINT) AS users_collab_external,
                   CAST(sum(users_collab_internal) AS BIGINT) AS users_collab_internal
            FROM paying GROUP BY account_id, date, name)
        SELECT m.work_type, m.account_id, acc.name, m.date, max(acc.arr) AS arr, max(acc.plan_arr) AS plan_arr,
               min(acc.plan_first_paid) AS plan_first_paid, max(acc.licenses) AS licenses,
               max(acc.users_licensed) AS users_licensed, max(acc.users_licensed_active) AS users_licensed_active,
               max(acc.users_collab_external) AS users_collab_external,
               max(acc.users_collab_internal) AS users_collab_internal, max(m.quarters_active) AS quarters_active,
               """ + ", ".join(
                   f"CAST(sum(m.{c}) AS BIGINT) AS {c}" for c in MEASURE_PRIMES if c != "quarters_active"
               ) + """
        FROM solution_plan_monthly m JOIN acc ON m.account_id = acc.account_id AND m.date = acc.date
        WHERE acc.arr >= $min_account_arr_grid AND m.work_type NOT IN ('Not Active')
        GROUP BY m.work_type, m.account_id, acc.name, m.date""",
    "grid_agg": """
        SELECT coalesce(l.account_name_ppid, g.name) AS account_name_ppid, g.*, a.territory, a.territory_type,
               coalesce(a.first_paid, g.plan_first_paid, a.session_first) AS partner_since, a.first_paid,
               a.session_first, a.users_licensed_paid, a.users_licensed_paid_active, a.licenses_paid
        FROM grid_data g JOIN account a ON g.account_id = a.account_id
        LEFT JOIN labels l ON g.account_id = l.account_id""",
}

_VALUES = {
    "as_of": f"DATE '{P.as_of}'",
    "snapshot": f"DATE '{P.snapshot}'",
    "months_back": str(P.months_back),
    "days_back": str(P.days_back),
    "min_account_plan_arr": str(P.min_account_plan_arr),
    "min_account_arr_snapshot": str(P.min_account_arr_snapshot),
    "min_account_arr_grid": str(P.min_account_arr_grid),
    "min_plan_arr_snapshot": str(P.min_plan_arr_snapshot),
    "power_owner_over": str(P.power_owner_over),
    "accounts_over": str(P.accounts_over),
}


def _uses(text: str) -> set[str]:
    """Subqueries named after FROM, JOIN or IN (SELECT … FROM, directly or through others."""
    found: set[str] = set()
    todo = [text]
    while todo:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", todo.pop()):
            if name in SUBQUERIES and name not in found:
                found.add(name)
                todo.append(SUBQUERIES[name])
    return found


def oracle(body: str) -> str:
    """A complete DuckDB query: the subqueries that ``body`` uses, then ``body``, with parameters set."""
    used = _uses(body)
    parts = [f"{name} AS ({SUBQUERIES[name]})" for name in SUBQUERIES if name in used]
    prefix = f"WITH {', '.join(parts)} " if parts else ""
    if prefix and body.lstrip().upper().startswith("WITH "):
        prefix = prefix.rstrip() + ", "
        body = body.lstrip()[5:]
    return Template(prefix + body).substitute(_VALUES)
