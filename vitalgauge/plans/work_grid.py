"""Work-type grid: every account month x work type, with measures and object columns where known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.operators import joins
from vitalgauge.operators.aggregates import (
    PLAN_SUMS,
    WORK_TYPE_SUMS,
    account_month_rollup,
    partner_since,
    plan_to_account_rollup,
    rich_names,
    string_agg_label,
)
from vitalgauge.operators.filters import active_work_types
from vitalgauge.operators.objects import OBJECT_KINDS, object_agg, stack_objects, sum_by_key
from vitalgauge.params import Params
from vitalgauge.sources.shared import share
from vitalgauge.tables import Tables

OBJECT_KEYS = ("account_id", "date", "work_type")
NAME_KEYS = ("account_id", "date", "name", "plan_arr", "arr", "partner_since", "account_name_ppid")
ACCOUNT_FACTS = ("licenses_paid", "territory", "territory_type", "users_licensed_paid", "users_licensed_paid_active")


def object_data(t: Tables, p: Params | None = None) -> DataFrame:
    """The four object columns summed per key over the plans of an account, as maps again; of the last months, or
    of all time without parameters."""
    rows = joins.in_months_back(t.solution_plan_monthly, p.as_of, p.months_back) if p else t.solution_plan_monthly
    entries = stack_objects(active_work_types(rows), OBJECT_KEYS)
    return object_agg(sum_by_key(entries, OBJECT_KEYS), OBJECT_KEYS)


def paying_months(t: Tables, p: Params, plan_daily: DataFrame) -> DataFrame:
    """Daily plan facts of paying plans of accounts with enough revenue; the other accounts go before any grouping."""
    paying = joins.paying_plan_months(plan_daily, t.plan, t.account)
    return paying.join(rich_names(t.account, p.min_account_arr_grid), ["account_id", "name"], "left_semi")


def known_work_types(t: Tables, p: Params) -> DataFrame:
    """Work types of all time, of accounts with enough revenue; reads the keys alone."""
    months = paying_months(t, p, t.plan_daily).select("account_id", "date").distinct()
    used = active_work_types(t.solution_plan_monthly).select("account_id", "date", "work_type").distinct()
    return used.join(months, ["account_id", "date"], "left_semi").select("work_type").distinct()


def account_work_types(t: Tables, p: Params) -> DataFrame:
    """Measures per account month of the last months, name and work type, with account attributes and label."""
    daily, monthly = (joins.in_months_back(x, p.as_of, p.months_back) for x in (t.plan_daily, t.solution_plan_monthly))
    data = plan_to_account_rollup(monthly, account_month_rollup(paying_months(t, p, daily)), p.min_account_arr_grid)
    attributes = t.account.select("account_id", "first_paid", "session_first", *ACCOUNT_FACTS)
    labels = string_agg_label(t.solution_plan_monthly, t.plan, t.account, p.min_account_arr_grid)
    return (
        data.join(attributes, "account_id")
        .join(labels.select("account_id", "account_name_ppid"), "account_id", "left")
        .withColumn("account_name_ppid", F.coalesce("account_name_ppid", "name"))
        .withColumn("partner_since", partner_since("first_paid", "plan_first_paid", "session_first"))
    )


def grid_names(agg: DataFrame) -> DataFrame:
    """Distinct account months, revenue 0 where unknown."""
    return agg.fillna(0, subset=["plan_arr", "arr"]).select(*NAME_KEYS, "session_first", "first_paid").distinct()


def work_type_monthly_grid(t: Tables, p: Params) -> DataFrame:
    """The grid. Measures and maps are NULL where an account month has no such work type."""
    agg = share(account_work_types(t, p), "grid-agg")
    measures = [*ACCOUNT_FACTS, *PLAN_SUMS, "quarters_active", *WORK_TYPE_SUMS]
    facts = agg.select(*NAME_KEYS, "work_type", *measures).join(object_data(t, p), list(OBJECT_KEYS))
    grid = joins.work_type_grid(grid_names(agg), known_work_types(t, p))
    filled = joins.fill_grid(grid, facts, [*NAME_KEYS, "work_type"])
    return filled.select(*NAME_KEYS, "session_first", "first_paid", "work_type", *measures, *OBJECT_KINDS)


def newest_first(grid: DataFrame) -> DataFrame:
    return grid.orderBy(F.col("date").desc(), "account_id", "name", "work_type")
