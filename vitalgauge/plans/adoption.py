"""The adoption KPIs and scorecards: one row per account and month.

The query joins solution months to plan facts, high-value-task rows, work apps and mobile users;
computes counts over account months, solutions and solution months next to every joined row; and
sums all that per account month. The last three joins multiply rows. Here they only ever add a
weight (see :mod:`vitalgauge.operators.joins`), and a count over an account month enters its own
group's sum as ``count x joined rows``, so no joined row and no per-row count is ever made:

1. :func:`plan_months`: plan facts of the last months with account, labels and weights.
2. :func:`solution_activity`: solution months joined to it. The one shuffle of the fact table;
   written once, as all later branches start here.
3. branches with their own distinct keys (solution, owner, high-value-task value, user), each
   reduced before it is joined.
4. :func:`account_months`: sums per account and month, then :func:`adoption_kpis` makes ratios
   and :func:`adoption_scorecard` ranks and bands them.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.functions import array_not_empty, days_before, exact_ratio, json_path, months_before, safe_ratio, sum_columns
from vitalgauge.operators import bitmaps, distincts, filters, joins
from vitalgauge.operators.aggregates import account_arr_having, owner_solution_counts, weighted_sum
from vitalgauge.operators.ranks import with_ranks_and_scores
from vitalgauge.params import Params
from vitalgauge.plans.kpis import EDITIONS, Edition, Kpi
from vitalgauge.sources.shared import share
from vitalgauge.tables import Tables

PLAN_FACTS = (
    "users_licensed", "users_licensed_active", "users_collab_internal", "users_collab_internal_active",
    "users_collab_external", "users_collab_external_active",
)
#: Columns summed over the joined rows, per account month.
ROW_SUMS = (*PLAN_FACTS, "total_active_users", "users_hvt", "wt_complexity", "workflows")
MONTH = ["account_id", "date"]
SOLUTION_MONTH = ["solution_key", "date"]
ROW_ID = ["account_id", "year_month"]


def account_plans(t: Tables, p: Params) -> tuple[DataFrame, DataFrame]:
    """Usable plans, and the accounts whose plan revenue is high enough."""
    plans = filters.filtered_plans(t.plan)
    daily = joins.plan_daily_with_account(t.plan_daily, plans)
    return plans, account_arr_having(daily, p.min_account_plan_arr).select("account_id")


def months(t: Tables, p: Params) -> DataFrame:
    """The first-of-month days; at most one row per month, so they are broadcast."""
    return F.broadcast(filters.trailing_months(t.date_dim, p.as_of, p.months_back))


def plan_months(t: Tables, p: Params) -> DataFrame:
    """Plan facts on the first of each of the last months, for accounts with enough revenue."""
    plans, rich = account_plans(t, p)
    recent = t.plan_daily.join(months(t, p), "date")
    return joins.plan_daily_with_account(recent, plans).join(rich, "account_id", "left_semi")


def star_rows(t: Tables, p: Params) -> DataFrame:
    """Solution months with plan facts and month labels, before any row-multiplying join."""
    solutions = filters.filtered_solutions(t.solution_monthly, p.as_of)
    return solutions.join(plan_months(t, p), ["plan_uid", "date"])


def edition_users(t: Tables, edition: Edition) -> DataFrame:
    """The users each plan is joined to."""
    any_case = edition.mobile == "any_case"
    mobile = joins.mobile_users(t.session, any_case)
    return joins.plan_users(t.user_plan, mobile, only_mobile=not any_case)


def weighted_plan_months(t: Tables, p: Params, edition: Edition) -> DataFrame:
    """:func:`plan_months` with ``weight``: joined rows per row from work apps and users."""
    rows = plan_months(t, p)
    weights = []
    if edition.work_apps:
        rows = joins.with_workapp_months(rows, recent_apps(t, p))
        weights.append("app_weight")
    if edition.mobile:
        users = edition_users(t, edition).groupBy("plan_uid").agg(F.count("*").alias("user_weight"))
        rows = joins.with_weight(rows, users, ["plan_uid"], "user_weight")
        weights.append("user_weight")
    return rows.withColumn("weight", joins.weight_of(*weights) if weights else F.lit(1).cast(joins.WEIGHT))


def recent_apps(t: Tables, p: Params) -> DataFrame:
    """Work apps by plan and month, of the months that plan facts are taken from."""
    return joins.workapp_months(t.workapp_interval, months_before(p.as_of, p.months_back))


def with_solution_key(rows: DataFrame) -> DataFrame:
    """Adds a solution id that is never NULL (empty text where it was): solutions without an id
    are then one group in groupings and in plain equi-joins alike, which share their shuffles."""
    prefixed = F.concat(F.lit("s"), F.col("solution_uid").cast("string"))
    return rows.withColumn("solution_key", F.coalesce(prefixed, F.lit("")))


def solution_flags(p: Params, edition: Edition) -> dict[str, Column]:
    """Conditions under which a solution counts in an account month."""
    if edition.integrations_by_flag:
        external, internal = F.col("external"), array_not_empty("integrations")
    else:
        external, internal = F.col("api_integrations").isNotNull(), F.col("api_apps").isNotNull()
    return {
        "external_integrations": external,
        "internal_integrations": internal,
        "solutions_with_hvt": F.col("users_hvt") > 0,
        "solutions_with_external_users": F.col("users_collab_external") > 0,
        "solutions_created_last_90_days": F.col("date") >= days_before(p.as_of, p.days_back),
        "solutions_with_automation": F.col("workflows") > 0,
    }


def solution_activity(t: Tables, p: Params, edition: Edition) -> DataFrame:
    """Weighted solution months; the base of all branches."""
    solutions = filters.filtered_solutions(t.solution_monthly, p.as_of)
    rows = solutions.join(weighted_plan_months(t, p, edition), ["plan_uid", "date"])
    collaborators = (
        ("users_collab_internal_active", "users_collab_external_active")
        if edition.active_columns
        else ("users_collab_internal", "users_collab_external")
    )
    apps = (
        ["plan_key", "year", "month_calendar", "containers", "app_owners"] if edition.work_apps else []
    )
    return with_solution_key(rows).select(
        "account_id", "date", "plan_uid", "solution_uid", "solution_key", "owner_uid", "department", "weight",
        *PLAN_FACTS, "users_hvt", "wt_complexity", "workflows", *apps,
        sum_columns(*collaborators).alias("total_active_users"),
        *[F.coalesce(flag, F.lit(False)).alias(name) for name, flag in solution_flags(p, edition).items()],
    )


#: Columns counted distinct per solution, and the names of their counts.
DISTINCTS = {
    "users_collab_internal": "unique_internal_collaborators",
    "users_collab_external": "unique_external_collaborators",
    "department": "num_departments_per_solution",
}


def solution_distincts(activity: DataFrame) -> DataFrame:
    """Per solution, over all months: distinct departments and collaborator numbers."""
    key, names = ["solution_key"], list(DISTINCTS)
    sets = distincts.value_sets(activity, key, [c for c in names if c != "department"], ["department"])
    return distincts.counted(sets, key, names).withColumnsRenamed(DISTINCTS)


PLAN_MONTH = ["plan_key", "year", "month_calendar"]
ITEM_MONTH = ["kind", "item", "year", "month_calendar"]


def app_items(apps: DataFrame) -> DataFrame:
    """Distinct work apps and work-app owners per plan and month, one below the other."""
    kinds = {"app": "container_uid", "owner": "owner_user_uid"}
    pairs = [F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("item")) for k, c in kinds.items()]
    exploded = apps.select(*PLAN_MONTH, F.explode(F.array(*pairs)).alias("i"))
    return exploded.select(*PLAN_MONTH, "i.kind", "i.item").dropna().distinct()


#: Items of several plans that a plan and month has at most to be joined one by one; those of plans with more are joined as bitmaps.
LIGHT_PLAN = 32


def items_of_several_plans(items: DataFrame) -> DataFrame:
    """Items under more than one plan in a month, by plan, numbered so that a plan's items have numbers near each other."""
    homes = items.groupBy(*ITEM_MONTH).agg(F.min("plan_key").alias("home"), F.count("*").alias("plans")).where(F.col("plans") > 1)
    order = ["kind", "year", "month_calendar", "home", "item"]
    numbers = bitmaps.numbered(homes.select(*order), order)
    return items.join(numbers.drop("home"), ITEM_MONTH).drop("item")


def set_bitmaps(shared: DataFrame, placed: DataFrame) -> DataFrame:
    """Per solution month, kind and stretch of numbers: bitmaps whose union is the items of all its plans.

    ``placed``: items by plan and month, with numbers. A plan of few items gives each of them to each of the solution months it is
    in; the items of a plan of many are a bitmap, built once, so a solution month meets a row per stretch of 32,768
    numbers.
    """
    of_plan = [*PLAN_MONTH, "kind"]
    heavy = placed.groupBy(*of_plan).agg(F.count("*").alias("n")).where(F.col("n") > LIGHT_PLAN).drop("n")
    many = bitmaps.bitmaps(placed.join(heavy, of_plan, "left_semi"), of_plan)
    few = shared.join(placed.join(heavy, of_plan, "left_anti"), PLAN_MONTH)
    key = [*SOLUTION_MONTH, "kind"]
    columns = [*key, bitmaps.BUCKET, bitmaps.BITS]
    return shared.join(many, PLAN_MONTH).select(*columns).unionByName(bitmaps.bitmaps(few, key).select(*columns))


def counted_again(shared: DataFrame, items: DataFrame) -> DataFrame:
    """Per solution month: how often apps and owners were counted again for a further plan.

    ``shared`` should have each set of plans once per month (see :func:`plan_sets`). Only items of several plans can
    have been counted again: as often as the plans of the solution month have them, less how many distinct ones these are, which
    the union of the plans' bitmaps tells. The rows grow with the solution months' plans, not with their items.
    """
    placed = share(items_of_several_plans(items), "shared-items")
    key = [*SOLUTION_MONTH, "kind"]
    per_plan = placed.groupBy(*PLAN_MONTH, "kind").agg(F.count("*").alias("items"))
    counted = shared.join(per_plan, PLAN_MONTH).groupBy(*key).agg(F.sum("items").alias("items"))
    distinct = bitmaps.counted(bitmaps.merged(set_bitmaps(shared, placed), key), key, "distinct")
    again = F.col("items") - F.col("distinct")
    return counted.join(distinct, key).groupBy(*SOLUTION_MONTH).agg(
        F.sum(F.when(F.col("kind") == "app", again)).alias("again_apps"),
        F.sum(F.when(F.col("kind") == "owner", again)).alias("again_owners"),
    )


def plan_sets(shared: DataFrame) -> DataFrame:
    """For each solution month, ``set_key``: the least solution of the month that is used by exactly the same plans.

    Sets are first told by their size and two sums of hashes. Each solution month is then compared
    plan by plan with the least one of equal marks, and stays on its own if they differ after all; so no set is ever
    gathered in one row, and the join makes no more rows than it reads.
    """
    marks = [F.sum(F.xxhash64("plan_key", F.lit(salt)).cast("decimal(38,0)")).alias(f"mark_{salt}") for salt in (0, 1)]
    marked = shared.groupBy(*SOLUTION_MONTH).agg(F.count("*").alias("plans"), *marks)
    alike = ["date", "plans", "mark_0", "mark_1"]
    leads = marked.groupBy(*alike).agg(F.min("solution_key").alias("set_key"))
    told = marked.join(leads, alike).select(*SOLUTION_MONTH, "plans", "set_key")
    lead_plans = shared.select(F.col("solution_key").alias("set_key"), "date", "plan_key")
    equal = (
        shared.select(*SOLUTION_MONTH, "plan_key")
        .join(told, SOLUTION_MONTH)
        .join(lead_plans, ["set_key", "date", "plan_key"], "left_semi")
        .groupBy(*SOLUTION_MONTH)
        .agg(F.count("*").alias("in_both"))
    )
    same = F.col("in_both") == F.col("plans")
    checked = told.join(equal, SOLUTION_MONTH, "left")
    return checked.select(*SOLUTION_MONTH, F.when(same, F.col("set_key")).otherwise(F.col("solution_key")).alias("set_key"))


def solution_month_apps(activity: DataFrame, apps: DataFrame) -> DataFrame:
    """Per solution and month: distinct work apps and distinct owners over the plans using it.

    The distinct counts per plan and month are known. A solution month under one plan takes them
    over; one under several plans takes their sum, less what was counted again.
    """
    per_plan = activity.groupBy(*SOLUTION_MONTH, *PLAN_MONTH).agg(
        F.max("containers").alias("containers"), F.max("app_owners").alias("app_owners")
    )
    summed = per_plan.groupBy(*SOLUTION_MONTH).agg(
        F.count("*").alias("plans"), F.sum("containers").alias("containers"), F.sum("app_owners").alias("app_owners")
    )
    several = summed.where(F.col("plans") > 1).select(*SOLUTION_MONTH)
    # Both are narrow, and read again and again by what follows.
    shared = share(per_plan.select(*SOLUTION_MONTH, *PLAN_MONTH).join(several, SOLUTION_MONTH), "several-plans")
    sets = share(plan_sets(shared), "plan-sets")
    first = sets.where(F.col("set_key") == F.col("solution_key")).select(*SOLUTION_MONTH)
    per_set = counted_again(shared.join(first, SOLUTION_MONTH, "left_semi"), app_items(apps))
    again = sets.join(per_set.withColumnRenamed("solution_key", "set_key"), ["set_key", "date"]).drop("set_key")
    return summed.join(again, SOLUTION_MONTH, "left").select(
        *SOLUTION_MONTH,
        (F.col("containers") - F.coalesce("again_apps", F.lit(0))).alias("work_app_count"),
        (F.col("app_owners") - F.coalesce("again_owners", F.lit(0))).alias("external_views_with_work_app"),
    )


def solution_metrics(activity: DataFrame, t: Tables, p: Params, edition: Edition) -> DataFrame:
    """Distinct counts per solution, and per solution and month where the edition has work apps."""
    distincts = solution_distincts(activity)
    if not edition.work_apps:
        return distincts
    apps = solution_month_apps(activity, recent_apps(t, p))
    return apps.join(distincts, "solution_key")


def owner_metrics(activity: DataFrame, solutions: DataFrame, over: int) -> DataFrame:
    """Per account month: distinct owners, and distinct owners of more than ``over`` solutions."""
    power = (
        owner_solution_counts(solutions)
        .where(F.col("total_solutions_per_owner") > over)
        .select("owner_uid", F.lit(1).alias("power"))
    )
    owners = activity.where(F.col("owner_uid").isNotNull()).select(*MONTH, "owner_uid").distinct()
    return owners.join(power, "owner_uid", "left").groupBy(*MONTH).agg(
        F.count("*").alias("unique_solution_owners"), F.count("power").alias("power_developers")
    )


def hvt_rows(solutions: DataFrame, plans: DataFrame) -> DataFrame:
    """High-value-task rows of known solutions, counted per account, solution and number."""
    known = filters.positive_hvt(solutions).where(F.col("solution_uid").isNotNull())
    return joins.hvt_counts(with_solution_key(known).join(plans, "plan_uid"))


def hvt_metrics(activity: DataFrame, hvt: DataFrame) -> DataFrame:
    """Per account month: distinct high-value-task numbers over all rows of its solutions.

    A solution meets each of its distinct numbers once per month of the window, no more.
    """
    present = activity.select(*MONTH, "solution_key").distinct()
    # The condition holds for every row. It keeps the row count in the aggregate, which is then
    # the same one the weights read, so Spark shuffles it once for both.
    numbers = hvt.where(F.col("hvt_rows") > 0)
    return present.join(numbers, ["account_id", "solution_key"]).groupBy(*MONTH).agg(
        F.count_distinct("users_hvt").alias("unique_hvt_collaborators")
    )


def user_metrics(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Per account month: distinct mobile users of the plans in use.

    A user of one plan only of an account is a number of that plan, which its months add up. Only users of several
    plans of one account are joined to the months and made distinct there.
    """
    mobile = users.where("is_mobile").select("plan_uid", "user_uid")
    in_use = activity.select(*MONTH, "plan_uid").distinct()
    owned = in_use.select("account_id", "plan_uid").distinct().join(mobile, "plan_uid").distinct()
    several = owned.groupBy("account_id", "user_uid").agg(F.count("*").alias("plans"), F.max("plan_uid").alias("plan_uid"))
    single = several.where("plans = 1").groupBy("account_id", "plan_uid").agg(F.count("user_uid").alias("single_users"))
    shared = owned.join(several.where("plans > 1").select("account_id", "user_uid"), ["account_id", "user_uid"], "left_semi")
    by_number = in_use.join(single, ["account_id", "plan_uid"]).groupBy(*MONTH).agg(F.sum("single_users").alias("n"))
    by_user = in_use.join(shared, ["account_id", "plan_uid"]).groupBy(*MONTH).agg(F.count_distinct("user_uid").alias("n"))
    return by_number.unionByName(by_user).groupBy(*MONTH).agg(F.sum("n").alias("mobile_users"))


def account_month_metrics(t: Tables, p: Params, edition: Edition) -> DataFrame:
    """Per account and month: the counts over it, and the sums over its joined rows.

    ``rows`` is the number of joined rows and ``total_solutions_per_account`` those with a solution.
    """
    activity = share(solution_activity(t, p, edition).drop("solution_uid"), edition.name)
    solutions = filters.filtered_solutions(t.solution_monthly, p.as_of)
    seen = activity.select("account_id").distinct()
    hvt = hvt_rows(solutions, filters.account_in(filters.filtered_plans(t.plan), seen))
    flags = list(solution_flags(p, edition))

    cells = activity.groupBy(*MONTH, "solution_key").agg(
        F.sum("weight").alias("rows"),
        *[weighted_sum(c, "weight").alias(c) for c in ROW_SUMS],
        *[F.max(flag).alias(flag) for flag in flags],
    )
    cells = joins.with_weight(cells, joins.hvt_weights(hvt), ["account_id", "solution_key"], "hvt_weight")
    # The narrow solution tables are joined with each other first, so the cells are shuffled once
    # for all of them. Every cell has its solution there.
    per_solution = solution_metrics(activity, t, p, edition)
    on = [c for c in per_solution.columns if c in SOLUTION_MONTH]
    metrics = [c for c in per_solution.columns if c not in SOLUTION_MONTH]
    cells = cells.join(per_solution, on)

    rows = joins.weight_of("rows", "hvt_weight")
    known = F.col("solution_key") != ""
    sums = cells.groupBy(*MONTH).agg(
        F.sum(rows).alias("rows"),
        F.sum(F.when(known, rows).otherwise(0)).alias("total_solutions_per_account"),
        *[weighted_sum(c, "hvt_weight").alias(c) for c in ROW_SUMS],
        *[F.count_if(F.col(flag) & known).alias(flag) for flag in flags],
        *[weighted_sum(c, rows).alias(c) for c in metrics],
    )
    counted = ["unique_solution_owners", "power_developers", "unique_hvt_collaborators"]
    sums = sums.join(owner_metrics(activity, solutions, p.power_owner_over), MONTH, "left")
    sums = sums.join(hvt_metrics(activity, hvt), MONTH, "left")
    if edition.mobile:
        sums = sums.join(user_metrics(activity, edition_users(t, edition)), MONTH, "left")
        counted.append("mobile_users")
    addon = joins.presence(t.addon_plan, "account_id", "brandfolder_presence")
    return joins.with_presence(sums.fillna(0, subset=counted), addon, "account_id", "brandfolder_presence")


def account_months(t: Tables, p: Params, edition: Edition) -> DataFrame:
    """Sums per account and month that the KPIs are ratios of, with month labels.

    A count over the account month stands on each of its joined rows, so its sum is count x rows. Of two such sums the
    rows cancel; the counts themselves are in ``once_<name>``, so that equal ratios come out equal
    however many rows were joined, and in ``whole_<name>`` as exact numbers.
    """
    sums = account_month_metrics(t, p, edition)
    repeated = {name: F.col(name) for name in solution_flags(p, edition)}
    for name in ("unique_solution_owners", "power_developers", "unique_hvt_collaborators", "total_solutions_per_account"):
        repeated[name] = F.col(name)
    if edition.mobile:
        repeated["mobile_users"] = F.col("mobile_users")
    repeated["automated_rows"] = (F.col("solutions_with_automation") > 0).cast("int")
    repeated["solutions_created_monthly"] = F.col("total_solutions_per_account")
    repeated["total_complexity_score"] = F.col("wt_complexity")
    repeated["total_workflows"] = F.col("workflows")
    rows = F.col("rows").cast("double")
    sums = sums.withColumns(
        {f"once_{name}": value.cast("double") for name, value in repeated.items()}
        | {f"whole_{name}": value.cast(joins.WEIGHT) for name, value in repeated.items()}
        | {name: value.cast("double") * rows for name, value in repeated.items()}
    )
    return sums.join(months(t, p), "date")


def account_profile(account: DataFrame) -> DataFrame:
    """Descriptive attributes per account, from columns and the JSON company document."""
    return account.groupBy("account_id").agg(
        F.max("name").alias("account_name"),
        F.max("arr").alias("account_arr"),
        F.max("territory_type").alias("territory_type"),
        F.max(json_path("company", "industry")).alias("industry"),
        F.max(json_path("company", "subIndustry")).alias("sub_industry"),
    )


def kpi_value(kpi: Kpi, columns: Collection[str]) -> Column:
    """The unscaled KPI from sums, or from the counts behind them where both sides have one."""
    if not kpi.denominator:
        return F.col(kpi.numerator)
    both = kpi.numerator, kpi.denominator
    once = [f"once_{name}" for name in both]
    return safe_ratio(*(once if set(once) <= set(columns) else both))


def kpi_exact(kpi: Kpi, columns: Collection[str]) -> Column:
    """The unscaled KPI as an exact quotient of the same sums, by which it is ranked."""
    both = kpi.numerator, kpi.denominator
    known = [f"whole_{name}" in columns for name in both]
    rows = F.lit(1) if all(known) else F.col("rows")
    return exact_ratio(
        *(F.try_multiply(F.col(f"whole_{n}"), rows.cast(joins.WEIGHT)) if k else F.col(n) for n, k in zip(both, known, strict=True))
    )


def kpi_ratios(t: Tables, p: Params, edition: Edition) -> DataFrame:
    """One row per account and month: labels, totals, profile where asked, and unscaled KPIs; for ranked editions
    also ``exact_<kpi>``."""
    rows = account_months(t, p, edition)
    profile = []
    if edition.profile:
        rows = rows.join(account_profile(t.account), "account_id", "left")
        profile = ["account_name", "account_arr", "territory_type", "industry", "sub_industry"]
    return rows.select(
        "account_id", "year_fiscal", "year", "month_calendar", "year_month",
        F.col("users_licensed").alias("total_licensed_users"),
        F.col("users_licensed_active").alias("total_active_licensed_users"),
        F.col("users_collab_internal").alias("total_internal_collaborators"),
        F.col("users_collab_external").alias("total_external_collaborators"),
        "total_active_users",
        *profile,
        *[kpi_value(k, rows.columns).alias(k.name) for k in edition.kpis],
        *[kpi_exact(k, rows.columns).alias(f"exact_{k.name}") for k in edition.kpis if edition.ranked and k.denominator],
    )


def adoption_scorecard(t: Tables, p: Params, edition: Edition | str, nulls_last: bool = True) -> DataFrame:
    """The edition's result: KPIs and, for ranked editions, percentile ranks and scores.

    Ranks are taken of the unscaled ratios; percentages are scaled last.
    """
    if isinstance(edition, str):
        edition = EDITIONS[edition]
    rows = kpi_ratios(t, p, edition)
    if edition.ranked:
        measures = {k.name: k.short for k in edition.kpis}
        exact = {k.name: f"exact_{k.name}" for k in edition.kpis if k.denominator}
        rows = with_ranks_and_scores(share(rows, f"{edition.name}-kpis"), ROW_ID, measures, nulls_last, exact).drop(*exact.values())
    return rows.withColumns({k.name: F.col(k.name) * k.scale for k in edition.kpis if k.scale != 1})


def top_rows(scorecard: DataFrame, limit: int) -> DataFrame:
    """The first rows by account and month."""
    return scorecard.orderBy("account_id", "year_month").limit(limit)
