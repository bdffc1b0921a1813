"""Operators against brute force on random rows, with NULL keys, ties and hot keys."""

from __future__ import annotations

import datetime as dt
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitalgauge.operators import joins, objects, windows
from vitalgauge.operators.ranks import percent_ranks, with_ranks_and_scores

few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
keys = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 5)), st.integers(-3, 3)), min_size=1, max_size=60)


@few
@given(data=rows)
def test_over_partition_equals_collected_sets(spark, data):
    df = spark.createDataFrame(data, "k int, v int, x int")
    out = windows.over_partition(df, ["k"], distinct=F.count_distinct("v"), total=F.sum("x"), n=F.count("v")).collect()
    groups = defaultdict(list)
    for k, v, x in data:
        groups[k].append((v, x))
    expected = Counter(
        (
            k, v, x,
            len({w for w, _ in groups[k] if w is not None}),
            sum(y for _, y in groups[k]),
            sum(w is not None for w, _ in groups[k]),
        )
        for k, v, x in data
    )
    assert Counter(map(tuple, out)) == expected


@few
@given(data=rows)
def test_conditional_distincts_share_one_grouping(spark, data):
    df = spark.createDataFrame(data, "k int, v int, x int")
    conditions = {"positive": F.col("x") > 0, "even": F.col("x") % 2 == 0}
    out = windows.count_distinct_if_over(df, ["k"], "v", conditions).select("k", "v", "x", *conditions).collect()

    def count(key, test):
        return len({v for k, v, x in data if k == key and v is not None and test(x)})

    expected = Counter((k, v, x, count(k, lambda y: y > 0), count(k, lambda y: y % 2 == 0)) for k, v, x in data)
    assert Counter(map(tuple, out)) == expected


value = st.one_of(
    st.none(), st.sampled_from([0.0, -0.0, 1.0, 0.5, -2.0, 1e-300, 1e300]), st.floats(-10, 10, allow_nan=False)
)


def brute_percent_rank(values, nulls_last):
    def order(v):
        return (v is None) == nulls_last, v or 0.0

    n = len(values)
    return [sum(order(w) < order(v) for w in values) / (n - 1) if n > 1 else 0.0 for v in values]


@few
@given(values=st.lists(value, min_size=1, max_size=80), nulls_last=st.booleans())
def test_percent_rank(spark, values, nulls_last):
    df = spark.createDataFrame([(i, v, 1.0) for i, v in enumerate(values)], "id int, a double, flag double")
    out = {(r["measure"], r["id"]): r["pct_rank"] for r in percent_ranks(df, ["id"], ["a", "flag"], nulls_last).collect()}
    for i, rank in enumerate(brute_percent_rank(values, nulls_last)):
        assert out["a", i] == pytest.approx(rank)
        assert out["flag", i] == 0.0
    assert len(out) == 2 * len(values)


def test_percent_rank_equals_window(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(
        "id", (F.rand(7) * F.pow(F.lit(10.0), (F.col("id") % 7) - 3)).alias("a"), (F.col("id") % 3).cast("double").alias("b")
    ).cache()
    out = with_ranks_and_scores(df, ["id"], {"a": "a", "b": "b"})
    assert "SinglePartition" not in out._jdf.queryExecution().toString()
    expected = df.select(
        "id", *[F.percent_rank().over(Window.orderBy(F.col(c).asc_nulls_last())).alias(f"pct_rank_{c}") for c in "ab"]
    )
    assert out.select("id", "pct_rank_a", "pct_rank_b").exceptAll(expected).isEmpty()
    assert {r["score_a"] for r in out.select("score_a").distinct().collect()} == {0, 1, 3, 4, 7}


days = st.integers(0, 40).map(lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n))
intervals = st.lists(st.tuples(st.sampled_from("ab"), days, st.one_of(st.none(), days)), max_size=40)
points = st.lists(st.tuples(st.sampled_from("abc"), days), min_size=1, max_size=20)


@few
@given(spans=intervals, asked=points)
def test_interval_match_counts(spark, spans, asked):
    spans_df = spark.createDataFrame(spans, "k string, effective_from date, effective_to date")
    asked_df = spark.createDataFrame(asked, "k string, date date")
    out = Counter(map(tuple, joins.interval_match_counts(asked_df, spans_df, "k", "n").collect()))
    expected = Counter(
        (k, d, sum(key == k and end is not None and start <= d <= end for key, start, end in spans))
        for k, d in set(asked)
    )
    assert out == expected


def test_join_null_safe_and_weights(spark):
    left = spark.createDataFrame([(None, 1), (2, 5)], "k int, x int")
    right = spark.createDataFrame([(None, 7), (3, 8)], "k int, y int")
    assert set(map(tuple, joins.join_null_safe(left, right, ["k"]).collect())) == {(None, 1, 7), (2, 5, None)}
    counts = spark.createDataFrame([(2, 4)], "k int, w long")
    assert {r["x"]: r["w"] for r in joins.with_weight(left, counts, ["k"], "w").collect()} == {1: 1, 5: 4}


def test_objects_round_trip(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1, "b": 2}, {}), (1, {"a": 10}, None), (2, None, {"z": 5})], "id int, p map<string,long>, q map<string,long>"
    )
    summed = objects.sum_by_key(objects.stack_objects(df, ["id"], ["p", "q"]), ["id"])
    assert {tuple(r) for r in summed.collect()} == {(1, "p", "a", 11), (1, "p", "b", 2), (2, "q", "z", 5)}
    maps = {r["id"]: (r["p"], r["q"]) for r in objects.object_agg(summed, ["id"], ["p", "q"]).collect()}
    assert maps == {1: ({"a": 11, "b": 2}, {}), 2: ({}, {"z": 5})}
    text = df.select("id", objects.map_as_text("p").alias("t")).collect()
    assert [r["t"] for r in text] == ["a=1,b=2", "a=10", None]
    unknown = spark.createDataFrame([(1, "p", None, 1), (1, "p", "k", None)], "id int, kind string, key string, value long")
    assert objects.object_agg(unknown, ["id"], ["p"]).first()["p"] == {}


def test_grid_has_every_combination(spark):
    names = spark.createDataFrame([(1,), (2,), (3,)], "account_id int")
    types = spark.createDataFrame([("A",), ("R",), ("A",)], "work_type string")
    grid = joins.work_type_grid(names, types)
    assert sorted(map(tuple, grid.collect())) == [(i, w) for i in (1, 2, 3) for w in "AR"]
    assert "Cartesian" not in grid._jdf.queryExecution().toString()


plans = st.integers(0, 4)
solution_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), plans), min_size=1, max_size=25)
app_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.one_of(st.none(), st.integers(0, 3)), plans), max_size=30)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(used=solution_rows, owned=app_rows)
def test_distinct_apps_over_several_plans(spark, used, owned):
    from vitalgauge.plans import adoption

    adoption.LIGHT_PLAN = len(used) % 3  # so that some plans' items are bitmaps
    month = dt.date(2001, 7, 1)
    rows = spark.createDataFrame([(s, month, str(p), 2001, 7) for s, p in used], "solution_uid int, date date, plan_key string, year int, month_calendar int")
    apps = spark.createDataFrame([(str(p), 2001, 7, c, u) for c, u, p in owned], "plan_key string, year int, month_calendar int, container_uid int, owner_user_uid int")
    counts = joins.workapp_month_counts(apps)
    activity = adoption.with_solution_key(rows).join(counts, adoption.PLAN_MONTH, "left").fillna(0)
    out = {r["solution_key"]: (r["work_app_count"], r["external_views_with_work_app"]) for r in adoption.solution_month_apps(activity, apps).collect()}
    for s in {s for s, _ in used}:
        mine = {p for t, p in used if t == s}
        containers = {c for c, _, p in owned if p in mine and c is not None}
        owners = {u for _, u, p in owned if p in mine and u is not None}
        assert out["" if s is None else f"s{s}"] == (len(containers), len(owners))
    adoption.LIGHT_PLAN = 32


@pytest.mark.parametrize("hot", [2, 5])
def test_hot_plans_in_common_make_no_pairs(spark, hot):
    from vitalgauge.plans import adoption

    month, n = dt.date(2001, 7, 1), 400
    used = [(s, month, f"hot{p}", 2001, 7) for s in range(n) for p in range(hot)] + [(None, month, f"hot{p}", 2001, 7) for p in range(hot)]
    rows = spark.createDataFrame(used, "solution_uid int, date date, plan_key string, year int, month_calendar int")
    apps = spark.createDataFrame([(f"hot{p}", 2001, 7, c, c % 50) for c in range(n) for p in range(hot)], "plan_key string, year int, month_calendar int, container_uid int, owner_user_uid int")
    activity = adoption.with_solution_key(rows).join(joins.workapp_month_counts(apps), adoption.PLAN_MONTH, "left").fillna(0)
    shared = activity.select(*adoption.SOLUTION_MONTH, *adoption.PLAN_MONTH).distinct()
    sets = adoption.plan_sets(shared)
    assert sets.select("set_key").distinct().count() == 1 and sets.count() == n + 1
    out = {(r["work_app_count"], r["external_views_with_work_app"]) for r in adoption.solution_month_apps(activity, apps).collect()}
    assert out == {(n, 50)}
    first = sets.where("set_key = solution_key").select(*adoption.SOLUTION_MONTH)
    placed = adoption.items_of_several_plans(adoption.app_items(apps))
    # one set of plans, and few stretches of numbers for each plan and kind
    assert adoption.set_bitmaps(shared.join(first, adoption.SOLUTION_MONTH, "left_semi"), placed).count() <= 8 * 2 * hot


def test_many_sets_around_hot_plans_stay_linear(spark):
    """1,000 different sets of plans hold two plans of 500 items each: pairs of sets and items would be 500,000."""
    from vitalgauge.plans import adoption

    month, sets, items = dt.date(2001, 7, 1), 1000, 500
    used = [(s, month, p, 2001, 7) for s in range(sets) for p in ("hot0", "hot1", f"own{s}")]
    rows = spark.createDataFrame(used, "solution_uid int, date date, plan_key string, year int, month_calendar int")
    owned = [(p, 2001, 7, c, c % 70) for c in range(items) for p in ("hot0", "hot1")] + [(f"own{s}", 2001, 7, s, 10_000 + s % 3) for s in range(sets)]
    apps = spark.createDataFrame(owned, "plan_key string, year int, month_calendar int, container_uid int, owner_user_uid int")
    activity = adoption.with_solution_key(rows).join(joins.workapp_month_counts(apps), adoption.PLAN_MONTH, "left").fillna(0)
    out = {r["solution_key"]: (r["work_app_count"], r["external_views_with_work_app"]) for r in adoption.solution_month_apps(activity, apps).collect()}
    assert out == {f"s{s}": (items + (s >= items), 71) for s in range(sets)}
    shared = activity.select(*adoption.SOLUTION_MONTH, *adoption.PLAN_MONTH).distinct()
    made = adoption.set_bitmaps(shared, adoption.items_of_several_plans(adoption.app_items(apps))).count()
    assert made <= 5 * (len(used) + len(owned))


def test_sets_of_equal_marks_but_other_plans_stay_apart(spark, monkeypatch):
    from vitalgauge.plans import adoption

    monkeypatch.setattr(F, "xxhash64", lambda *_: F.lit(1).cast("bigint"))
    month = dt.date(2001, 7, 1)
    used = [("a", "p"), ("a", "q"), ("b", "p"), ("b", "r"), ("c", "q"), ("c", "p")]
    shared = spark.createDataFrame([(s, month, p, 2001, 7) for s, p in used], "solution_key string, date date, plan_key string, year int, month_calendar int")
    assert {r["solution_key"]: r["set_key"] for r in adoption.plan_sets(shared).collect()} == {"a": "a", "b": "b", "c": "a"}


def test_plan_ids_of_two_regions_stay_apart(spark):
    day = dt.date(2001, 7, 5)
    apps = [(1, "plan.com-us.5"), (2, "plan.com-eu.5"), (3, "a.b"), (4, ""), (5, None), (6, "x.y.z.5")]
    table = spark.createDataFrame([(c, day, None, plan, c, "Active") for c, plan in apps], "container_uid int, effective_from date, effective_to date, owner_plan_uid string, owner_user_uid int, status string")
    plans = ["plan.com-us.5", "plan.com-eu.5", "5", "a.b", "c.d", "", None]
    rows = spark.createDataFrame([(p, 2001, 7) for p in plans], "plan_uid string, year int, month_calendar int")
    got = {r["plan_uid"]: r["containers"] for r in joins.with_workapp_months(rows, joins.workapp_months(table)).collect()}
    assert got == {"plan.com-us.5": 1, "plan.com-eu.5": 1, "5": 2, "a.b": 1, "c.d": 0, "": 0, None: 0}


def test_equal_ratios_are_equal_however_many_rows(spark):
    from vitalgauge.plans import adoption
    from vitalgauge.plans.kpis import Kpi

    sums = spark.range(2000).selectExpr(
        "3D AS once_a", "7D AS once_b", "3D * (100000007D + id * 7919) AS a", "7D * (100000007D + id * 7919) AS b"
    )
    kpi = Kpi("ratio", "a", "b")
    assert sums.select(adoption.kpi_value(kpi, sums.columns).alias("v")).distinct().count() == 1


def test_weights_beyond_bigint(spark):
    from vitalgauge.operators.aggregates import weighted_sum

    rows = spark.sql("SELECT 4000000000000L AS a, 5000000000000L AS b, 7000000000L AS v FROM range(3)")
    weight = joins.weight_of("a", "b")
    (total, values), = rows.agg(F.sum(weight), weighted_sum("v", weight)).collect()
    assert total == 3 * 2 * 10**25 and values == total * 7 * 10**9


@few
@given(
    used=st.lists(st.tuples(st.integers(0, 2), st.integers(1, 3), st.integers(0, 4)), min_size=1, max_size=20),
    owned=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 5)), st.booleans()), max_size=25),
)
def test_mobile_users_of_plans_in_use(spark, used, owned):
    from vitalgauge.plans import adoption

    # a plan belongs to one account
    activity = [(p % 2, dt.date(2001, m, 1), p) for _, m, p in used]
    users = {(p, u): b for p, u, b in owned if u is not None}
    out = adoption.user_metrics(
        spark.createDataFrame(activity, "account_id int, date date, plan_uid int"),
        spark.createDataFrame([(p, u, b) for (p, u), b in users.items()], "plan_uid int, user_uid int, is_mobile boolean"),
    )
    want = defaultdict(set)
    for account, month, plan in activity:
        want[account, month] |= {u for (p, u), b in users.items() if p == plan and b}
    assert {(r["account_id"], r["date"]): r["mobile_users"] for r in out.collect()} == {k: len(v) for k, v in want.items() if v}
