"""Interval joins as rows against brute force, and the plans they make."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalgauge.checks import CHECKS
from vitalgauge.operators.intervals import _LEVELS, _day, days_in_intervals, interval_nodes, stretches, with_intervals
from vitalgauge.params import FIXTURE_PARAMS
from vitalgauge.tables import Tables

DAY0 = dt.date(1, 1, 1)
FACTS, INTERVALS = "k string, date date, fact int", "k string, effective_from date, effective_to date, app int"


def made(rng, hot=False):
    days = [dt.date(1999, 12, 1) + dt.timedelta(d) for d in range(120)] + [DAY0, dt.date(9999, 12, 31), dt.date(2400, 2, 29)]
    key = lambda: "hot" if hot and rng.random() < 0.7 else rng.choice(["a", "b", "c", None])
    facts = [(key(), rng.choice([*days, None]), i) for i in range(150)]
    intervals = []
    for i in range(80):
        first = rng.choice([*days, None])
        length = rng.choice([0, 1, 2, 6, 31, 90, 4000, 300_000])
        last = None
        if first and rng.random() < 0.85:
            last = min(dt.date.max, first + dt.timedelta(min(length, (dt.date.max - first).days)))
        intervals.append((key(), first, last, i))
    intervals.append(("a", days[50], days[40], 99))
    return facts, intervals + intervals[:5]


@pytest.mark.parametrize("open_ended", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_rows_against_brute_force(spark, open_ended, hot):
    rng = random.Random(7)
    for _ in range(1):
        facts, intervals = made(rng, hot)

        def holds(date, first, last):
            last = last or (dt.date.max if open_ended else None)
            return None not in (date, first, last) and first <= date <= last

        matched = [
            [(f, i[3]) for i in intervals if f[0] is not None and f[0] == i[0] and holds(f[1], i[1], i[2])] or [(f, None)] for f in facts
        ]
        expected = Counter((*f, app) for own in matched for f, app in own)
        got = with_intervals(spark.createDataFrame(facts, FACTS), spark.createDataFrame(intervals, INTERVALS), ["k"], open_ended=open_ended)
        assert Counter(tuple(r) for r in got.select("k", "date", "fact", "app").collect()) == expected
        inner = with_intervals(
            spark.createDataFrame(facts, FACTS), spark.createDataFrame(intervals, INTERVALS), ["k"], how="inner", open_ended=open_ended
        )
        assert inner.count() == sum(n for r, n in expected.items() if r[3] is not None)


def test_without_a_key(spark):
    facts, intervals = made(random.Random(1))
    got = days_in_intervals(spark.createDataFrame(facts, FACTS).select("date"), spark.createDataFrame(intervals, INTERVALS))
    days = {f[1] for f in facts if f[1]}
    expected = Counter((d, i[3]) for d in days for i in intervals if i[1] and i[2] and i[1] <= d <= i[2])
    assert Counter((r.date, r.app) for r in got.collect()) == expected


def test_nodes_of_an_interval_are_few(spark):
    spans = [(0, 1), (0, 3_652_059), (1, 3_652_058), (5, 5), (7, 9), (63, 129)]
    spans += [(a, a + n) for a in range(40) for n in (1, 2, 3, 4, 5, 15, 16, 17, 63, 64, 65, 90)]
    frame = spark.createDataFrame(spans, "a long, b long").select("a", "b", interval_nodes(F.col("a"), F.col("b")).alias("nodes"))
    for a, b, nodes in frame.collect():
        spots = sorted((n >> 40, n & ((1 << 40) - 1)) for n in nodes)
        assert len(nodes) <= 6 * _LEVELS and len(set(spots)) == len(spots)
        assert sum(4**level for level, _ in spots) == b - a
        if b - a < 5000:
            assert {d for level, k in spots for d in range(k * 4**level, (k + 1) * 4**level)} == set(range(a, b))


def test_plan_has_no_nested_loop(spark):
    facts, intervals = made(random.Random(2))
    joined = with_intervals(spark.createDataFrame(facts, FACTS), spark.createDataFrame(intervals, INTERVALS), ["k"])
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    everything = days_in_intervals(spark.createDataFrame(facts, FACTS).select("date"), spark.createDataFrame(intervals, INTERVALS))
    plan = everything._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_stay_in_proportion(spark):
    """A hot key of n intervals that overlap no day asked for makes rows in proportion to n."""
    day = dt.date(2020, 1, 1)
    for n in (200, 800):
        intervals = [("hot", day + dt.timedelta(2 * i), day + dt.timedelta(2 * i), i) for i in range(n)]
        facts = [("hot", day + dt.timedelta(2 * i + 1), i) for i in range(n)]
        got = with_intervals(spark.createDataFrame(facts, FACTS), spark.createDataFrame(intervals, INTERVALS), ["k"], how="inner")
        assert got.count() == 0
        nodes = spark.createDataFrame(intervals, INTERVALS).select(
            F.size(interval_nodes(_day("effective_from"), _day("effective_to") + 1))
        )
        assert {r[0] for r in nodes.collect()} == {1}


def test_rows_of_nodes_are_never_broadcast(spark):
    """They are many times the intervals, by whose size Spark would judge them."""
    facts, intervals = made(random.Random(3))
    for keys in (["k"], []):
        joined = days_in_intervals(spark.createDataFrame(facts, FACTS), spark.createDataFrame(intervals, INTERVALS), keys)
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().toString()


@pytest.mark.parametrize("open_ended", [False, True])
def test_stretches_count_as_the_intervals_do(spark, open_ended):
    facts, rows = made(random.Random(4), hot=True)
    days = sorted({f[1] for f in facts if f[1]})
    intervals = spark.createDataFrame(rows, INTERVALS)
    held = stretches(intervals, ["k"], "n", open_ended=open_ended)
    got = days_in_intervals(spark.createDataFrame([(d,) for d in days], "date date"), held, open_ended=open_ended)

    def holds(date, first, last):
        last = last or (dt.date.max if open_ended else None)
        return None not in (first, last) and first <= date <= last

    expected = Counter((d, i[0]) for d in days for i in rows if holds(d, i[1], i[2]))
    found = [(r.date, r.k, r.n) for r in got.select("date", "k", "n").collect()]
    assert sorted(found, key=str) == sorted(((d, k, n) for (d, k), n in expected.items()), key=str)


def test_apps_of_an_owner_meet_a_day_once(spark):
    """1,000 apps of one owner that all hold 20 days make 20 rows, where app by app they would make 20,000."""
    day = dt.date(2020, 1, 1)
    apps = spark.createDataFrame([(1, day, day + dt.timedelta(30), "Active", i) for i in range(1000)],
                                 "owner_user_uid int, effective_from date, effective_to date, status string, container_uid int")
    days = spark.createDataFrame([(day + dt.timedelta(i),) for i in range(20)], "date date")
    table = Tables({"date_dim": lambda: days, "workapp_interval": lambda: apps})
    result = CHECKS["workapp_valid_days"].build(table, FIXTURE_PARAMS)
    assert {tuple(r) for r in result.select("status", "apps", "owners").collect()} == {("Active", 1000, 1)} and result.count() == 20
    held = stretches(apps, ["status", "owner_user_uid"], "apps")
    assert days_in_intervals(days, held).count() == 20
