"""Distinct counts as sets of bits: exact, mergeable over months, without multiplied rows."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from vitalgauge.operators.distincts import SOLUTION_DISTINCTS, MonthlyDistincts, counted, value_sets
from vitalgauge.plans.adoption import solution_distincts

SCHEMA = "k int, date date, n long, t string"
EDGES = [0, 1, 63, 64, 65, -1, -63, -64, -65, 2**62, -(2**62), 2**63 - 1, -(2**63), None]


def brute(rows, keep=lambda r: True):
    out = {}
    for k, d, n, t in rows:
        if keep((k, d, n, t)):
            found = out.setdefault(k, (set(), set()))
            found[0].add(n)
            found[1].add(t)
    return {k: (len(n - {None}), len(t - {None})) for k, (n, t) in out.items()}


def random_rows(months, size, seed=5):
    rng = random.Random(seed)
    texts = ["", " ", "a", "A", "é", "x" * 300, None]
    return [
        (rng.choice([1, 2, 3, None]), rng.choice(months), rng.choice([*EDGES, rng.randrange(-200, 200)]), rng.choice(texts))
        for _ in range(size)
    ]


def as_dict(df):
    return {r["k"]: (r["n"], r["t"]) for r in df.collect()}


def test_sets_count_distinct_values(spark):
    rows = [*random_rows([dt.date(2001, 1, 1)], 600), (9, dt.date(2001, 1, 1), None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(counted(value_sets(df, ["k"], ["n"], ["t"]), ["k"], ["n", "t"]))
    assert got == brute(rows) and got[9] == (0, 0)
    assert as_dict(counted(value_sets(df.limit(0), ["k"], ["n"], ["t"]), ["k"], ["n", "t"])) == {}


def test_months_merge_to_the_counts_of_all(spark, tmp_path):
    months = [dt.date(2001, m, 1) for m in range(1, 5)]
    rows = random_rows([*months, None], 800)
    df, kept, path = spark.createDataFrame(rows, SCHEMA), MonthlyDistincts(("k",), ("n",), ("t",)), str(tmp_path / "sets")
    kept.begin(df.where(F.col("date") == F.lit(months[0])), path)
    for month in [*months[1:], months[2]]:
        kept.update(df, path, [month], f"run of {month}")
    assert as_dict(kept.totals(kept.read(spark, path))) == brute(rows, lambda r: r[1])
    corrected = df.where("k = 1")
    assert kept.update(corrected, path, [months[1]], "correction")
    expected = brute(rows, lambda r: r[1] and (r[1] != months[1] or r[0] == 1))
    assert as_dict(kept.totals(kept.read(spark, path))) == expected


def test_sets_of_several_accounts_merge(spark):
    day = dt.date(2001, 1, 1)
    rows = [(a, 7, day, a % 2, 5, f"d{a % 3}") for a in range(6)]
    df = spark.createDataFrame(rows, "account_id int, solution_uid int, date date, users_collab_internal int, users_collab_external int, department string")
    got = SOLUTION_DISTINCTS.totals(SOLUTION_DISTINCTS.of_months(df), by=["solution_uid"]).collect()
    assert [tuple(r) for r in got] == [(7, 2, 1, 3)]


def test_no_expand_and_near_numbers_share_a_row(spark):
    df = spark.range(0, 20_000).selectExpr(
        "cast(id % 3 AS string) AS solution_key", "id % 50 AS users_collab_internal", "id % 7 AS users_collab_external",
        "cast(id % 5 AS string) AS department",
    )
    result = solution_distincts(df)
    assert "Expand" not in result._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in result.collect()} == {(str(k), 50, 7, 5) for k in range(3)}
    # near numbers are one row: far fewer rows are stored than there are distinct values
    assert value_sets(df, ["solution_key"], ["users_collab_internal", "users_collab_external"]).count() == 6
