"""Replacing months of a written result, sums kept per month, and the stored layout of facts."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from vitalgauge.operators import joins, state
from vitalgauge.sources import layout
from vitalgauge.sources.shared import shared_path
from vitalgauge.sources.sink import replace_months, runs_done, write_by_month

CARD = "account_id int, year_month string, v int"


def card(spark, rows):
    return spark.createDataFrame(rows, CARD)


def written(spark, path):
    return sorted(map(tuple, spark.read.schema(CARD).parquet(path).select("account_id", "year_month", "v").collect()))


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "card")
    write_by_month(card(spark, [(a, m, 1) for a in (1, 2) for m in ("2001-01", "2001-02", "2001-03")]), path)
    return path


def files_of(tmp_path, month):
    return {(f.name, f.stat().st_mtime_ns) for f in (tmp_path / "card" / f"year_month={month}").iterdir()}


def test_other_months_stay_as_they_are(spark, path, tmp_path):
    before = files_of(tmp_path, "2001-01")
    rows = card(spark, [(1, "2001-02", 7), (3, "2001-02", 8), (9, "2001-03", 9)])
    assert replace_months(rows, path, ["2001-02"], "run-1")
    expected = [(1, "2001-01", 1), (1, "2001-02", 7), (1, "2001-03", 1), (2, "2001-01", 1), (2, "2001-03", 1), (3, "2001-02", 8)]
    assert written(spark, path) == expected and files_of(tmp_path, "2001-01") == before


def test_a_run_that_is_done_is_not_repeated(spark, path):
    assert replace_months(card(spark, [(1, "2001-02", 7)]), path, ["2001-02"], "run-1")
    assert not replace_months(card(spark, [(1, "2001-02", 99)]), path, ["2001-02"], "run-1")
    assert (1, "2001-02", 7) in written(spark, path) and runs_done(spark, path) == {"run-1"}
    assert replace_months(card(spark, [(1, "2001-02", 5)]), path, ["2001-02"], "run-2")
    assert (1, "2001-02", 5) in written(spark, path)


def test_a_failed_run_leaves_the_old_rows(spark, path):
    before = written(spark, path)
    rows = spark.range(0, 4000, 1, 4).selectExpr("cast(id AS int) AS account_id", "'2001-02' AS year_month", "cast(id AS int) AS v")
    failing = rows.withColumn("v", F.when(F.col("v") < 3990, F.col("v")).otherwise(F.raise_error(F.lit("no")).cast("int")))
    with pytest.raises(Exception, match="no"):
        replace_months(failing, path, ["2001-02"], "run-1")
    assert written(spark, path) == before and runs_done(spark, path) == set()
    assert replace_months(rows, path, ["2001-02"], "run-1")
    assert len(written(spark, path)) == 4 + 4000


def test_a_month_without_rows_is_emptied(spark, path):
    assert replace_months(card(spark, [(5, "2001-03", 5)]), path, ["2001-02", "2001-03", "2001-04"], "run-1")
    assert written(spark, path) == [(1, "2001-01", 1), (2, "2001-01", 1), (5, "2001-03", 5)]


def test_month_by_month_equals_all_at_once(spark, tmp_path):
    months = [dt.date(2001, m, 1) for m in range(1, 6)]
    rows = spark.range(0, 3000, 1, 3).selectExpr(
        "nullif(id % 7, 6) AS owner_uid", "nullif(id % 5, 4) AS solution_uid", "date_add(DATE'2001-01-01', 0) AS d", "id"
    )
    rows = rows.select("owner_uid", "solution_uid", F.trunc(F.add_months("d", (F.col("id") % 5).cast("int")), "month").alias("date"))
    facts, kept, path = str(tmp_path / "facts"), state.OWNER_SOLUTIONS, str(tmp_path / "state")
    rows.write.partitionBy("date").parquet(facts)
    facts = spark.read.parquet(facts)
    kept.begin(facts.where(F.col("date") == F.lit(months[0])), path)
    for month in [*months[1:], months[2]]:
        kept.update(facts, path, [month], f"run of {month}")
    expected = sorted(map(tuple, facts.groupBy("owner_uid").agg(F.count("solution_uid")).collect()), key=str)
    assert sorted(map(tuple, kept.totals(kept.read(spark, path)).collect()), key=str) == expected
    # a corrected month takes the place of its old sums, and only that month is read
    corrected = facts.where(F.col("owner_uid") == 1)
    assert kept.update(corrected, path, months[1:2], "correction")
    plan = kept.of_months(facts.where(F.col("date").isin(months[1:2])))._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*= 2001-02-01", plan)
    kept_rows = facts.where((F.col("owner_uid") == 1) | (F.col("date") != F.lit(months[1])))
    expected = sorted(map(tuple, kept_rows.groupBy("owner_uid").agg(F.count("solution_uid")).collect()), key=str)
    assert sorted(map(tuple, kept.totals(kept.read(spark, path)).collect()), key=str) == expected


def test_stored_facts_join_without_a_shuffle(spark):
    days = [dt.date(2001, m, 1) for m in (1, 2, 3)]
    solutions = spark.createDataFrame([(s, s % 13 or None, days[s % 3]) for s in range(300)], "solution_uid int, plan_uid long, date date")
    daily = spark.createDataFrame([(p, d, p * 10) for p in range(13) for d in days], "plan_uid long, date date, users_licensed int")
    folder = shared_path(spark, "layout")
    names = {"s": f"s_{folder[-8:]}", "d": f"d_{folder[-8:]}"}
    layout.write_fact(solutions, names["s"], f"{folder}/s", buckets=4)
    layout.write_fact(daily, names["d"], f"{folder}/d", buckets=4)
    for name, months in (("s", 3), ("d", 3)):
        files = spark.table(names[name]).select("_metadata.file_path", "date").distinct().collect()
        assert len(files) <= months * 4 and len({f[0] for f in files}) == len(files)
    wanted = F.col("date") >= F.lit(days[1])
    with layout.joined_by_bucket(spark):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            joined = joins.solution_plan_month(spark.table(names["s"]).where(wanted), spark.table(names["d"]))
            got = sorted(map(tuple, joined.select("solution_uid", "plan_uid", "users_licensed").collect()), key=str)
            plan = joined._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted([(s, s % 13 or None, s % 13 * 10 or None) for s in range(300) if s % 3], key=str)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert plan.count("PartitionFilters: [isnotnull(date") == 2 and plan.count("SelectedBucketsCount: 4 out of 4") == 2
