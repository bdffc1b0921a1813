"""Shape of physical plans, over stored tables with the production columns."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

from vitalgauge import FIXTURE_PARAMS, Tables
from vitalgauge.operators import filters
from vitalgauge.plans import adoption, snapshot, work_grid
from vitalgauge.plans.kpis import EDITIONS
from vitalgauge.sources import shared
from vitalgauge.sources.fixture import fixture_tables
from vitalgauge.sources.sink import write_by_month
from vitalgauge.tables import TABLE_COLUMNS


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The ten tables, written out as Parquet and opened by path."""
    folder = str(tmp_path_factory.mktemp("tables"))
    source = fixture_tables(spark, sf_dir)
    for name in TABLE_COLUMNS:
        source[name].write.parquet(f"{folder}/{name}.parquet")
    return Tables.from_parquet(spark, folder)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_have_the_documented_columns(stored):
    for name, columns in TABLE_COLUMNS.items():
        assert set(columns) <= set(stored[name].columns), name
    with pytest.raises(AttributeError):
        stored.no_such_table


def test_tables_from_catalog(spark, stored):
    stored.plan.createOrReplaceTempView("some_plan")
    assert Tables.from_catalog(spark, {"plan": "some_plan"}).plan.count() == stored.plan.count()


def test_stored_tables_give_the_same_scorecard(spark, sf_dir, stored):
    name = "adoption_scorecard_mobile"
    mine = adoption.adoption_scorecard(stored, FIXTURE_PARAMS, name)
    derived = adoption.adoption_scorecard(fixture_tables(spark, sf_dir), FIXTURE_PARAMS, name)
    assert mine.exceptAll(derived).isEmpty() and derived.exceptAll(mine).isEmpty()


def test_filters_reach_the_scan(stored):
    plan = physical(filters.filtered_solutions(stored.solution_monthly, dt.date(2001, 8, 1)).select("solution_uid"))
    assert "GreaterThanOrEqual(quarters_active,1)" in plan
    assert "LessThanOrEqual(date,2001-08-01)" in plan
    assert "IsNotNull(plan_uid)" in plan
    assert "ReadSchema: struct<solution_uid:bigint,date:date,plan_uid:bigint,quarters_active:int>" in plan


def test_month_filter_reaches_the_scan(stored):
    plan = physical(filters.month_equals(stored.solution_monthly, dt.date(2001, 12, 15)).select("solution_uid"))
    assert "GreaterThanOrEqual(date,2001-12-01), LessThan(date,2002-01-01)" in plan


def test_window_of_months_reaches_the_fact_scan(stored):
    rows = adoption.solution_activity(stored, FIXTURE_PARAMS, EDITIONS["adoption_scorecard_mobile"])
    facts = [line for line in physical(rows).splitlines() if "users_hvt" in line and "PushedFilters" in line]
    assert facts and all("GreaterThanOrEqual(date,1999-08-01)" in line for line in facts)
    assert all("integrations:array" not in line for line in facts)


@pytest.mark.parametrize("name", ["adoption_kpis_v1", "adoption_scorecard_mobile"])
def test_scorecards_have_no_global_step(stored, name):
    text = physical(adoption.adoption_scorecard(stored, FIXTURE_PARAMS, name))
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF"):
        assert bad not in text


def test_snapshot_and_grid_have_no_cross_join(stored):
    for df in (
        snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "container"),
        snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "interval"),
        work_grid.work_type_monthly_grid(stored, FIXTURE_PARAMS),
    ):
        text = physical(df)
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_snapshot_of_chosen_accounts(stored):
    everyone = snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "interval").collect()
    chosen = everyone[0]["account_id"]
    rows = snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "interval", accounts=[chosen]).collect()
    assert [r["account_id"] for r in rows] == [chosen]


def test_only_real_mobile_users_when_required(stored):
    def users(require):
        rows = snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "interval", require_mobile=require).collect()
        return sum(r["mobile_users_count"] or 0 for r in rows)

    assert users(True) <= users(False)


def test_null_kpis_can_rank_first(stored):
    rows = adoption.adoption_scorecard(stored, FIXTURE_PARAMS, "adoption_scorecard", nulls_last=False)
    nulls = rows.where("pct_internal_collaborator IS NULL").select("pct_rank_internal_collaborator").collect()
    assert nulls and all(r[0] == 0.0 for r in nulls)


def test_scorecard_is_written_by_month(spark, stored, tmp_path):
    rows = adoption.adoption_scorecard(stored, FIXTURE_PARAMS, "adoption_kpis_v1").select("account_id", "year_month")
    write_by_month(rows, str(tmp_path / "out"))
    folders = {p.name for p in (tmp_path / "out").iterdir() if p.is_dir()}
    assert folders == {f"year_month={r[0]}" for r in rows.select("year_month").distinct().collect()}


def test_shared_results_use_the_configured_folder(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir")
    df = shared.share(spark.range(5).selectExpr("id", "id * 2 AS twice"), "small")
    assert df.inputFiles()[0].startswith(f"file://{configured}/{spark.sparkContext.applicationId}/small-")
    assert sorted(map(tuple, df.collect())) == [(i, 2 * i) for i in range(5)]


def test_error_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(shared, "configured_folder", lambda _: None)
    with pytest.raises(shared.NoSharedFolder, match="spark.checkpoint.dir"):
        shared.share(spark.range(3), "x")


def on_a_cluster(spark, monkeypatch, named):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(shared, "_found", {})
    monkeypatch.setattr(shared, "_named_folder", lambda _: named and str(named))


def test_shared_folder_without_a_scheme_on_a_cluster(spark, monkeypatch, tmp_path):
    on_a_cluster(spark, monkeypatch, tmp_path)
    df = shared.share(spark.range(5), "plain")
    assert df.count() == 5 and df.inputFiles()[0].startswith(f"file://{tmp_path}/")


def test_set_checkpoint_dir_overrides_the_setting(spark, tmp_path):
    setting = spark.conf.get("spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(str(tmp_path / "set"))
    try:
        assert f"{tmp_path}/set/" in shared.share(spark.range(5), "set").inputFiles()[0]
    finally:
        spark.sparkContext.setCheckpointDir(setting)


def test_warehouse_has_the_shared_folder_of_a_cluster_without_one(spark, monkeypatch):
    on_a_cluster(spark, monkeypatch, None)
    shared.use_local_folder(spark)
    df = shared.share(spark.range(5), "unnamed")
    assert df.count() == 5 and "/vitalgauge-shared/" in df.inputFiles()[0]
    shared.clear_shared(spark)


def test_folders_that_executors_cannot_share_are_not_used(spark, monkeypatch, tmp_path):
    on_a_cluster(spark, monkeypatch, tmp_path)
    (tmp_path / "file").write_text("no folder")
    assert not shared.is_shared(spark, str(tmp_path / "file"))
    monkeypatch.setattr(shared, "is_shared", lambda *_: False)
    with pytest.raises(shared.NoSharedFolder, match="spark.checkpoint.dir"):
        shared.share(spark.range(3), "x")


def test_shared_results_of_a_block_are_removed(spark):
    with shared.shared_for(spark):
        path = shared.share(spark.range(3), "short").inputFiles()[0]
        assert Path(path.removeprefix("file://")).exists()
    assert not Path(path.removeprefix("file://")).exists()


def test_shared_results_can_be_cleared(spark):
    df = shared.share(spark.range(3).toDF("id"), "gone")
    assert df.count() == 3
    shared.clear_shared(spark)
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / spark.sparkContext.applicationId
    assert not folder.exists()
    assert shared.share(spark.range(2).toDF("id"), "again").count() == 2


def scans(df, table):
    """The lines of a plan that scan one stored table."""
    return [line for line in physical(df).splitlines() if "PushedFilters" in line and f"/{table}.parquet" in line]


def test_grid_reads_the_last_months_only(stored):
    rows = work_grid.account_work_types(stored, FIXTURE_PARAMS)
    facts = [line for line in scans(rows, "plan_daily") + scans(rows, "solution_plan_monthly") if "licensed" in line or "days_edit" in line]
    assert len(facts) == 2 and all("GreaterThanOrEqual(date,1999-08-01)" in line for line in facts)
    objects = scans(work_grid.object_data(stored, FIXTURE_PARAMS), "solution_plan_monthly")
    assert objects and all("GreaterThanOrEqual(date,1999-08-01)" in line for line in objects)
    types = scans(work_grid.known_work_types(stored, FIXTURE_PARAMS), "solution_plan_monthly")
    assert types and all("days_edit" not in line and "premium_apps" not in line for line in types)
    assert "SinglePartition" not in physical(work_grid.work_type_monthly_grid(stored, FIXTURE_PARAMS))


def test_work_apps_are_pruned_by_date(stored):
    (scan,) = scans(adoption.recent_apps(stored, FIXTURE_PARAMS), "workapp_interval")
    assert "GreaterThanOrEqual(effective_from,1999-08-01)" in scan


def test_snapshot_scans_its_facts_once(stored):
    month = snapshot.month_rows(stored, FIXTURE_PARAMS)
    for table in ("solution_monthly", "plan_daily"):
        (scan,) = scans(month, table)
        assert "date" in scan.split("PushedFilters")[1]
    rest = snapshot.account_month_snapshot(stored, FIXTURE_PARAMS, "interval")
    assert not scans(rest, "solution_monthly") and not scans(rest, "plan_daily")


def test_entries_of_maps_are_dealt_before_they_are_summed(spark, sf_dir):
    """Summed ahead of the shuffle, nearly all entries of a task would be held in memory, whatever Spark sizes its tasks by."""
    maps = fixture_tables(spark, sf_dir).solution_plan_monthly.select("plan_uid", "date", "work_type", "premium_apps")
    lines = physical(maps).splitlines()
    (dealt,) = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
    (exploded,) = [i for i, line in enumerate(lines) if "Generate explode" in line]
    assert dealt < exploded and not any("HashAggregate" in line for line in lines[dealt:exploded])
