"""Plans stay right, and grow only linearly, when single keys hold a large share of all rows."""

from __future__ import annotations

import pytest
from compare import TABLES, differences, duck

import __spark_entry__ as contract

PLANS = [
    "adoption_kpis_v1", "adoption_scorecard_mobile", "adoption_scorecard_mobile_ci", "wide_star_join",
    "account_month_snapshot_container", "account_month_snapshot_interval", "work_type_monthly_grid",
    "hvt_self_join", "workapp_interval_join", "workapp_month_join", "windowed_conditional_distinct",
    "percent_rank_presence", "mobile_user_plans", "workapp_interval_rows", "workapp_valid_days", "heavy_key_join",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The small tables with a hot plan, month, solution, owner and user, and with NULL ids."""
    folder = tmp_path_factory.mktemp("skewed")
    con = duck("/root/testdata/sf0.001")
    changed = {
        "orders": """SELECT * REPLACE (
            CASE WHEN o_orderkey % 3 = 0 THEN 11 WHEN o_orderkey % 3 = 1 THEN o_custkey % 30 ELSE o_custkey END AS o_custkey,
            CASE WHEN o_orderkey % 12 = 0 THEN TIMESTAMP '2001-07-10' ELSE o_orderdate END AS o_orderdate)
            FROM orders""",
        "lineitem": """SELECT * REPLACE (
            CASE WHEN l_orderkey % 7 = 0 THEN 3 WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_partkey END AS l_partkey,
            CASE WHEN l_orderkey % 4 = 0 THEN 5 WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey)
            FROM lineitem""",
        "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 11 ELSE user_id END AS user_id) FROM events""",
    }
    for table in TABLES:
        query = changed.get(table, f"SELECT * FROM {table}")
        con.execute(f"COPY ({query}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("key", PLANS)
def test_skewed_input(key, spark, skewed_dir):
    result = contract.queries()[key](spark, skewed_dir)
    assert differences(result, duck(skewed_dir), contract.oracle_sql()[key]) is None
