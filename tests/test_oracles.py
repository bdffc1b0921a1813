"""Every registered query equals its DuckDB oracle: names, types, rows and values."""

from __future__ import annotations

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from vitalgauge.checks import CHECKS


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_query_equals_oracle(key, spark, sf_dir, con):
    result = contract.queries()[key](spark, sf_dir)
    assert differences(result, con, contract.oracle_sql()[key]) is None


def test_entry_is_the_ranked_flagship(spark):
    df = contract.entry(spark)
    assert {"account_id", "year_month", "score_active_users_mobile_sessions"} <= set(df.columns)
    assert sum(c.startswith("pct_rank_") for c in df.columns) == 20
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert CHECKS.keys() <= contract.queries().keys() & contract.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
