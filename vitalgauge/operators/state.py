"""Aggregates over all time, kept per month.

A sum or count over all history is the sum of its months. These are stored, one row per key and month; a run reads the rows
of its own months, replaces their sums, and adds up what is stored. So history is read once, and a month that is run again,
or whose rows were corrected, counts once. Distinct counts are kept in the same way, see :mod:`vitalgauge.operators.distincts`.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.sources.sink import replace_months, write_by_month


class MonthlyState:
    """What is stored per month; a subclass tells how months are made and put together."""

    keys: tuple[str, ...]
    month: str

    def of_months(self, rows: DataFrame) -> DataFrame:
        """What is kept, per key and month; rows without a month are in none."""
        raise NotImplementedError

    def begin(self, rows: DataFrame, path: str) -> None:
        """Store all months of ``rows``."""
        write_by_month(self.of_months(rows), path, self.month, self.keys[0])

    def update(self, rows: DataFrame, path: str, months: Collection, run: str) -> bool:
        """Replace what is stored of ``months`` by that of their rows; only these are read. See :func:`replace_months`."""
        wanted = rows.where(F.col(self.month).isin(list(months)))
        return replace_months(self.of_months(wanted), path, months, run, self.month, self.keys[0])

    def read(self, spark: SparkSession, path: str) -> DataFrame:
        return spark.read.parquet(path)


@dataclass(frozen=True)
class MonthlySums(MonthlyState):
    """Sums of rows by ``keys``; ``sums`` has, by name, a SQL aggregate whose monthly values add up (sum, count, count_if)."""

    keys: tuple[str, ...]
    sums: Mapping[str, str]
    month: str = "date"

    def of_months(self, rows: DataFrame) -> DataFrame:
        """Sums per key and month; rows without a month are in none."""
        aggregates = [F.expr(sql).alias(name) for name, sql in self.sums.items()]
        return rows.where(F.col(self.month).isNotNull()).groupBy(*self.keys, self.month).agg(*aggregates)

    def totals(self, stored: DataFrame) -> DataFrame:
        """Sums over all stored months."""
        return stored.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in self.sums])


#: Revenue of accounts, from daily plan facts with the account of the plan.
ACCOUNT_ARR = MonthlySums(("account_id",), {"total_arr": "sum(plan_arr)"})
#: Solution months of owners.
OWNER_SOLUTIONS = MonthlySums(("owner_uid",), {"total_solutions_per_owner": "count(solution_uid)"})
