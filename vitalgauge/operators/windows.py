"""Whole-partition aggregates next to each row, without windows.

Every partition aggregate of the scorecards spans its whole partition. It is therefore a grouped
aggregate joined back to the rows: Spark pre-aggregates before the shuffle, distinct counts are
spread by value, and adaptive execution can split a hot partition key in the join. A window would
put a whole partition into one task, and cannot count distinct values at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.operators.joins import join_null_safe


def over_partition(rows: DataFrame, keys: Sequence[str], **aggregates: Column) -> DataFrame:
    """Rows with each aggregate computed over all rows with the same keys (NULL keys together)."""
    grouped = rows.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggregates.items()])
    return join_null_safe(rows, grouped, keys)


def count_distinct_if(
    rows: DataFrame, keys: Sequence[str], subject: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """Per key: for each condition, how many distinct subjects it ever holds for.

    All conditions share one pre-aggregation by keys and subject, where each becomes one flag.
    """
    flags = rows.where(F.col(subject).isNotNull()).groupBy(*keys, subject).agg(
        *[F.max(F.coalesce(condition, F.lit(False))).alias(name) for name, condition in conditions.items()]
    )
    return flags.groupBy(*keys).agg(*[F.count_if(name).alias(name) for name in conditions])


def count_distinct_if_over(
    rows: DataFrame, keys: Sequence[str], subject: str, conditions: Mapping[str, Column]
) -> DataFrame:
    """:func:`count_distinct_if` next to each row."""
    counted = count_distinct_if(rows, keys, subject, conditions)
    return join_null_safe(rows, counted, keys).withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in conditions}
    )
