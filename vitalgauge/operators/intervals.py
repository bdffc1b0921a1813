"""Joins of dates to the intervals that hold them, as rows.

Days are leaves of a tree in which each node has ``2 ** _BITS`` children. The days of an interval are the leaves of a few
whole subtrees, ``2 * (2 ** _BITS - 1)`` per level at most, and a day lies in exactly one of them if the interval holds it. So a
match is an equality of nodes: each interval gets a row per subtree, each distinct day a row per level, and an
equi-join on key and node finds every pair once, and nothing else. No row is compared with another in vain, an interval of
a thousand years has no more nodes than any other, and nodes spread the intervals of one hot key, or of no key at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BITS = 2
#: Levels that hold all days of the years 1 to 9999.
_LEVELS = 12
#: Places of the level in a node's number.
_LEVEL_AT = 40


def _day(date: str) -> Column:
    """Days since the first of January of year 1."""
    return F.date_diff(F.col(date), F.lit("0001-01-01").cast("date")).cast("long")


def _node(level: int, number: Column) -> Column:
    return number + F.lit(level << _LEVEL_AT)


def _between(start: Column, end: Column, level: int) -> Column:
    """Nodes ``start`` to ``end`` (not included) of a level, as an array."""
    numbers = F.when(start < end, F.sequence(start, end - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda n: _node(level, n))


def day_nodes(date: str) -> Column:
    """The nodes above a day, itself included."""
    return F.array(*[_node(level, F.shiftright(_day(date), level * _BITS)) for level in range(_LEVELS)])


def interval_nodes(start: Column, end: Column) -> Column:
    """The largest subtrees that make up the days ``start`` to ``end`` (not included), given as day numbers."""

    def inner(level: int) -> tuple[Column, Column]:
        size = 1 << (level * _BITS)
        return F.shiftright(start + (size - 1), level * _BITS), F.shiftright(end, level * _BITS)

    parts = []
    for level in range(_LEVELS):
        low, high = inner(level)
        if level + 1 == _LEVELS:
            parts.append(_between(low, high, level))
            continue
        # what the level above leaves over on the left and on the right; all of it where it has nothing inside
        above_low, above_high = (F.shiftleft(x, _BITS) for x in inner(level + 1))
        left_end = F.least(above_low, high)
        parts += [_between(low, left_end, level), _between(F.greatest(above_high, left_end, low), high, level)]
    return F.concat(*parts)


def days_in_intervals(
    days: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    start: str = "effective_from",
    end: str = "effective_to",
    open_ended: bool = False,
) -> DataFrame:
    """Each distinct ``keys, date`` of ``days`` with each interval of the same keys that holds the date, both ends included.

    ``keys`` may be empty: then all intervals are looked at for each date. NULL keys, dates and starts match nothing; an
    interval without an end matches nothing, or with ``open_ended`` all days from its start on. Repeated
    intervals match repeatedly. Columns of ``intervals`` other than the keys stand next to keys and date.
    """
    last = F.coalesce(F.col(end), F.lit("9999-12-31").cast("date")) if open_ended else F.col(end)
    bounds = intervals.dropna(subset=[*keys, start]).withColumn("_last", last).where(F.col("_last") >= F.col(start))
    left = bounds.withColumn("_node", F.explode(interval_nodes(_day(start), _day("_last") + 1))).drop("_last")
    # Spark judges the size of the nodes' rows by that of the intervals, some twelve times too small: never broadcast them.
    left = left.hint("merge")
    right = days.select(*keys, date).dropna().distinct().withColumn("_node", F.explode(day_nodes(date)))
    return right.join(left, [*keys, "_node"]).drop("_node")


def with_intervals(
    rows: DataFrame, intervals: DataFrame, keys: Sequence[str], date: str = "date", how: str = "left", open_ended: bool = False
) -> DataFrame:
    """``rows`` joined (``how``: left or inner) to the intervals of the same keys that hold their date, as rows.

    Only distinct keys and dates meet the intervals; the pairs found are then joined to ``rows`` on keys and date, so
    the work grows with the input and the rows that come out.
    """
    pairs = days_in_intervals(rows, intervals, keys, date, open_ended=open_ended)
    return rows.join(pairs, [*keys, date], how)


def stretches(
    intervals: DataFrame,
    keys: Sequence[str],
    name: str,
    start: str = "effective_from",
    end: str = "effective_to",
    open_ended: bool = False,
) -> DataFrame:
    """Per ``keys``, NULL keys too: stretches of days held by the same number (``name``, never 0) of intervals, both ends included.

    Stretches of the same keys share no day, so a day meets them once, however many intervals hold it. With
    ``open_ended`` an interval without an end holds all days from its start on, and the stretch without a later change has
    no end; otherwise it counts for nothing. The number is a running sum of starts and ends, which are summed per keys and day before the
    window: a window partition holds at most one row per calendar day.
    """
    valid = F.col(end) >= F.col(start)
    if open_ended:
        valid = valid | F.col(end).isNull()
    steps = F.array(
        F.struct(F.col(start).alias("_day"), F.lit(1).alias("_step")),
        F.struct(F.date_add(end, 1).alias("_day"), F.lit(-1).alias("_step")),
    )
    changes = intervals.where(F.col(start).isNotNull() & valid).select(*keys, F.explode(steps).alias("_change")).select(*keys, "_change.*")
    per_day = changes.where(F.col("_day").isNotNull()).groupBy(*keys, "_day").agg(F.sum("_step").alias("_step")).where("_step != 0")
    in_order = Window.partitionBy(*keys).orderBy("_day")
    counted = per_day.select(
        *keys,
        F.col("_day").alias(start),
        F.date_sub(F.lead("_day").over(in_order), 1).alias(end),
        F.sum("_step").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias(name),
    )
    return counted.where(F.col(name) > 0)
