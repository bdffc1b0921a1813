"""Distinct counts that merge over months, as exact sets of values.

A set of whole numbers is rows of 64 numbers each, as the bits of one long; a text is a row of its own with one bit. Sets
are merged by OR and counted, so partial sets of months, plans or tasks add up to exactly the distinct values of all, each
row of facts is read once for all measures, and near numbers shrink to one row before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgauge.operators.state import MonthlyState

MEASURE, TEXT, WORD, BITS = "measure", "value_text", "value_word", "value_bits"
_VALUE = (MEASURE, TEXT, WORD)


def _value(name: str, is_text: bool) -> Column:
    """One value as a member of a set; NULL is the empty set, so its key is not lost."""
    number = F.lit(None).cast("long") if is_text else F.col(name).cast("long")
    text = F.col(name).cast("string") if is_text else F.lit(None).cast("string")
    bit = F.expr("1L") if is_text else F.call_function("shiftleft", F.expr("1L"), number.bitwiseAND(F.lit(63)).cast("int"))
    return F.struct(
        F.lit(name).alias(MEASURE),
        text.alias(TEXT),
        F.shiftright(number, 6).alias(WORD),
        F.when(F.col(name).isNotNull(), bit).otherwise(F.lit(0)).cast("long").alias(BITS),
    )


def value_sets(rows: DataFrame, keys: Sequence[str], numbers: Iterable[str], texts: Iterable[str] = ()) -> DataFrame:
    """Per key the sets of values of the named columns; every key has a row per measure at least."""
    values = [_value(c, False) for c in numbers] + [_value(c, True) for c in texts]
    members = rows.select(*keys, F.inline(F.array(*values)))
    return merged(members, keys)


def merged(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sets of equal keys become one: their union."""
    return sets.groupBy(*keys, *_VALUE).agg(F.bit_or(BITS).alias(BITS))


def counted(sets: DataFrame, keys: Sequence[str], names: Collection[str]) -> DataFrame:
    """Per key the number of values of each measure, once its sets are merged."""
    sizes = [F.sum(F.when(F.col(MEASURE) == name, F.bit_count(BITS)).otherwise(0)).alias(name) for name in names]
    return sets.groupBy(*keys).agg(*sizes)


@dataclass(frozen=True)
class MonthlyDistincts(MonthlyState):
    """Distinct numbers and texts by ``keys``, kept as sets per month."""

    keys: tuple[str, ...]
    numbers: tuple[str, ...]
    texts: tuple[str, ...] = ()
    month: str = "date"

    def of_months(self, rows: DataFrame) -> DataFrame:
        known = rows.where(F.col(self.month).isNotNull())
        return value_sets(known, [*self.keys, self.month], self.numbers, self.texts)

    def totals(self, stored: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
        """Distinct values over all stored months, per key or per some of the keys."""
        by = list(self.keys if by is None else by)
        return counted(merged(stored, by), by, [*self.numbers, *self.texts])


#: Departments and collaborator numbers of solutions, by account, so that those of chosen accounts can be merged.
SOLUTION_DISTINCTS = MonthlyDistincts(
    ("account_id", "solution_uid"), ("users_collab_internal", "users_collab_external"), ("department",)
)
