"""Scalar helpers. Each takes and returns columns, and stays inside Spark's generated code."""

from __future__ import annotations

import datetime as dt
import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# The lowest percentile rank of each band and its points. A rank above 0 but below
# the lowest band gets 1 point, everything else 0.
SCORE_BANDS: tuple[tuple[float, int], ...] = ((0.90, 7), (0.70, 4), (0.35, 3))

# Region prefixes of plan ids.
PLAN_ID_PREFIXES: tuple[str, ...] = ("plan.com-us.", "plan.com-eu.")


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


def year_month_label(year: ColumnLike, month: ColumnLike) -> Column:
    """``2001`` and ``7`` -> ``2001-07``; NULL if either is NULL."""
    return F.concat(_col(year).cast("string"), F.lit("-"), F.lpad(_col(month).cast("string"), 2, "0"))


def format_month(date: ColumnLike) -> Column:
    """Date -> ``yyyy-MM``."""
    return F.date_format(_col(date), "yyyy-MM")


def date_parts(date: ColumnLike) -> tuple[Column, Column]:
    """Year and month of a date, as integers."""
    return F.year(_col(date)), F.month(_col(date))


def months_before(date: dt.date | Column, months: int) -> Column:
    """The date ``months`` earlier; the day is clipped to the end of the month."""
    return F.add_months(F.lit(date), -months)


def days_before(date: dt.date | Column, days: int) -> Column:
    return F.date_sub(F.lit(date), days)


def third_token(identifier: ColumnLike) -> Column:
    """Third dot-separated token of an id; empty text when there are fewer."""
    return F.split_part(_col(identifier), F.lit("."), F.lit(3))


def plan_key(plan_uid: ColumnLike) -> Column:
    """Plan id as text, with its region prefix if it has one; NULL for an empty id."""
    text = _col(plan_uid).cast("string")
    return F.when(text != "", text)


def plan_keys(owner_plan_uid: ColumnLike) -> Column:
    """All :func:`plan_key` values that an owner's plan id answers to, as an array: the id itself, and the number
    alone where the id is a region prefix and a number, as plans without a prefix have it. Ids of two regions
    with one number therefore never match each other, and an id of another form matches only itself."""
    text = _col(owner_plan_uid).cast("string")
    bare = F.when(F.regexp_like(text, F.lit(r"^[^.]+\.[^.]+\.[^.]+$")), third_token(text))
    return F.array_compact(F.array(plan_key(text), bare))


def strip_id_prefix(identifier: ColumnLike) -> Column:
    """Id with every region prefix taken out."""
    return functools.reduce(
        lambda text, prefix: F.replace(text, F.lit(prefix), F.lit("")),
        PLAN_ID_PREFIXES,
        _col(identifier).cast("string"),
    )


def normalize_department(department: ColumnLike) -> Column:
    return F.replace(_col(department), F.lit(" "), F.lit("_"))


def round_arr(arr: ColumnLike) -> Column:
    """Money rounded half up to whole units."""
    return F.round(_col(arr), 0)


def text_not_empty(text: ColumnLike) -> Column:
    return F.length(_col(text)) > 0


def contains_text(text: ColumnLike, part: str) -> Column:
    return F.position(F.lit(part), _col(text)) > 0


def array_not_empty(array: ColumnLike) -> Column:
    return F.array_size(_col(array)) > 0


def sum_columns(*columns: ColumnLike) -> Column:
    """Sum of columns; NULL if any is NULL."""
    return functools.reduce(operator.add, [_col(c) for c in columns])


def concat_label(name: ColumnLike, detail: ColumnLike) -> Column:
    """``name (detail)``; NULL if either is NULL."""
    return F.concat(_col(name), F.lit(" ("), _col(detail), F.lit(")"))


def json_path(document: ColumnLike, path: str) -> Column:
    """Value at a fixed path of a JSON text as text; NULL where the path is missing."""
    return F.get_json_object(_col(document), f"$.{path}")


def case_flag(predicate: Column, then: object = 1, otherwise: object = 0) -> Column:
    """``then`` where the predicate holds, else ``otherwise`` (also where it is NULL)."""
    return F.when(predicate, then).otherwise(otherwise)


def coalesce_first(*columns: ColumnLike, default: object = None) -> Column:
    """First non-NULL of the columns, then the default."""
    picked = [_col(c) for c in columns]
    return F.coalesce(*picked, F.lit(default)) if default is not None else F.coalesce(*picked)


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike, scale: int = 1) -> Column:
    """``numerator / denominator * scale`` as double; NULL where the denominator is 0 or NULL."""
    ratio = _col(numerator).cast("double") / F.nullif(_col(denominator).cast("double"), F.lit(0.0))
    return ratio * scale if scale != 1 else ratio


def exact_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient of two whole numbers to 18 places, as decimal: equal ratios are equal, however large both sides are.

    NULL where the denominator is 0 or NULL, and where the quotient or its remainders don't fit a decimal.
    """
    wide, digits = "decimal(38,0)", F.lit(10**9).cast("decimal(10,0)")
    rest = _col(numerator).cast(wide)
    divisor = F.nullif(_col(denominator).cast(wide), F.lit(0).cast(wide))
    parts = []
    for _ in range(3):  # whole part, and twice nine digits, by long division
        left = rest % divisor
        parts.append(((rest - left) / divisor).try_cast("decimal(19,0)"))
        rest = F.try_multiply(left, digits).try_cast(wide)
    whole, first, second = parts
    nine, eighteen = (F.lit(x).cast("decimal(18,18)") for x in ("0.000000001", "0.000000000000000001"))
    fraction = first.cast("decimal(9,0)") * nine + second.cast("decimal(9,0)") * eighteen
    return F.try_add(whole.cast("decimal(37,18)"), fraction.cast("decimal(37,18)"))


def band_score(rank: ColumnLike, bands: Sequence[tuple[float, int]] = SCORE_BANDS) -> Column:
    """Points for a percentile rank."""
    rank = _col(rank)
    ordered = sorted(bands, reverse=True)
    score = F.when(rank >= ordered[0][0], ordered[0][1])
    for lowest, points in ordered[1:]:
        score = score.when(rank >= lowest, points)
    return score.when(rank > 0, 1).otherwise(0)
