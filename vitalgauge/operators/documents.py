"""Semi-structured columns: JSON texts parsed once into VARIANT, then read by path or flattened.

Reading a path from a VARIANT looks it up in place, where a JSON function on text parses the whole text for each path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(rows: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``rows`` with the JSON text of ``column`` as VARIANT (in its place, or as ``name``); NULL where it is no JSON."""
    return rows.withColumn(name or column, F.try_parse_json(F.col(column)))


def _path(key: str) -> str:
    return "$" + "".join(f'["{part}"]' for part in key.split("."))


def value_at(variant: str, keys: str | Sequence[str], kind: str = "string") -> Column:
    """The value at the first of some spellings of a key that has one of that kind; keys may be paths with dots.

    A value that is not of the kind and cannot be cast to it counts as missing.
    """
    spellings = [keys] if isinstance(keys, str) else keys
    return F.coalesce(*[F.try_variant_get(F.col(variant), _path(key), kind) for key in spellings])


def attributes(rows: DataFrame, column: str, wanted: Mapping[str, str | Sequence[str]]) -> DataFrame:
    """``rows`` with a text column per entry of ``wanted`` (name -> key, or spellings of it), the document parsed once."""
    variant = "_document"
    out = parsed(rows, column, variant)
    return out.select(*rows.columns, *[value_at(variant, keys).alias(name) for name, keys in wanted.items()])


def flatten_variant(rows: DataFrame, column: str) -> DataFrame:
    """A row per entry of an object: ``key`` and its ``value`` as VARIANT; other values, empty objects and NULL vanish."""
    kept = [c for c in rows.columns if c != column]
    view = rows.withColumn("_object", F.try_variant_get(F.col(column), "$", "map<string,variant>"))
    return view.select(*kept, F.explode("_object").alias("key", "value"))


def number_of(variant: str) -> Column:
    """A number, or a text that is one, as decimal with 6 places; NULL for any other value."""
    return F.try_variant_get(F.col(variant), "$", "decimal(38,6)")


def sum_values(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of the flattened objects: the sum of its numeric values, and how many values are none (mixed objects)."""
    number = number_of("value")
    return entries.groupBy(*keys, "key").agg(F.sum(number).alias("value"), F.count_if(number.isNull()).alias("other_values"))
