"""Object (map) columns: flatten to rows, re-aggregate, build maps again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Object columns of ``solution_plan_monthly``.
OBJECT_KINDS = ("premium_apps", "integrations", "connectors", "assets")


def flatten_object(rows: DataFrame, column: str) -> DataFrame:
    """One row per entry of a map column; rows with an empty or NULL map vanish."""
    kept = [c for c in rows.columns if c != column]
    return rows.select(*kept, F.explode(column).alias("key", "value"))


def flatten_json(rows: DataFrame, column: str) -> DataFrame:
    """As :func:`flatten_object`, for a JSON object kept as text with whole-number values."""
    return flatten_object(rows.withColumn(column, F.from_json(column, "map<string,bigint>")), column)


def stack_objects(rows: DataFrame, keys: Sequence[str], kinds: Sequence[str] = OBJECT_KINDS) -> DataFrame:
    """All map columns as one long table ``keys, kind, key, value``, in one scan of ``rows``."""
    labelled = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("object")) for kind in kinds])
    return rows.select(*keys, F.explode(labelled).alias("o")).select(
        *keys, F.col("o.kind").alias("kind"), F.explode("o.object").alias("key", "value")
    )


def sum_by_key(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Value summed per key of the flattened objects."""
    return entries.groupBy(*keys, "kind", "key").agg(F.sum("value").cast("bigint").alias("value"))


def _entries_to_map(key: str, value: str, predicate: Column | None = None) -> Column:
    known = F.col(key).isNotNull() & F.col(value).isNotNull()
    if predicate is not None:
        known = known & predicate
    return F.map_from_entries(F.array_sort(F.collect_set(F.when(known, F.struct(key, value)))))


def object_agg(entries: DataFrame, keys: Sequence[str], kinds: Sequence[str] = OBJECT_KINDS) -> DataFrame:
    """One map column per kind from distinct (key, value) rows, keys in order.

    Entries must be unique per ``keys``, kind and key, as :func:`sum_by_key` leaves them. A map is
    one value of one row, so an output row gathers the distinct keys of its own map and no more.
    """
    return entries.groupBy(*keys).agg(
        *[_entries_to_map("key", "value", F.col("kind") == kind).alias(kind) for kind in kinds]
    )


def map_as_text(column: str) -> Column:
    """A map as ``key=value`` pairs in key order, for formats without maps."""
    pairs = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(pairs, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
