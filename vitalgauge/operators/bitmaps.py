"""Distinct counts over unions of sets, by exact bitmaps.

Items are numbered, and a set of items is bits: rows of 32,768 bits each, those of whole zeros left out. Bitmaps of
sets are merged by OR and counted, so the distinct items of many sets cost a row per set and stretch of numbers, not one per item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgauge.sources.shared import share

BUCKET, BITS = "bucket", "bits"


def numbered(items: DataFrame, order: Sequence[str], name: str = "number") -> DataFrame:
    """Distinct rows with a number each, stored. Rows near each other in ``order`` have numbers near each other.

    Rows are dealt to tasks by ranges of ``order`` and counted within each, so no task sees more than its range.
    """
    ranged = items.repartitionByRange(*order).sortWithinPartitions(*order)
    return share(ranged.withColumn(name, F.monotonically_increasing_id()), "numbered-items")


def bitmaps(rows: DataFrame, keys: Sequence[str], number: str = "number") -> DataFrame:
    """Per key and stretch of numbers (``bucket``) the numbers there, as ``bits``."""
    bucket = F.bitmap_bucket_number(number).alias(BUCKET)
    return rows.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def merged(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of the same keys and stretch become one: the union of their sets."""
    return rows.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counted(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Per key, how many numbers its bitmaps have; one bitmap per key and stretch is expected (see :func:`merged`)."""
    return rows.groupBy(*keys).agg(F.sum(F.bitmap_count(BITS)).alias(name))
