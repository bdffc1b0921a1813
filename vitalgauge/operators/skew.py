"""Equi-joins on keys of which a few hold a large share of all rows.

The frequent keys are found by a sketch in one pass, and only their rows are salted: spread over several tasks, with a copy of
the matching rows of the other side in each. All other rows are joined as ever. Unlike splitting at run time this
holds for outer joins and for whatever follows the join on the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys the sketch names and keeps count of.
_TOP, _TRACKED = 100, 10_000


def heavy_keys(rows: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Values of ``key`` that hold at least about ``share`` of the rows with one; 100 at most, so the frame is small.

    A sketch of bounded size counts them (``approx_top_k``). It may miss a key near the border, which then is joined as
    others are; no result depends on it.
    """
    known = rows.where(F.col(key).isNotNull())
    sketch = known.agg(F.expr(f"approx_top_k(`{key}`, {_TOP}, {_TRACKED})").alias("top"), F.count("*").alias("n"))
    found = sketch.select(F.explode("top").alias("k"), "n")
    return found.where(F.col("k.count") >= F.col("n") * share).select(F.col("k.item").alias(key))


def salted_join(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], hot: str, how: str = "left", salts: int = 64, share: float = 0.01
) -> DataFrame:
    """``rows`` joined (``how``: left or inner) to ``other`` on ``keys``, the frequent values of the key ``hot`` spread over ``salts`` tasks.

    ``other`` should have few rows per heavy key, as each is copied ``salts`` times. Rows are spread by a hash of all their columns,
    so a task that is run again deals them alike.
    """
    heavy = F.broadcast(heavy_keys(rows, hot, share).withColumn("_heavy", F.lit(True)))  # _TOP rows at most
    spread = F.pmod(F.xxhash64(*rows.columns, F.lit("salt")), F.lit(salts))
    left = rows.join(heavy, hot, "left").withColumn("_salt", F.when(F.col("_heavy"), spread).otherwise(0)).drop("_heavy")
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = other.join(heavy, hot, "left").withColumn("_salt", F.explode(copies.cast("array<bigint>"))).drop("_heavy")
    return left.withColumn("_salt", F.col("_salt").cast("bigint")).join(right, [*keys, "_salt"], how).drop("_salt")
