"""Percentile ranks of many measures over all rows, without one global sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgauge.functions import band_score
from vitalgauge.operators.joins import join_null_safe

#: Buckets that the distinct values of a measure are dealt to, and how exact their borders are (1 / _ACCURACY of the values).
_BUCKETS, _ACCURACY = 1024, 20_000


def _borders(distinct: DataFrame) -> DataFrame:
    """A row per measure: ascending values between which about equally many of its distinct values lie.

    They come from a quantile sketch of bounded size, which tasks build for their rows and Spark merges. Its errors change the
    sizes of buckets, never a rank.
    """
    shares = F.array(*[F.lit(i / _BUCKETS) for i in range(1, _BUCKETS)])
    sketch = F.percentile_approx("order.value", shares, F.lit(_ACCURACY))
    return distinct.groupBy("measure").agg(F.array_distinct(sketch).alias("borders"))


def _bucket(value: Column, borders: Column, nulls_last: bool) -> Column:
    """How many borders are below the value, by binary search; NULL comes before or after all."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range((_BUCKETS - 1).bit_length()))])
    found = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(borders, at + step - 1) < value, at + step).otherwise(at)
    )
    return F.when(value.isNull(), F.lit(_BUCKETS if nulls_last else -1)).otherwise(found)


def percent_ranks(
    rows: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    nulls_last: bool = True,
    exact: Mapping[str, str] | None = None,
) -> DataFrame:
    """Long table ``ids, measure, value, pct_rank``: the PERCENT_RANK of each measure, ascending.

    ``exact`` names, for measures that are quotients, a decimal column that is equal for equal ones (see
    :func:`vitalgauge.functions.exact_ratio`); it decides ties that doubles of large sums would miss.

    Equal values are counted first, so ties, however heavy, are one row. The distinct values of a measure fall into ordered
    buckets whose borders are taken from the values themselves, so a narrow band of values is spread like any other; a running
    count inside each bucket plus the size of the buckets below gives the number of smaller rows. Only the bucket sizes of a
    measure, ``_BUCKETS`` + 2 at most, are ever in one task.
    """
    exact = exact or {}

    def entry(measure: str) -> Column:
        value, tie = F.col(measure).cast("double"), F.lit(None).cast("decimal(38,18)")
        if measure in exact:
            tie = F.col(exact[measure]).cast("decimal(38,18)")
            value = F.coalesce(tie.cast("double"), value)  # made of the exact one, so that both have the same order
        order = F.when(F.col(measure).isNotNull(), F.struct(value.alias("value"), tie.alias("tie")))
        return F.struct(F.lit(measure).alias("measure"), F.col(measure).cast("double").alias("value"), order.alias("order"))

    long = rows.select(*ids, F.explode(F.array(*map(entry, measures))).alias("entry")).select(*ids, "entry.*")
    distinct = long.groupBy("measure", "order").agg(F.count("*").alias("n"))
    # a row per measure, hence the broadcast
    dealt = distinct.join(F.broadcast(_borders(distinct)), "measure").withColumn(
        "bucket", _bucket(F.col("order.value"), F.col("borders"), nulls_last)
    )
    dealt = dealt.drop("borders")
    all_buckets = Window.partitionBy("measure")
    lower_buckets = all_buckets.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        dealt.groupBy("measure", "bucket")
        .agg(F.sum("n").alias("size"))
        .select(
            "measure",
            "bucket",
            F.coalesce(F.sum("size").over(lower_buckets), F.lit(0)).alias("start"),
            F.sum("size").over(all_buckets).alias("total"),
        )
    )
    lower_values = (
        Window.partitionBy("measure", "bucket").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    )
    below = F.col("start") + F.coalesce(F.col("inside"), F.lit(0))
    ranked = (
        dealt.withColumn("inside", F.sum("n").over(lower_values))
        .join(buckets, ["measure", "bucket"])
        .select(
            "measure",
            "order",
            F.when(F.col("total") > 1, below / (F.col("total") - 1)).otherwise(0.0).alias("pct_rank"),
        )
    )
    # Spark judges both sides by the size of ``rows`` before it is exploded, and would broadcast them
    return join_null_safe(long.hint("merge"), ranked, ["measure", "order"], "inner").drop("order")


def with_ranks_and_scores(
    rows: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    nulls_last: bool = True,
    exact: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows with ``pct_rank_<short>`` and ``score_<short>`` for each measure -> short name.

    ``ids`` must identify a row; for ``exact`` see :func:`percent_ranks`.
    """
    long = percent_ranks(rows, ids, list(measures), nulls_last, exact).withColumn("score", band_score("pct_rank"))
    wide = long.groupBy(*ids).agg(
        *[
            F.expr(f"max(CASE WHEN measure = '{measure}' THEN {column} END) AS {prefix}_{short}")
            for measure, short in measures.items()
            for column, prefix in (("pct_rank", "pct_rank"), ("score", "score"))
        ]
    )
    return rows.hint("merge").join(wide, list(ids))
