"""Percentile ranks: balance of the buckets, and exact ties of quotients of large sums."""

from __future__ import annotations

import decimal
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from vitalgauge.functions import exact_ratio
from vitalgauge.operators import ranks
from vitalgauge.operators.ranks import percent_ranks


def order_of(values):
    return F.struct(F.col(values).cast("double").alias("value"), F.lit(None).cast("decimal(38,18)").alias("tie"))


@pytest.mark.parametrize("kind", ["narrow", "wide", "negative"])
def test_buckets_are_even_wherever_the_values_lie(spark, kind):
    value = {"narrow": "1 + x * 1e-3", "wide": "pow(10, 300 * x - 150)", "negative": "x - 2"}[kind]
    rows = spark.range(0, 200_000, 1, 8).selectExpr("id", "rand(5) AS x").selectExpr("'m' AS measure", f"{value} AS v").distinct()
    rows = rows.select("measure", order_of("v").alias("order"))
    dealt = rows.join(F.broadcast(ranks._borders(rows)), "measure").withColumn(
        "bucket", ranks._bucket(F.col("order.value"), F.col("borders"), True)
    )
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert len(sizes) > 1000 and max(sizes) <= 2 * sum(sizes) / len(sizes)


def test_ranks_of_a_narrow_band(spark):
    rng = random.Random(4)
    values = [round(1 + rng.random() * 1e-3, 5) for _ in range(3000)] + [None] * 5
    df = spark.createDataFrame(list(enumerate(values)), "id long, m double")
    known = sorted(v for v in values if v is not None)
    below = {v: known.index(v) for v in set(known)}
    for r in percent_ranks(df, ["id"], ["m"]).collect():
        expected = below[r["value"]] if r["value"] is not None else len(known)
        assert r["pct_rank"] == expected / (len(values) - 1)


def test_exact_ratio(spark):
    rng = random.Random(2)
    big = lambda: rng.randrange(10 ** rng.randint(0, 27))
    pairs = [(decimal.Decimal(a), decimal.Decimal(b)) for a, b in [(0, 5), (5, 0), (1, 3), (-1, 3), (7, 1)]]
    pairs += [(decimal.Decimal(big()), decimal.Decimal(big())) for _ in range(300)] + [(None, decimal.Decimal(1)), (decimal.Decimal(1), None)]
    df = spark.createDataFrame(pairs, "a decimal(38,0), b decimal(38,0)").withColumn("q", exact_ratio("a", "b"))
    for a, b, q in df.collect():
        if a is None or not b:
            assert q is None
        elif q is None:
            assert abs(a / b) >= 10**19 or b > 10**28
        else:
            assert 0 <= abs(Fraction(int(a), int(b))) - abs(Fraction(q)) < Fraction(1, 10**18)


def test_equal_quotients_of_large_sums_tie(spark):
    """Doubles of these sums would tell some equal quotients apart."""
    rng = random.Random(9)
    rows, quotients = [], []
    for i in range(400):
        a, b, k = rng.choice([(1, 3), (2, 7), (355, 113), (10**9 + 7, 10**9 + 9)]) + (rng.randrange(10**15, 10**17),)
        rows.append((i, decimal.Decimal(a * k), decimal.Decimal(b * k), float(a * k) / float(b * k)))
        quotients.append(Fraction(a, b))
    assert len({r[3] for r in rows}) > 4
    df = spark.createDataFrame(rows, "id int, a decimal(38,0), b decimal(38,0), m double").withColumn("exact_m", exact_ratio("a", "b"))
    got = {r["id"]: r["pct_rank"] for r in percent_ranks(df, ["id"], ["m"], exact={"m": "exact_m"}).collect()}
    for i, q in enumerate(quotients):
        assert got[i] == sum(x < q for x in quotients) / (len(rows) - 1)


def test_exploded_measures_and_wide_rows_are_never_broadcast(spark):
    """They are many times what they are read from, by whose size Spark would judge them."""
    rows = spark.range(500).selectExpr("id", "id % 7 AS a", "id % 3 AS b")
    plan = ranks.with_ranks_and_scores(rows, ["id"], {"a": "a", "b": "b"})._jdf.queryExecution().executedPlan().toString()
    for keys in ("[id#", "[coalesce(measure#"):
        assert f"SortMergeJoin {keys}" in plan and f"BroadcastHashJoin {keys}" not in plan
