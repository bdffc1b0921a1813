"""VARIANT documents, and joins on heavy keys."""

from __future__ import annotations

import decimal
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from vitalgauge.operators.documents import attributes, flatten_variant, parsed, sum_values, value_at
from vitalgauge.operators.skew import heavy_keys, salted_join

TEXTS = [
    (1, '{"industry": "a", "subIndustry": "b", "n": 3}'), (2, '{"industry_sub": "c", "subIndustry": "d"}'), (3, '{"industry": null, "n": "4"}'),
    (4, "no json"), (5, None), (6, "[1, 2]"), (7, "{}"), (8, '{"industry": {"x.y": 1}, "n": 2.5, "m": true, "industry_sub": 7}'),
]


def test_attributes_and_their_spellings(spark):
    rows = spark.createDataFrame(TEXTS, "id int, company string")
    found = attributes(rows, "company", {"industry": "industry", "sub": ("industry_sub", "subIndustry")})
    got = {r.id: (r.industry, r["sub"]) for r in found.collect()}
    assert got == {1: ("a", "b"), 2: (None, "c"), 3: (None, None), 4: (None, None), 5: (None, None), 6: (None, None), 7: (None, None), 8: ('{"x.y":1}', "7")}
    deep = parsed(rows, "company").select(value_at("company", "industry.x.y")).collect()
    assert all(r[0] is None for r in deep)  # a dot in a path is a step
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_mixed_values(spark):
    rows = spark.createDataFrame([(1, *TEXTS[k][1:]) for k in range(len(TEXTS))], "id int, company string")
    entries = flatten_variant(parsed(rows, "company"), "company")
    assert Counter(r.key for r in entries.collect()) == {"industry": 3, "subIndustry": 2, "industry_sub": 2, "n": 3, "m": 1}
    sums = {r.key: (r.value, r.other_values) for r in sum_values(entries, ["id"]).collect()}
    assert sums["n"] == (decimal.Decimal("9.5"), 0) and sums["industry"] == (None, 3) and sums["industry_sub"] == (decimal.Decimal(7), 1)


@pytest.fixture
def uneven(spark):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 10 < 3, "hot").when(F.col("id") % 97 == 0, None).otherwise((F.col("id") % 5000).cast("string")).alias("k"), "id"
    )
    other = spark.range(0, 4000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")).union(spark.sql("SELECT 'hot', -1L UNION ALL SELECT 'hot', -2L"))
    return rows, other


def test_heavy_keys(uneven):
    assert [r.k for r in heavy_keys(uneven[0], "k").collect()] == ["hot"]
    assert heavy_keys(uneven[0].where("k <> 'hot'"), "k").collect() == [] and heavy_keys(uneven[0].limit(0), "k").collect() == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_the_join(uneven, how):
    rows, other = uneven
    plain = rows.join(other, "k", how).select("k", "id", "v")
    salted = salted_join(rows, other, ["k"], "k", how, salts=16).select("k", "id", "v")
    assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_no_task_of_the_join_gets_more_than_three_times_the_median(spark, uneven):
    rows, other = uneven
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        def sizes(joined):
            return [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]

        salted, plain = sizes(salted_join(rows, other, ["k"], "k", salts=256)), sizes(rows.join(other, "k", "left"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(salted) <= 3 * median(salted) and max(plain) > 5 * median(plain)
