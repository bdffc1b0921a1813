"""A stored layout of facts in which joins by plan need no shuffle: by month, and in buckets by plan.

A query of few months reads the folders of these months only, and two facts with the same buckets are joined by plan and
date bucket by bucket, where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgauge.tables import Tables

#: By fact table: its month column and the column of its buckets.
FACT_LAYOUT = {
    "solution_monthly": ("date", "plan_uid"),
    "plan_daily": ("date", "plan_uid"),
    "solution_plan_monthly": ("date", "plan_uid"),
}


def write_fact(df: DataFrame, table: str, path: str, buckets: int, month: str = "date", key: str = "plan_uid") -> None:
    """Write a fact as catalog table ``table`` at ``path``, in a folder per month with ``buckets`` sorted buckets by ``key``.

    ``buckets`` should be the same for all facts, and such that a bucket of one month fits a task. Rows are dealt by bucket and month
    first, so each month and bucket is one file. A key with a large share of all rows makes one
    large bucket; where keys are that uneven, leave the fact as it is and let adaptive execution split the join.
    """
    dealt = df.repartition(F.col(month), F.pmod(F.hash(key), F.lit(buckets)))  # as Spark numbers buckets
    dealt.write.partitionBy(month).bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)


def write_facts(tables: Tables, names: Mapping[str, str], folder: str, buckets: int) -> None:
    """Write the facts of ``tables`` that ``names`` (logical name -> catalog name) lists."""
    for name, table in names.items():
        month, key = FACT_LAYOUT[name]
        write_fact(tables[name], table, f"{folder.rstrip('/')}/{table}", buckets, month, key)


def with_stored_facts(tables: Tables, spark: SparkSession, names: Mapping[str, str]) -> Tables:
    """``tables`` with the facts of ``names`` read from the catalog."""
    loaders = {name: (lambda name=name: tables[name]) for name in tables.names()}
    return Tables(loaders | {name: (lambda table=table: spark.table(table)) for name, table in names.items()})


@contextmanager
def joined_by_bucket(spark: SparkSession) -> Iterator[None]:
    """Within the block, joins on more columns than the buckets' own still count as joined by bucket.

    Spark otherwise shuffles unless all join columns are bucket columns, to be safe from few, uneven buckets. Actions must run inside.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
