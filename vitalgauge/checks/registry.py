"""Registry of checked queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgauge.checks.oracle import oracle
from vitalgauge.params import FIXTURE_PARAMS, Params
from vitalgauge.sources.fixture import fixture_tables
from vitalgauge.tables import Tables

Build = Callable[[Tables, Params], DataFrame]


@dataclass(frozen=True)
class Check:
    key: str
    build: Build
    sql: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(self.build(fixture_tables(spark, sf_dir), FIXTURE_PARAMS))


CHECKS: dict[str, Check] = {}


def check(key: str, sql: str) -> Callable[[Build], Build]:
    """Register a query under ``key`` with the body of its oracle."""

    def register(build: Build) -> Build:
        CHECKS[key] = Check(key, build, oracle(sql))
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result with money as double and doubles rounded to 6 places, for comparison by value."""

    def column(field: T.StructField):
        if isinstance(field.dataType, (T.DecimalType, T.DoubleType)):
            return F.round(F.col(field.name).cast("double"), 6).alias(field.name)
        return F.col(field.name)

    return df.select(*[column(field) for field in df.schema.fields])
